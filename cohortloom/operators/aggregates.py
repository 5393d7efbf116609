"""Per-person summaries, distributions, bins, ladders, agreement and overlap tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import fixed
from ..functions import numeric as N
from ..session import cut
from ..sources.tables import semi_scan
from . import ranks


def person_means(days: DataFrame, cols: list[str], min_days: int = fixed.MIN_WEAR_DAYS) -> DataFrame:
    """Mean of each column over its valid days, only with enough of them; age is the mean over all rows."""
    return days.groupBy("pid").agg(
        *[F.when(F.count(c) >= min_days, F.avg(c)).alias(c) for c in cols], *[F.count(c).alias(f"n_{c}") for c in cols], F.avg("age").alias("age")
    )


def person_median(df: DataFrame, value: str, minimum: float | None = None) -> DataFrame:
    """Exact median per person of plausible values, with mean age and record count. A person has few records: one aggregation does."""
    kept = df if minimum is None else df.where(F.col(value) >= minimum)
    return kept.groupBy("pid").agg(F.median(value).alias("median"), F.avg("age").alias("age"), F.count(value).alias("n")).where("n > 0")


def onset_hour(starts: DataFrame, ts: str, night: str) -> DataFrame:
    """First start of each night as a wrapped clock hour, averaged per person."""
    first = starts.groupBy("pid", night).agg(F.min(ts).alias("first"))
    hour = F.hour("first") + F.minute("first") / 60.0
    return first.withColumn("h", F.when(hour < 12, hour + 24).otherwise(hour)).groupBy("pid").agg(F.avg("h").alias("onset"), F.count(F.lit(1)).alias("nights"))


def trial_rates(sittings: DataFrame, categories: list[str]) -> DataFrame:
    """Nested trials to per-sitting counts: trials, correct ones, reaction time and correct per second, in total and per category."""
    t = sittings.select("pid", "sitting_id", F.explode_outer("trial_data").alias("t")).select("pid", "sitting_id", "t.*")
    sec = F.col("reaction_time") / 1000.0
    aggs: list[Column] = []
    for name, hit in [("all", F.col("emotion").isNotNull()), *[(c, F.col("emotion") == c) for c in categories]]:
        total = F.sum(F.when(hit, sec))
        right = F.count_if(hit & F.col("correct"))
        aggs += [F.count_if(hit).alias(f"n_{name}"), right.alias(f"correct_{name}"), F.when(total > 0, right / total).alias(f"rate_{name}")]
    return t.groupBy("pid", "sitting_id").agg(*aggs)


def union_tasks(tasks: dict[str, DataFrame], flags: list[str]) -> DataFrame:
    """Task tables of different shapes as one, rows with any raised quality flag left out."""
    from .responses import union_all

    out = union_all([df.withColumn("task", F.lit(name)) for name, df in tasks.items()])
    for f in flags:
        out = out.where(F.coalesce(F.col(f), F.lit(0)) == 0)
    return out


def repeat_summary(df: DataFrame) -> DataFrame:
    per = df.select("task", "pid", "sitting_id").distinct().groupBy("task", "pid").agg(F.count(F.lit(1)).alias("n"))
    return per.groupBy("task").agg(F.count(F.lit(1)).alias("persons"), F.count_if(F.col("n") >= 2).alias("repeaters"), F.avg("n").alias("mean_sittings"), F.max("n").alias("max_sittings"))


PROBS = {"p01": 0.01, "p25": 0.25, "p50": 0.5, "p75": 0.75, "p99": 0.99}


def distribution(df: DataFrame, keys: list[str], cols: list[str], probs: dict[str, float] = PROBS) -> DataFrame:
    """Count, moments, bias-corrected skewness, extremes and exact quantiles per group and column."""
    long = df.select(*keys, *[F.col(c).cast("double").alias(c) for c in cols]).unpivot(keys, cols, "column", "value").where(F.col("value").isNotNull())
    by = [*keys, "column"]
    n = F.count("value")
    skew = F.when(n > 2, F.skewness("value") * F.sqrt(n * (n - 1)) / (n - 2))
    moments = long.groupBy(*by).agg(n.alias("n"), F.avg("value").alias("mean"), F.stddev_samp("value").alias("sd"), skew.alias("skew"), F.min("value").alias("min"), F.max("value").alias("max"))
    return moments.join(ranks.exact_quantiles(long, by, "value", probs), by)


def threshold_summary(df: DataFrame, col: str, cuts: list[float], value: str) -> DataFrame:
    """For each cut the rows at or above it: count, mean and largest value. One pass, no row is repeated per cut."""
    aggs = []
    for i, t in enumerate(cuts):
        hit = F.col(col) >= t
        aggs += [F.count_if(hit).alias(f"n_{i}"), F.avg(F.when(hit, F.col(value))).alias(f"m_{i}"), F.max(F.when(hit, F.col(value))).alias(f"x_{i}")]
    one = df.agg(*aggs)
    rows = F.array(*[F.struct(F.lit(float(t)).alias("threshold"), F.col(f"n_{i}").alias("n"), F.col(f"m_{i}").alias("mean_value"), F.col(f"x_{i}").alias("max_value")) for i, t in enumerate(cuts)])
    return one.select(F.explode(rows).alias("r")).select("r.*")


def bin_counts(df: DataFrame, col: str, edges: list[float], labels: list[str]) -> DataFrame:
    """Rows per half-open bin [edge, next edge), the last one open above; empty bins are shown. One pass."""
    c = F.col(col)
    hits = [(c >= lo) & (c < hi) if hi is not None else (c >= lo) for lo, hi in zip(edges, [*edges[1:], None])]
    one = df.agg(*[F.count_if(F.coalesce(h, F.lit(False))).alias(f"b{i}") for i, h in enumerate(hits)])
    rows = F.array(*[F.struct(F.lit(x).alias("bin"), F.col(f"b{i}").alias("n")) for i, x in enumerate(labels)])
    return one.select(F.explode(rows).alias("r")).select("r.*")


def ordered_counts(df: DataFrame, col: str, order: list[str]) -> DataFrame:
    """Counts in a stated order, listed categories without rows as zero, others after them."""
    counts = df.where(F.col(col).isNotNull()).groupBy(F.col(col).alias("category")).agg(F.count(F.lit(1)).alias("n"))
    dim = df.sparkSession.createDataFrame(list(enumerate(order)), "place int, category string")
    out = dim.join(counts, "category", "full_outer")
    return out.select("category", F.coalesce("place", F.lit(len(order))).alias("place"), F.coalesce("n", F.lit(0)).alias("n"))


def crosstab(df: DataFrame, row: str, col: str) -> DataFrame:
    """Cell counts and the share within the row."""
    cells = df.groupBy(row, col).agg(F.count(F.lit(1)).alias("n"))
    return cells.withColumn("row_share", F.col("n") / F.sum("n").over(W.partitionBy(row)))


def overlap_metrics(df: DataFrame, a: Column, b: Column) -> DataFrame:
    """How two yes/no classifications agree; b is taken as the truth for precision and recall."""
    a, b = F.coalesce(a, F.lit(False)), F.coalesce(b, F.lit(False))
    n = df.agg(F.count_if(a & b).alias("both"), F.count_if(a & ~b).alias("a_only"), F.count_if(~a & b).alias("b_only"), F.count_if(~a & ~b).alias("neither"))
    ratio = lambda x, y: F.when(y > 0, x / y)
    both = F.col("both")
    return n.select(
        "*", ratio(both, both + F.col("a_only") + F.col("b_only")).alias("jaccard"), ratio(both, both + F.col("a_only")).alias("precision"), ratio(both, both + F.col("b_only")).alias("recall")
    )


def agreement(df: DataFrame, keys: list[str], a: str, b: str, cuts: list[float]) -> DataFrame:
    """Pair agreement per group: correlations, error measures, exact and nearest-rank quantiles of the absolute difference."""
    d = df.where(F.col(a).isNotNull() & F.col(b).isNotNull()).withColumn("_abs", F.abs(F.col(a) - F.col(b)))
    d = cut(d.select(*keys, a, b, "_abs"))  # read by every histogram
    base = d.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), N.safe_corr(a, b).alias("pearson"), F.avg(F.col(a) - F.col(b)).alias("bias"), F.avg("_abs").alias("mae"),
        F.sqrt(F.avg(F.col("_abs") * F.col("_abs"))).alias("rmse"), F.max("_abs").alias("max_abs"),
        *[F.avg((F.col("_abs") > c).cast("double")).alias(f"share_above_{i}") for i, c in enumerate(cuts)],
    )
    both = ranks.average_ranks(d, keys, {a: "_ra", b: "_rb"})
    rho = both.groupBy(*keys).agg(N.safe_corr("_ra", "_rb").alias("spearman"))
    spread = ranks.quantiles(d, keys, "_abs", exact={"median_abs": 0.5}, nearest={"p90_abs": 0.9, "p99_abs": 0.99})
    if not keys:
        return reduce(lambda x, y: x.crossJoin(y), [rho, spread], base)  # single rows
    return reduce(lambda x, y: x.join(y, keys), [rho, spread], base)


def ladder(df: DataFrame, steps: list[tuple[str, Column]]) -> DataFrame:
    """First step each row fails (null when it passes all); a null condition fails."""
    out = None
    for name, keep in steps:
        bad = ~F.coalesce(keep, F.lit(False))
        out = F.when(bad, name) if out is None else out.when(bad, name)
    return df.withColumn("failed_step", out)


def filter_steps(flagged: DataFrame, names: list[str]) -> DataFrame:
    """Dropped and remaining rows after each step, in order. The counts are a few rows, so the running sum is trivial."""
    counts = flagged.groupBy("failed_step").agg(F.count(F.lit(1)).alias("n"))
    dim = flagged.sparkSession.createDataFrame([(i + 1, s) for i, s in enumerate(names)], "step int, name string")
    per = dim.join(counts.where("failed_step is not null"), F.col("name") == F.col("failed_step"), "left").select("step", "name", F.coalesce("n", F.lit(0)).alias("dropped"))
    total = flagged.agg(F.count(F.lit(1)).alias("total"))
    return running_remaining(per.crossJoin(total), "step")


def running_remaining(steps: DataFrame, order: str) -> DataFrame:
    """Rows left after each step, from the total and the dropped counts (one row per step)."""
    lost = F.sum("dropped").over(W.partitionBy(F.lit(1)).orderBy(order).rowsBetween(W.unboundedPreceding, 0))
    return steps.withColumn("remaining", F.col("total") - lost)


def rollup_summary(df: DataFrame, key: str, sums: list[str], mins: list[str], maxs: list[str]) -> DataFrame:
    """Per key and in all: sums, minima, maxima."""
    out = df.rollup(key).agg(
        *[F.sum(c).alias(f"sum_{c}") for c in sums], *[F.min(c).alias(f"min_{c}") for c in mins], *[F.max(c).alias(f"max_{c}") for c in maxs], F.grouping(key).alias("_all")
    )
    return out.withColumn(key, F.when(F.col("_all") == 1, F.lit("all")).otherwise(F.col(key))).drop("_all")


def level_histogram(df: DataFrame, value: str, lo: int, hi: int) -> DataFrame:
    """Counts at every integer level from lo to hi, zeros included; values that are no such level are counted under the level null."""
    v = F.col(value)
    level = F.when(v.between(lo, hi) & (v == F.floor(v)), v.cast("int"))
    counts = df.where(v.isNotNull()).groupBy(level.alias("level")).agg(F.count(F.lit(1)).alias("n"))
    dim = df.sparkSession.range(lo, hi + 1).select(F.col("id").cast("int").alias("level"))
    return dim.join(counts, "level", "left").fillna(0, ["n"]).unionByName(counts.where("level is null"))


def level_moments(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Moments with the population standard deviation."""
    return df.groupBy(*keys).agg(F.count(value).alias("n"), F.avg(value).alias("mean"), F.stddev_pop(value).alias("sd_pop"), F.min(value).alias("min"), F.max(value).alias("max"))


def prorated_sum(items: DataFrame, keys: list[str], n_items: int, value: str = "y") -> DataFrame:
    """Mean of the answered items times their number, when more than half are answered; age is the mean of known ages."""
    per = items.groupBy(*keys, "item").agg(F.max(value).alias("_v"), F.avg("age").alias("_a"))
    out = per.groupBy(*keys).agg(F.count("_v").alias("n_valid"), F.avg("_v").alias("_m"), F.avg("_a").alias("age"))
    return out.where(F.col("n_valid") >= n_items // 2 + 1).select(*keys, (F.col("_m") * n_items).alias("score"), "n_valid", "age")


def complete_sum(items: DataFrame, keys: list[str], n_items: int, value: str = "y") -> DataFrame:
    """Sum of the items when every one is answered."""
    out = items.where(F.col(value).isNotNull()).groupBy(*keys).agg(F.count_distinct("item").alias("n_valid"), F.sum(value).alias("score"), F.avg("age").alias("age"))
    return out.where(F.col("n_valid") == n_items)


def option_count(options: Column, scored: list[str], none: list[str], ignored: list[str], missing: list[str] = ()) -> Column:
    """Distinct scored options ticked. None alone is 0; none with others, a missing code or an unknown option is null, as is ignored-only."""
    arr = lambda xs: F.array(*[F.lit(x) for x in xs]).cast("array<string>")
    opts = F.array_distinct(options)
    hits, nones = F.array_intersect(opts, arr(scored)), F.array_intersect(opts, arr(none))
    unknown = F.array_except(opts, arr([*scored, *none, *ignored]))
    bad = (F.size(unknown) > 0) | (F.size(F.array_intersect(opts, arr(missing))) > 0) | ((F.size(nones) > 0) & (F.size(opts) > F.size(nones)))
    return F.when(options.isNull() | bad, None).when(F.size(nones) > 0, 0).when(F.size(hits) > 0, F.size(hits))


def weighted_options(selected: DataFrame, weights: DataFrame, keys: list[str]) -> DataFrame:
    """Sum of the weights of the options chosen; unlisted options weigh nothing."""
    j = selected.join(weights, "option", "left")
    return j.groupBy(*keys).agg(F.sum(F.coalesce("weight", F.lit(0.0))).alias("score"))


def eligibility_counts(values: DataFrame) -> DataFrame:
    """Per trait: rows, cases, controls, distinct levels (values rounded to 6 digits); levels are combined before the shuffle."""
    lv = values.groupBy("pheno_id", F.round("y", 6).alias("level")).agg(F.count(F.lit(1)).alias("n"))
    return lv.groupBy("pheno_id").agg(
        F.sum("n").alias("n"), F.sum(F.when(F.col("level") == 1, F.col("n")).otherwise(0)).alias("cases"),
        F.sum(F.when(F.col("level") == 0, F.col("n")).otherwise(0)).alias("controls"), F.count(F.lit(1)).alias("levels"),
    )


def pass_extremes(flagged: DataFrame, cols: list[str]) -> DataFrame:
    """Smallest and largest value of each column among rows that pass every step."""
    ok = F.col("failed_step").isNull()
    return flagged.agg(*[f(F.when(ok, F.col(c))).alias(f"{n}_{c}") for c in cols for n, f in (("min", F.min), ("max", F.max))], F.count_if(ok).alias("n_pass"))


def variant_freq(genotypes: DataFrame, samples: DataFrame | None = None) -> DataFrame:
    """ALT count, observed alleles and frequency per variant, over a sample subset when given."""
    g = genotypes if samples is None else semi_scan(genotypes, samples, "sample_id")
    out = g.groupBy("variant_id").agg(F.sum("dosage").alias("alt_ct"), (F.count("dosage") * 2).alias("obs_ct"))
    return out.withColumn("freq", F.when(F.col("obs_ct") > 0, F.col("alt_ct") / F.col("obs_ct")))


def missingness(genotypes: DataFrame, axis: str) -> DataFrame:
    """Share of missing dosages per variant or per sample."""
    return genotypes.groupBy(axis).agg(F.count_if(F.col("dosage").isNull()).alias("n_missing"), F.count(F.lit(1)).alias("n"), F.avg(F.col("dosage").isNull().cast("double")).alias("f_miss"))
