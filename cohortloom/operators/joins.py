"""Joins, set operations and small rule checks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..session import cut
from ..sources.tables import require_unique


# coded values and predicates --------------------------------------------------------------------------------------------
def code_table(spark: SparkSession, mapping: dict, key: str, value: str) -> DataFrame:
    """A fixed code list as a table."""
    return spark.createDataFrame(list(mapping.items()), [key, value])


def map_codes(df: DataFrame, codes: DataFrame, key: str) -> DataFrame:
    """Values of a code list beside the rows; unlisted codes are null."""
    return df.join(codes, key, "left")


def in_class(limits: dict[str, tuple[float | None, float | None]]) -> Column:
    """All limits hold; a missing value or NaN fails."""
    out = F.lit(True)
    for name, (lo, hi) in limits.items():
        c = F.col(name)
        ok = ~F.isnan(c)
        if lo is not None:
            ok = ok & (c >= lo)
        if hi is not None:
            ok = ok & (c <= hi)
        out = out & F.coalesce(ok, F.lit(False))
    return out


def leakage_report(features: DataFrame, key: str, name: str, deny: str, allow: DataFrame) -> DataFrame:
    """Feature names that match the denied words and are not explicitly allowed."""
    listed = allow.select(key).distinct().withColumn("_allowed", F.lit(True))
    out = features.join(listed, key, "left")
    denied, allowed = F.col(name).rlike(f"(?i){deny}"), F.coalesce("_allowed", F.lit(False))
    return out.select(*features.columns, denied.alias("denied"), allowed.alias("allowed"), (denied & ~allowed).alias("violation"))


def assert_no_leakage(report: DataFrame, name: str) -> None:
    bad = [row[0] for row in report.where("violation").select(name).limit(5).collect()]
    if bad:
        raise ValueError(f"features not approved: {bad}")


# joins ------------------------------------------------------------------------------------------------------------------
def validated_join(left: DataFrame, right: DataFrame, on: list[str], cardinality: str = "many_to_one", how: str = "left") -> DataFrame:
    """Join whose right keys (and left keys for one_to_one) must be unique."""
    require_unique(right, on, "right side")
    if cardinality == "one_to_one":
        require_unique(left, on, "left side")
    return left.join(right, on, how)


def attrition(start: DataFrame, key: str, excludes: dict[str, DataFrame], sources: dict[str, DataFrame]) -> DataFrame:
    """First failing step per row: named exclusions, then presence in each source; null when all pass."""
    out, steps = start, None
    for name, ids in excludes.items():
        out = out.join(ids.select(key).distinct().withColumn(f"_x_{name}", F.lit(True)), key, "left")
        hit = F.col(f"_x_{name}").isNotNull()
        steps = F.when(hit, f"excluded_{name}") if steps is None else steps.when(hit, f"excluded_{name}")
    for name, ids in sources.items():
        out = out.join(ids.select(key).distinct().withColumn(f"_s_{name}", F.lit(True)), key, "left")
        hit = F.col(f"_s_{name}").isNull()
        steps = F.when(hit, f"missing_{name}") if steps is None else steps.when(hit, f"missing_{name}")
    return out.select(*start.columns, steps.alias("failed_step"))


def pair_keys(df: DataFrame, a: str, b: str) -> DataFrame:
    """Order-free pair: smaller id first."""
    return df.withColumn("_lo", F.least(a, b)).withColumn("_hi", F.greatest(a, b)).drop(a, b).withColumnsRenamed({"_lo": a, "_hi": b})


def pair_compare(ours: DataFrame, theirs: DataFrame, a: str, b: str, value: str) -> DataFrame:
    """Two pair tables side by side whatever their order, with the side that holds each pair."""
    x = pair_keys(ours, a, b).select(a, b, F.col(value).alias("left_value"), F.lit(True).alias("_l"))
    y = pair_keys(theirs, a, b).select(a, b, F.col(value).alias("right_value"), F.lit(True).alias("_r"))
    return with_side(x.join(y, [a, b], "full_outer"))


def with_side(joined: DataFrame) -> DataFrame:
    side = F.when(F.col("_l") & F.col("_r"), "both").when(F.col("_l"), "left_only").otherwise("right_only")
    return joined.withColumn("side", side).drop("_l", "_r")


def outer_with_source(left: DataFrame, right: DataFrame, on: list[str]) -> DataFrame:
    """Outer join with the side that holds each key."""
    return with_side(left.withColumn("_l", F.lit(True)).join(right.withColumn("_r", F.lit(True)), on, "full_outer"))


def latest_ties(df: DataFrame, keys: list[str], ts: str) -> DataFrame:
    """All rows at the latest time of their key; the maximum is combined before the shuffle and joined back."""
    top = df.groupBy(*keys).agg(F.max(ts).alias(ts))
    return df.join(top, [*keys, ts], "left_semi")


def same_time_pair(df: DataFrame, keys: list[str], ts: str, kind: str, first: str, second: str, value: str) -> DataFrame:
    """Earliest time at which a key has both kinds with first > second.

    Some pair qualifies at an instant exactly when its largest first value exceeds its smallest second value, so each instant is
    reduced to those two numbers and no pairs are built.
    """
    k, v = F.col(kind), F.col(value)
    at = df.groupBy(*keys, ts).agg(F.max(F.when(k == first, v)).alias("hi"), F.min(F.when(k == second, v)).alias("lo")).where("hi > lo")
    return at.groupBy(*keys).agg(F.min(ts).alias(ts), F.min_by("hi", ts).alias("first_value"), F.min_by("lo", ts).alias("second_value"))


def supplement(base: DataFrame, extra: DataFrame, key: str) -> DataFrame:
    """Extra rows only where their key is absent from the base."""
    return base.unionByName(extra.join(base.select(key).distinct(), key, "left_anti"), allowMissingColumns=True)


def exclude_ranges(points: DataFrame, ranges: DataFrame, chrom: str = "chrom", pos: str = "pos", width: int = 100_000) -> DataFrame:
    """Points outside all intervals (start exclusive, end inclusive). Intervals are laid over fixed-width tiles, so the join has an
    equality on (chromosome, tile) and neither side is broadcast unchecked."""
    tiles = ranges.select(
        F.col("chrom").alias("_c"), "start", "end", F.explode(F.sequence(F.floor(F.col("start") / width), F.floor(F.col("end") / width))).alias("_tile")
    )
    p = points.withColumn("_tile", F.floor(F.col(pos) / width)).alias("p")
    t = tiles.alias("t")
    cond = (F.col(f"p.{chrom}") == F.col("t._c")) & (F.col("p._tile") == F.col("t._tile")) & (F.col(f"p.{pos}") > F.col("t.start")) & (F.col(f"p.{pos}") <= F.col("t.end"))
    return p.join(t, cond, "left_anti").drop("_tile")


def expand_neighbours(seeds: DataFrame, edges: DataFrame, threshold: float) -> DataFrame:
    """Direct neighbours of seed ids over edges at or above the threshold (seeds included)."""
    strong = edges.where(F.col("kinship") >= threshold)
    both = strong.select(F.col("iid1").alias("iid"), F.col("iid2").alias("other")).unionByName(strong.select(F.col("iid2").alias("iid"), F.col("iid1").alias("other")))
    near = both.join(seeds.select("iid"), "iid", "left_semi").select(F.col("other").alias("iid"))
    return seeds.select("iid").unionByName(near).distinct()


def same_order(a: DataFrame, b: DataFrame, key: str, pos: str) -> DataFrame:
    """Counts of keys whose stated position differs or is absent on a side."""
    j = a.select(key, F.col(pos).alias("_pa")).join(b.select(key, F.col(pos).alias("_pb")), key, "full_outer")
    return j.agg(
        F.count_if(F.col("_pa") == F.col("_pb")).alias("n_same"),
        F.count_if(F.col("_pa") != F.col("_pb")).alias("n_moved"),
        F.count_if(F.col("_pa").isNull()).alias("n_right_only"),
        F.count_if(F.col("_pb").isNull()).alias("n_left_only"),
    )


def match_reference(df: DataFrame, ref: DataFrame, key: str, cols: list[str]) -> DataFrame:
    """Rows against their expected values: which column differs first, or 'absent' or 'ok'."""
    right = ref.select(F.col(key), *[F.col(c).alias(f"_ref_{c}") for c in cols], F.lit(True).alias("_hit"))
    status = F.when(F.col("_hit").isNull(), "absent")
    for c in cols:
        status = status.when(~F.col(c).eqNullSafe(F.col(f"_ref_{c}")), f"{c}_differs")
    return df.join(right, key, "left").select(*df.columns, status.otherwise("ok").alias("match"))


def union_scores(sources: list[tuple[str, DataFrame, str, str]]) -> DataFrame:
    """External scores from many tables: (trait, table, id column, value column); unusable values are left out."""
    parts = [
        df.select(F.lit(name).alias("pheno_id"), F.col(i).alias("iid"), F.col(v).cast("double").alias("y")) for name, df, i, v in sources
    ]
    return reduce(lambda a, b: a.unionByName(b), parts).where(F.col("y").isNotNull() & ~F.isnan("y"))


def zip_rows(ids: DataFrame, values: DataFrame) -> DataFrame:
    """Ids beside values by stated (batch, row) position; both sides must hold the same positions."""
    j = ids.withColumn("_l", F.lit(True)).join(values.withColumn("_r", F.lit(True)), ["batch", "row_idx"], "full_outer")
    if j.where(F.col("_l").isNull() | F.col("_r").isNull()).limit(1).count():
        raise ValueError("ids and values do not have the same rows")
    return j.drop("_l", "_r")


# prompt text to codebook item ---------------------------------------------------------------------------------------------
def crosswalk(live: DataFrame, catalog: DataFrame, explicit: DataFrame, coverage: float = 0.8) -> DataFrame:
    """Live questions (qid, survey, question) to codebook items (item, survey, label): listed ids, then equal text, then a unique
    suffix, then token coverage with a strict best.

    Token candidates come from each label's rarest words only: a label covered to `coverage` shares at least one of its
    n - ceil(coverage * n) + 1 rarest words, so common words never build pairs and no match is lost.
    """
    # Text is normalized once; all four steps read the written result.
    live = cut(live.select("qid", "survey", T.norm_question("question").alias("norm"), T.compact_key("question").alias("compact"), T.content_tokens("question").alias("live_tokens")))
    cat = cut(catalog.select("item", F.col("survey"), T.norm_question("label").alias("norm"), T.compact_key("item").alias("compact"), T.content_tokens("label").alias("tokens")))

    by_id = explicit.select("qid", T.compact_key("item").alias("compact")).join(cat.groupBy("compact").agg(F.min("item").alias("item")), "compact").select("qid", "item", F.lit(1).alias("step"))
    by_text = live.select("qid", "norm").join(cat.groupBy("norm").agg(F.min("item").alias("item")), "norm").select("qid", "item", F.lit(2).alias("step"))

    longest = cat.agg(F.max(F.length("compact"))).first()[0] or 0
    live_ends = live.where("compact <> ''").select("qid", "survey", F.explode(F.transform(F.sequence(F.lit(1), F.least(F.length("compact"), F.lit(max(longest, 1)))), lambda n: F.right(F.col("compact"), n))).alias("end"))
    item_ends = cat.where("compact <> ''").select("item", "survey", F.explode(F.transform(F.sequence(F.lit(1), F.length("compact")), lambda n: F.right(F.col("compact"), n))).alias("end"))
    suffix = live_ends.join(cat.select("item", "survey", F.col("compact").alias("end")), ["survey", "end"]).select("qid", "item").unionByName(
        live.where("compact <> ''").select("qid", "survey", F.col("compact").alias("end")).join(item_ends, ["survey", "end"]).select("qid", "item")
    )
    by_suffix = suffix.distinct().groupBy("qid").agg(F.count(F.lit(1)).alias("n"), F.min("item").alias("item")).where("n = 1").select("qid", "item", F.lit(3).alias("step"))

    words = live.select("qid", "survey", F.explode(F.array_distinct("live_tokens")).alias("token"))
    common = words.groupBy("survey", "token").agg(F.count(F.lit(1)).alias("n_live"))
    labels = cat.select("item", "survey", "tokens").where(F.size("tokens") >= 2)
    label_words = labels.select("item", "survey", F.size("tokens").alias("n"), F.explode("tokens").alias("token"))
    need = F.size("tokens") - F.ceil(F.lit(coverage) * F.size("tokens") - 1e-9) + 1
    ranked = (
        labels.select("item", "survey", F.explode("tokens").alias("token"))
        .join(common, ["survey", "token"], "left")
        .groupBy("item", "survey")
        .agg(F.array_sort(F.collect_list(F.struct(F.coalesce("n_live", F.lit(0)).alias("n_live"), "token"))).alias("rare"))
        .join(labels, ["item", "survey"])
    )
    probes = ranked.select("item", "survey", F.explode(F.slice("rare", F.lit(1), need.cast("int"))).alias("p")).select("item", "survey", "p.token")
    pairs = words.join(probes, ["survey", "token"]).select("qid", "item", "survey").distinct()
    # Hits are counted by key; no token array travels with a pair.
    scored = (
        pairs.join(label_words, ["item", "survey"])
        .join(words, ["qid", "survey", "token"])
        .groupBy("qid", "item", "survey")
        .agg(F.max("n").alias("n"), F.count(F.lit(1)).cast("int").alias("hit"))
        .withColumn("cov", F.col("hit") / F.col("n"))
        .where(F.col("cov") >= coverage - 1e-12)
    )
    by_tokens = strict_best(scored, ["qid"], ["cov", "hit", "n"], "item").select("qid", "item", F.lit(4).alias("step"))
    found = reduce(lambda a, b: a.unionByName(b), [by_id, by_text, by_suffix, by_tokens])
    return found.groupBy("qid").agg(F.min("step").alias("step"), F.min_by("item", "step").alias("item"))


def strict_best(df: DataFrame, keys: list[str], score: list[str], candidate: str) -> DataFrame:
    """The best candidate of a key by the score columns in order, only when no other ties with it."""
    per = df.groupBy(*keys, *score).agg(F.count(F.lit(1)).alias("n_tied"), F.min(candidate).alias(candidate))
    best = per.groupBy(*keys).agg(F.max_by(F.struct("n_tied", candidate, *score), F.struct(*score)).alias("b"))
    return best.where("b.n_tied = 1").select(*keys, *[f"b.{c}" for c in (candidate, *score)])


# sets ---------------------------------------------------------------------------------------------------------------------
def set_and(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    return a.select(key).intersect(b.select(key))


def set_minus(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    return a.select(key).subtract(b.select(key))


def distinct_persons(df: DataFrame, qids: list[str] | None = None) -> DataFrame:
    if qids is not None:
        df = df.where(F.col("qid").isin(qids))
    return df.select("pid").distinct()
