"""Regression, correlation and factor scores. Rows are reduced to sums in executors; only p x p systems are solved outside of SQL."""

from __future__ import annotations

from functools import reduce
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType

from ..functions import fixed
from ..functions import numeric as N
from ..session import cut
from . import ranks
from .windows import zscore


# least squares ---------------------------------------------------------------------------------------------------------------
def gram(df: DataFrame, keys: list[str], xs: list[str], y: str) -> DataFrame:
    """Centred second moments of complete rows per key, in one pass with partial aggregation (stable covariance updates)."""
    cols = [*xs, y]
    whole = df.dropna(subset=cols)
    pairs = [(i, j) for i in range(len(cols)) for j in range(i, len(cols))]
    return whole.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), F.array(*[F.avg(c) for c in cols]).alias("means"), F.array(*[F.covar_pop(cols[i], cols[j]) for i, j in pairs]).alias("cov")
    )


def unpack(cov, p: int) -> np.ndarray:
    m = np.zeros((p, p))
    m[np.triu_indices(p)] = np.asarray(cov, dtype=float)
    return m + np.triu(m, 1).T


def solve_gram(grams: DataFrame, p: int) -> DataFrame:
    """Coefficients (intercept first), rank and R2 for every Gram row; minimum-norm when columns are dependent. No shuffle."""
    schema = grams.drop("means", "cov").schema.add("beta", ArrayType(DoubleType())).add("rank", IntegerType()).add("r2", DoubleType())
    names = schema.names

    def solve(batches):
        for pdf in batches:
            betas, ranks_, r2s = [], [], []
            for means, cov in zip(pdf["means"], pdf["cov"]):
                m, mean = unpack(cov, p + 1), np.asarray(means, dtype=float)
                sxx, sxy, syy = m[:p, :p], m[:p, p], m[p, p]
                scale = np.sqrt(np.where(np.diag(sxx) > 0, np.diag(sxx), 1.0))
                b = np.linalg.pinv(sxx / np.outer(scale, scale), rcond=1e-12, hermitian=True) @ (sxy / scale) / scale
                betas.append([float(mean[p] - b @ mean[:p]), *map(float, b)])
                ranks_.append(int(np.linalg.matrix_rank(sxx / np.outer(scale, scale), tol=1e-10, hermitian=True)) + 1)
                r2s.append(float(b @ sxy / syy) if syy > 0 else None)
            yield pdf.drop(columns=["means", "cov"]).assign(beta=betas, rank=ranks_, r2=r2s)[names]

    return grams.mapInPandas(solve, schema)


def ols_fit(df: DataFrame, keys: list[str], y: str, xs: list[str]) -> DataFrame:
    """Fit per key: n, coefficients, rank, R2; keys with too few rows are skipped."""
    return solve_gram(gram(df, keys, xs, y).where(F.col("n") > len(xs) + 1), len(xs))


def predicted(xs: list[str], beta: str = "beta") -> Column:
    return reduce(lambda a, ix: a + F.element_at(beta, ix[0] + 2) * F.col(ix[1]), enumerate(xs), F.element_at(beta, 1))


def residualize(df: DataFrame, keys: list[str], y: str, xs: list[str], out: str = "resid", fit_on: Column | None = None) -> DataFrame:
    """y minus its fit on the covariates, per key; rows with a missing value drop out. `fit_on` restricts the rows of the fit.

    Coefficients have one row per key: at run time they are broadcast when small, otherwise the join splits hot keys.
    """
    fit = ols_fit(df if fit_on is None else df.where(fit_on), keys, y, xs).select(*keys, "beta")
    rows = df.dropna(subset=xs)
    joined = rows.join(fit, keys) if keys else rows.crossJoin(F.broadcast(fit))
    return joined.withColumn(out, F.col(y) - predicted(xs)).drop("beta")


def design(values: DataFrame, people: DataFrame, mode: str = "full", pcs: list[str] = (), extras: list[str] = ()) -> tuple[DataFrame, list[str]]:
    """Trait rows with their covariates, centred within the complete cases of the trait.

    full: age, sex - 0.5, their product, components; agepc: age and components; sexpc: sex and components.
    """
    need = ["age", "sex_01", *pcs] if mode != "agepc" else ["age", *pcs]
    rows = values.join(people.select("iid", *[c for c in ("sex_01", *pcs) if c in people.columns]), "iid").dropna(subset=["y", *need, *extras])
    centred = ["age", *extras]
    means = rows.groupBy("pheno_id").agg(*[F.avg(c).alias(f"_m_{c}") for c in centred])
    rows = rows.join(means, "pheno_id")
    for c in centred:
        rows = rows.withColumn(f"{c}_c", F.col(c) - F.col(f"_m_{c}")).drop(f"_m_{c}")
    rows = rows.withColumn("sex_h", F.col("sex_01") - 0.5).withColumn("age_sex", F.col("age_c") * (F.col("sex_01") - 0.5))
    base = {"full": ["age_c", "sex_h", "age_sex"], "agepc": ["age_c"], "sexpc": ["sex_h"]}[mode]
    return rows, [*base, *pcs, *[f"{c}_c" for c in extras]]


def eligible(counts: DataFrame, kind: str, min_cases=fixed.MIN_CASES, min_controls=fixed.MIN_CONTROLS, min_n=fixed.MIN_QUANT_N, min_levels=fixed.MIN_LEVELS) -> DataFrame:
    """Traits with enough cases and controls (binary) or rows and levels (quantitative), with the reason of a skip."""
    if kind == "binary":
        reason = F.when(F.col("cases") < min_cases, "too_few_cases").when(F.col("controls") < min_controls, "too_few_controls")
    else:
        reason = F.when(F.col("n") < min_n, "too_few_rows").when(F.col("levels") < min_levels, "too_few_levels")
    return counts.withColumn("skip_reason", reason)


def masked_residual_z(df: DataFrame, y: str, xs: list[str], train: Column, apply: Column) -> DataFrame:
    """Fit on the training rows, residuals of the other rows scaled by the training residuals."""
    resid = residualize(df, [], y, xs, "resid", fit_on=train)
    return zscore(resid, "resid", train, "z").where(apply | train)


def age_sex_z(df: DataFrame, y: str) -> DataFrame:
    """z of y after age, age squared and sex."""
    rows = df.withColumn("age2", F.col("age") * F.col("age")).withColumn("sex_d", F.col("sex_01").cast("double"))
    return zscore(residualize(rows, [], y, ["age", "age2", "sex_d"], "resid"), "resid").drop("age2", "sex_d", "resid")


# correlation -----------------------------------------------------------------------------------------------------------------
def _guarded(a: str, b: str, min_n: int) -> tuple[Column, Column]:
    both = F.col(a).isNotNull() & F.col(b).isNotNull()
    n = F.count_if(both)
    return n, F.when(n >= min_n, N.safe_corr(a, b))


def pearson(df: DataFrame, keys: list[str], a: str, b: str, min_n: int = 3) -> DataFrame:
    n, c = _guarded(a, b, min_n)
    return df.groupBy(*keys).agg(n.alias("n"), c.alias("r"))


def spearman(df: DataFrame, keys: list[str], a: str, b: str, min_n: int = 3) -> DataFrame:
    """Pearson correlation of average ranks among complete pairs."""
    d = df.where(F.col(a).isNotNull() & F.col(b).isNotNull())
    return pearson(ranks.average_ranks(d, keys, {a: "_ra", b: "_rb"}), keys, "_ra", "_rb", min_n)


def corr_grid(df: DataFrame, keys: list[str], scores: list[str], targets: list[str], min_n: int = 3) -> DataFrame:
    """Group x score x target correlations from one aggregation of the wide rows."""
    pairs = [(s, t) for s in scores for t in targets]
    aggs = []
    for i, (s, t) in enumerate(pairs):
        n, c = _guarded(s, t, min_n)
        aggs += [n.alias(f"n{i}"), c.alias(f"r{i}")]
    one = df.groupBy(*keys).agg(*aggs)
    rows = F.array(*[F.struct(F.lit(s).alias("score"), F.lit(t).alias("target"), F.col(f"n{i}").alias("n"), F.col(f"r{i}").alias("r")) for i, (s, t) in enumerate(pairs)])
    return one.select(*keys, F.explode(rows).alias("x")).select(*keys, "x.*")


def pair_grid(df: DataFrame, keys: list[str], cols: list[str], min_n: int = 3) -> DataFrame:
    """Correlations of all unordered pairs of the listed columns."""
    pairs = list(combinations(cols, 2))
    aggs = []
    for i, (s, t) in enumerate(pairs):
        n, c = _guarded(s, t, min_n)
        aggs += [n.alias(f"n{i}"), c.alias(f"r{i}")]
    one = df.groupBy(*keys).agg(*aggs)
    rows = F.array(*[F.struct(F.lit(s).alias("a"), F.lit(t).alias("b"), F.col(f"n{i}").alias("n"), F.col(f"r{i}").alias("r")) for i, (s, t) in enumerate(pairs)])
    return one.select(*keys, F.explode(rows).alias("x")).select(*keys, "x.*")


def bland_altman(df: DataFrame, a: str, b: str) -> DataFrame:
    d = F.col(a) - F.col(b)
    return df.agg(F.count(d).alias("n"), F.avg(d).alias("bias"), (F.avg(d) - 1.96 * F.stddev_samp(d)).alias("lower"), (F.avg(d) + 1.96 * F.stddev_samp(d)).alias("upper"))


# indicators ------------------------------------------------------------------------------------------------------------------
def winsorize(df: DataFrame, cols: list[str], lo: float = fixed.WINSOR_LO, hi: float = fixed.WINSOR_HI, z: bool = True) -> DataFrame:
    """Clip each column at its exact interpolated quantiles, then scale to z."""
    each = F.array(*[F.struct(F.lit(c).alias("_col"), F.col(c).cast("double").alias("_v")) for c in cols])
    q = ranks.quantiles(df.select(F.explode(each).alias("e")).select("e.*"), ["_col"], "_v", exact={"_lo": lo, "_hi": hi})  # one histogram for all columns
    limit = lambda side, i, c: F.max(F.when(F.col("_col") == c, F.col(side))).alias(f"{side}{i}")
    row = q.agg(*[limit(side, i, c) for i, c in enumerate(cols) for side in ("_lo", "_hi")])
    clipped = {c: F.when(F.col(c).isNotNull(), F.least(F.greatest(F.col(c), F.col(f"_lo{i}")), F.col(f"_hi{i}"))) for i, c in enumerate(cols)}
    out = df.crossJoin(F.broadcast(row)).withColumns(clipped).drop(*row.columns)  # a single row
    if z:
        one = out.agg(*[f(c).alias(f"{name}{i}") for i, c in enumerate(cols) for name, f in (("_m", F.avg), ("_s", F.stddev_samp))])
        scaled = {c: F.when(F.col(f"_s{i}") > 0, (F.col(c) - F.col(f"_m{i}")) / F.col(f"_s{i}")) for i, c in enumerate(cols)}
        out = out.crossJoin(F.broadcast(one)).withColumns(scaled).drop(*one.columns)  # a single row
    return out


def half_min_positive(df: DataFrame, cols: list[str]) -> DataFrame:
    """Half of the least positive value over all the columns."""
    return df.agg(F.min(F.least(*[F.coalesce(F.when(F.col(c) > 0, F.col(c)), F.lit(float("inf"))) for c in cols])).alias("m")).select(
        F.when(F.col("m") < float("inf"), F.col("m") / 2.0).alias("eps")
    )


def prune_redundant(df: DataFrame, cols: list[str], priority: dict[str, int], limit: float = fixed.REDUNDANT_R) -> list[str]:
    """Names left after dropping, from the strongest pair down, the lower-priority member of each pair beyond the limit."""
    pairs = pair_grid(df, [], cols).where(F.abs("r") > limit).collect()  # at most tens of names
    dropped: set[str] = set()
    for p in sorted(pairs, key=lambda x: (-abs(x["r"]), x["a"], x["b"])):
        if p["a"] not in dropped and p["b"] not in dropped:
            dropped.add(max((p["a"], p["b"]), key=lambda n: (priority.get(n, 99), n)))
    return [c for c in cols if c not in dropped]


def cronbach_alpha(df: DataFrame, cols: list[str]) -> DataFrame:
    k = len(cols)
    total = reduce(lambda a, b: a + b, [F.col(c) for c in cols])
    whole = df.dropna(subset=cols)
    items = reduce(lambda a, b: a + b, [F.var_samp(c) for c in cols])
    return whole.agg(F.count(F.lit(1)).alias("n"), F.when(F.var_samp(total) > 0, F.lit(k / (k - 1.0)) * (1 - items / F.var_samp(total))).alias("alpha"))


# factor models ---------------------------------------------------------------------------------------------------------------
def moments(df: DataFrame, cols: list[str]) -> tuple[int, np.ndarray, np.ndarray]:
    """n, means and the sample correlation-ready covariance of complete rows: p x p numbers reach the driver, never rows."""
    p = len(cols)
    pairs = [(i, j) for i in range(p) for j in range(i, p)]
    row = df.dropna(subset=cols).agg(
        F.count(F.lit(1)).alias("n"), F.array(*[F.avg(c) for c in cols]).alias("means"), F.array(*[F.covar_samp(cols[i], cols[j]) for i, j in pairs]).alias("cov")
    ).first()
    return row["n"], np.asarray(row["means"], float), unpack(row["cov"], p)


def standardized(df: DataFrame, cols: list[str], mean: np.ndarray, cov: np.ndarray) -> list[Column]:
    return [(F.col(c) - F.lit(float(m))) / F.lit(float(s)) for c, m, s in zip(cols, mean, np.sqrt(np.where(np.diag(cov) > 0, np.diag(cov), 1.0)))]


def dot(columns: list[Column], weights) -> Column:
    return reduce(lambda a, b: a + b, [c * F.lit(float(w)) for c, w in zip(columns, weights)])


def first_pc(df: DataFrame, cols: list[str], out: str = "pc1") -> tuple[DataFrame, dict]:
    """Score on the first principal component of the standardized columns; the sum of the loadings is not negative."""
    n, mean, cov = moments(df, cols)
    sd = np.sqrt(np.diag(cov))
    values, vectors = np.linalg.eigh(cov / np.outer(sd, sd))
    v = vectors[:, -1] * (1 if vectors[:, -1].sum() >= 0 else -1)
    info = {"n": n, "loadings": dict(zip(cols, map(float, v))), "explained": float(values[-1] / values.sum())}
    return df.dropna(subset=cols).withColumn(out, dot(standardized(df, cols, mean, cov), v)), info


def factor_loadings(corr: np.ndarray, floor: float = 0.005, rounds: int = 5000, tol: float = 1e-10) -> tuple[np.ndarray, np.ndarray]:
    """One-factor maximum likelihood by EM on a correlation matrix; uniqueness is kept above the floor."""
    p = len(corr)
    values, vectors = np.linalg.eigh(corr)
    lam = vectors[:, -1] * np.sqrt(max(values[-1] - 1.0 / p, 0.1))
    psi = np.clip(1 - lam**2, floor, None)
    for turn in range(rounds + 1):
        if turn == rounds:
            raise ArithmeticError(f"factor loadings did not settle in {rounds} rounds")
        w = (lam / psi) / (1 + np.sum(lam**2 / psi))
        s_w = corr @ w
        new = s_w / (1 - w @ lam + w @ s_w)
        psi_new = np.clip(np.diag(corr) - new * s_w, floor, None)
        done = max(np.abs(new - lam).max(), np.abs(psi_new - psi).max()) < tol
        lam, psi = new, psi_new
        if done:
            break
    return (lam if lam.sum() >= 0 else -lam), psi


def one_factor(df: DataFrame, cols: list[str], floor: float = 0.005, out: str = "factor", rounds: int = 5000) -> tuple[DataFrame, dict]:
    """Regression score of a one-factor model with its diagnostics; the first component stands in when the fit fails or does not settle, as `method` tells."""
    n, mean, cov = moments(df, cols)
    sd = np.sqrt(np.diag(cov))
    corr = cov / np.outer(sd, sd)
    try:
        lam, psi = factor_loadings(corr, floor, rounds)
        failed = not (np.all(np.isfinite(lam)) and np.all(np.isfinite(psi)))
    except (ArithmeticError, np.linalg.LinAlgError):
        failed = True
    if failed:
        scored, info = first_pc(df, cols, out)
        return scored, {**info, "method": "first_pc"}
    implied = np.outer(lam, lam) + np.diag(psi)
    off = ~np.eye(len(cols), dtype=bool)
    info = {
        "method": "one_factor", "n": n, "loadings": dict(zip(cols, map(float, lam))), "uniqueness": dict(zip(cols, map(float, psi))),
        "max_residual": float(np.abs((corr - implied)[off]).max()) if len(cols) > 1 else 0.0, "mean": mean, "cov": cov,
    }
    return df.dropna(subset=cols).withColumn(out, dot(standardized(df, cols, mean, cov), np.linalg.solve(implied, lam))), info


def pattern_weights(patterns: DataFrame, loadings: list[float], uniqueness: list[float]) -> DataFrame:
    """Regression weights of each pattern of observed columns that occurs ('101' = first and third); the empty pattern has none."""
    lam, psi = np.asarray(loadings, float), np.asarray(uniqueness, float)

    def solve(batches):
        for b in batches:
            rows = []
            for pattern in b["pattern"]:
                seen = [i for i, c in enumerate(pattern) if c == "1"]
                w = np.zeros(len(lam))
                w[seen] = np.linalg.solve(np.outer(lam[seen], lam[seen]) + np.diag(psi[seen]), lam[seen])
                rows.append((pattern, w.tolist()))
            yield pd.DataFrame(rows, columns=["pattern", "w"])

    return patterns.where(F.col("pattern").contains("1")).mapInPandas(solve, "pattern string, w array<double>")


def pattern_scores(df: DataFrame, cols: list[str], loadings: list[float], uniqueness: list[float], out: str = "score") -> DataFrame:
    """Factor score from whatever standardized indicators a row has; rows without any have none."""
    pattern = F.concat(*[F.when(F.col(c).isNull(), "0").otherwise("1") for c in cols])
    rows = df.withColumn("pattern", pattern)
    j = rows.join(cut(pattern_weights(rows.select("pattern").distinct(), loadings, uniqueness)), "pattern", "left")
    value = reduce(lambda a, ic: a + F.element_at("w", ic[0] + 1) * F.coalesce(ic[1], F.lit(0.0)), enumerate(cols), F.lit(0.0))
    return j.withColumn(out, value).drop("w")


def unit_mean(df: DataFrame, cols: list[str], out: str = "unit", need: int = 1) -> DataFrame:
    """Mean of the available columns."""
    seen = F.array_compact(F.array(*[F.col(c) for c in cols]))
    return df.withColumn(out, F.when(F.size(seen) >= need, F.aggregate(seen, F.lit(0.0), lambda a, x: a + x) / F.size(seen)))


def weighted_mean(df: DataFrame, weights: dict[str, float], out: str = "weighted") -> DataFrame:
    """Sum of w x over sum of w, over the available columns."""
    top = reduce(lambda a, b: a + b, [F.coalesce(F.col(c) * w, F.lit(0.0)) for c, w in weights.items()])
    low = reduce(lambda a, b: a + b, [F.when(F.col(c).isNotNull(), F.lit(float(w))).otherwise(0.0) for c, w in weights.items()])
    return df.withColumn(out, F.when(low != 0, top / low))


def recommended_scores(scores: DataFrame, rules: DataFrame, names: list[str]) -> DataFrame:
    """Long (iid, task, method, score) to one recommended score per task, wide: the rule table names the method of each task."""
    return scores.join(rules, ["task", "method"]).groupBy("iid").pivot("task", names).agg(F.max("score"))  # one rule per task


def lump_rare(df: DataFrame, col: str, least: int = 20, other: str = "other") -> DataFrame:
    """Levels with fewer rows than `least` become one level."""
    common = df.groupBy(col).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") >= least).select(F.col(col), F.lit(True).alias("_keep"))
    return df.join(common, col, "left").withColumn(col, F.when(F.col("_keep"), F.col(col)).otherwise(F.lit(other))).drop("_keep")


def admin_sensitivity(df: DataFrame, score: str, category: str, covars: list[str], least: int = 20) -> DataFrame:
    """Correlation of the score's z with the z after category effects are added to the covariates.

    A dummy per category gives the residuals of regressing within categories: score and covariates less their category means, joined as
    a table, so any number of categories will do.
    """
    used = [score, *covars]
    rows = lump_rare(df, category, least).dropna(subset=used)
    means = rows.groupBy(category).agg(*[F.avg(c).alias(f"_m{i}") for i, c in enumerate(used)])
    n_levels = means.count()
    rows = rows.join(means, category).withColumns({f"_w{i}": F.col(c) - F.col(f"_m{i}") for i, c in enumerate(used)})
    base = zscore(residualize(rows, [], score, covars, "_r0"), "_r0", None, "base_z")
    again = zscore(residualize(base, [], "_w0", [f"_w{i}" for i in range(1, len(used))], "_r1"), "_r1", None, "adjusted_z")
    return pearson(again, [], "base_z", "adjusted_z").withColumn("n_levels", F.lit(n_levels))


def refit_sensitivity(df: DataFrame, cols: list[str], base: str, subset: Column | None = None, covars: list[str] = ()) -> DataFrame:
    """Unit-mean score refitted on a subset or on residualized indicators, correlated with the primary score."""
    rows = df if subset is None else df.where(subset)
    used = []
    for c in cols:
        if covars:
            rows = residualize(rows, [], c, list(covars), f"_{c}")
        used.append(f"_{c}" if covars else c)
        rows = zscore(rows, used[-1], None, f"_z_{c}")
    return pearson(unit_mean(rows, [f"_z_{c}" for c in cols], "_again"), [], base, "_again")


def compare_candidates(df: DataFrame, cols: list[str], weights: dict[str, float], mask: Column, targets: list[str]) -> DataFrame:
    """Available mean, available weighted mean and complete-case component score, each z by the reference rows, against the targets."""
    n, mean, cov = moments(df.where(mask), cols)
    sd = np.sqrt(np.diag(cov))
    _, vectors = np.linalg.eigh(cov / np.outer(sd, sd))
    v = vectors[:, -1] * (1 if vectors[:, -1].sum() >= 0 else -1)
    rows = weighted_mean(unit_mean(df, cols, "available_mean"), weights, "weighted_mean").withColumn("component", dot(standardized(df, cols, mean, cov), v))
    for c in ("available_mean", "weighted_mean", "component"):
        rows = zscore(rows, c, mask, f"{c}_z")
    return corr_grid(rows, [], ["available_mean_z", "weighted_mean_z", "component_z"], targets)


def accept_model(loadings: DataFrame, pair_r: DataFrame, strong_needed: int, strong: float = fixed.WEAK_LOADING, least_r: float = -0.05) -> DataFrame:
    """Per model: accepted when every loading is positive, enough are strong and no pair correlates below the limit; with reasons."""
    per = loadings.groupBy("model").agg(F.min("loading").alias("least_loading"), F.count_if(F.col("loading") >= strong).alias("n_strong"))
    j = per.join(pair_r.groupBy("model").agg(F.min("r").alias("least_r")), "model", "left")
    reasons = F.array_compact(F.array(
        F.when(F.col("least_loading") <= 0, "nonpositive_loading"), F.when(F.col("n_strong") < strong_needed, "too_few_strong_loadings"), F.when(F.col("least_r") < least_r, "negative_pair_correlation"),
    ))
    return j.withColumn("reasons", F.array_join(reasons, ";")).withColumn("accepted", F.size(reasons) == 0)


def moment_bank(df: DataFrame, candidates: dict[str, list[str]]) -> dict[str, tuple[int, np.ndarray, np.ndarray]]:
    """n, means and covariances of every candidate's complete rows, from one pass over the rows; a few numbers per candidate reach the driver."""
    parts = []
    for name, cols in candidates.items():
        there = reduce(lambda a, c: a & F.col(c).isNotNull(), cols, F.lit(True))
        v = [F.when(there, F.col(c).cast("double")) for c in cols]
        pairs = [F.covar_samp(v[i], v[j]) for i in range(len(cols)) for j in range(i, len(cols))]
        parts += [F.count_if(there).alias(f"{name}:n"), F.array(*[F.avg(x) for x in v]).alias(f"{name}:means"), F.array(*pairs).alias(f"{name}:cov")]
    row = df.agg(*parts).first()
    return {name: (row[f"{name}:n"], np.asarray(row[f"{name}:means"], float), unpack(row[f"{name}:cov"], len(cols))) for name, cols in candidates.items()}


def compare_models(df: DataFrame, candidates: dict[str, list[str]], strong_needed: int, forced: set[str] = frozenset(), floor: float = 0.005, rounds: int = 5000) -> DataFrame:
    """One-factor scores of several candidate models, each decided by the acceptance rule.

    Per model: its score (null for incomplete rows, and for all rows if the model is rejected), `_accepted`, `_reasons`, and for forced models `_forced`, the score of a
    rejected one. All models are read from one moment bank; decisions come from one table of loadings and pair correlations. A model whose loadings do not settle, or whose
    indicators do not vary, is rejected.
    """
    fits, loads, pairs = {}, [], []
    for name, (n, mean, cov) in moment_bank(df, candidates).items():
        cols, sd = candidates[name], np.sqrt(np.diag(cov))
        try:
            if n < 3 or not (np.isfinite(sd).all() and (sd > 0).all()):
                raise ArithmeticError("no variation")
            corr = cov / np.outer(sd, sd)
            lam, psi = factor_loadings(corr, floor, rounds)
            fits[name] = (mean, cov, np.linalg.solve(np.outer(lam, lam) + np.diag(psi), lam))
            loads += [(name, float(x)) for x in lam]
            pairs += [(name, float(corr[i, j])) for i in range(len(cols)) for j in range(i)]
        except (ArithmeticError, np.linalg.LinAlgError):
            fits[name] = None
    spark = df.sparkSession
    verdict = {r.model: r for r in accept_model(spark.createDataFrame(loads, "model string, loading double"), spark.createDataFrame(pairs, "model string, r double"), strong_needed).collect()}  # a row per model
    out = {}
    for name, cols in candidates.items():
        fit, rule = fits[name], verdict.get(name)
        accepted = fit is not None and rule.accepted
        score = F.lit(None).cast("double") if fit is None else dot(standardized(df, cols, fit[0], fit[1]), fit[2])
        out |= {name: score if accepted else F.lit(None).cast("double"), f"{name}_accepted": F.lit(bool(accepted)), f"{name}_reasons": F.lit("not_settled" if fit is None else rule.reasons)}
        if name in forced:
            out[f"{name}_forced"] = F.lit(None).cast("double") if accepted else score
    return df.withColumns(out)


def model_report(df: DataFrame, cols: list[str], loadings: dict[str, float], uniqueness: dict[str, float], floor: float = 0.005) -> DataFrame:
    """Per indicator: rows, missing share, mean, SD, loading, uniqueness and whether it sits at the floor."""
    long = df.select(*[F.col(c).cast("double").alias(c) for c in cols]).unpivot([], cols, "indicator", "v")
    agg = long.groupBy("indicator").agg(F.count("v").alias("n"), F.avg(F.col("v").isNull().cast("double")).alias("missing"), F.avg("v").alias("mean"), F.stddev_samp("v").alias("sd"))
    info = df.sparkSession.createDataFrame([(c, float(loadings[c]), float(uniqueness[c]), bool(uniqueness[c] <= floor * (1 + 1e-9))) for c in cols], "indicator string, loading double, uniqueness double, at_floor boolean")
    return agg.join(F.broadcast(info), "indicator")


def rank_normal_residuals(values: DataFrame, covars: list[str], binary: bool = False) -> DataFrame:
    """Residuals per trait: quantitative traits are rank-normalized first, binary ones are not."""
    rows = values if binary else ranks.rank_normal(values, ["pheno_id"], "y", "y_used")
    return residualize(rows.withColumn("y_used", F.col("y")) if binary else rows, ["pheno_id"], "y_used", covars)


def log10_p(beta: Column, se: Column, df: Column) -> Column:
    """log10 of the two-sided p-value; runs on the small (variant, trait) result only."""
    return N.log10_p_of_t(beta / se, df)


