"""Feature matrices, cross-fitted scores and fold-safe calibration."""

from __future__ import annotations

import statistics

import numpy as np
from pyspark.ml import Pipeline
from pyspark.ml.feature import Imputer, VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import numeric as N
from ..functions import text as T
from ..session import cut
from . import stats as S
from .responses import union_all
from .windows import zscore


# features ------------------------------------------------------------------------------------------------------------------
def ordinal_eligible(answers: DataFrame, values: DataFrame) -> DataFrame:
    """Questions with one answer per person whose answers all have a value. answers: pid, qid, answer; values: qid, answer, value."""
    per = answers.groupBy("qid", "pid").agg(F.count_distinct("answer").alias("n")).groupBy("qid").agg(F.max("n").alias("most"))
    known = answers.select("qid", "answer").distinct().join(values.select("qid", "answer", F.lit(True).alias("k")), ["qid", "answer"], "left")
    return per.join(known.groupBy("qid").agg(F.every(F.col("k").isNotNull()).alias("mapped")), "qid").select("qid", ((F.col("most") == 1) & F.col("mapped")).alias("eligible"))


def branch_recode(answers: DataFrame, rules: DataFrame) -> tuple[DataFrame, DataFrame]:
    """A parent answer implies the child's value where the child is unanswered.

    answers: pid, qid, answer, value; rules: parent_qid, parent_answer, child_qid, value. Returns all rows and audit counts.
    """
    implied = answers.select("pid", F.col("qid").alias("parent_qid"), F.col("answer").alias("parent_answer")).join(rules, ["parent_qid", "parent_answer"])
    implied = implied.groupBy("pid", F.col("child_qid").alias("qid")).agg(F.max("value").alias("value"), F.max(F.struct("parent_qid")).getField("parent_qid").alias("source"))
    added = implied.join(answers.select("pid", "qid").distinct(), ["pid", "qid"], "left_anti")
    rows = answers.select("pid", "qid", "value").withColumn("recoded", F.lit(False)).unionByName(added.select("pid", "qid", "value").withColumn("recoded", F.lit(True)))
    return rows, added.groupBy("source", F.col("qid").alias("child_qid")).agg(F.count(F.lit(1)).alias("n"))


def feature_rows(answers: DataFrame, ordinal: DataFrame) -> DataFrame:
    """Long features (iid, feature, value): took_ and age_at_ per question, ordinal values where eligible, else one-hot options.

    One-hot is 0 for persons who answered another option and absent for persons who did not answer.
    answers: pid, qid, answer, age; ordinal: qid, answer, value for eligible questions only.
    """
    per = answers.groupBy("pid", "qid").agg(F.min("age").alias("age"), F.collect_set("answer").alias("chosen"))
    took = per.select(F.col("pid").alias("iid"), F.concat(F.lit("took_"), "qid").alias("feature"), F.lit(1.0).alias("value"))
    age = per.select(F.col("pid").alias("iid"), F.concat(F.lit("age_at_"), "qid").alias("feature"), F.col("age").alias("value"))
    o = answers.join(ordinal, ["qid", "answer"]).groupBy("pid", "qid").agg(F.max("value").alias("value"))
    o = o.select(F.col("pid").alias("iid"), F.concat(F.lit("ord_"), "qid").alias("feature"), "value")
    rest = per.join(ordinal.select("qid").distinct(), "qid", "left_anti")
    options = answers.select("qid", F.col("answer").alias("option")).distinct()
    hot = rest.join(options, "qid").select(F.col("pid").alias("iid"), F.concat_ws("_", F.lit("is"), "qid", T.slug(T.answer_tail("option"))).alias("feature"), F.array_contains("chosen", F.col("option")).cast("double").alias("value"))
    return union_all([took, age, o, hot])


def feature_matrix(long: DataFrame, columns: list[str]) -> DataFrame:
    """One row per person, one column per listed feature; took_ flags are 0 where absent, everything else null."""
    wide = long.groupBy("iid").pivot("feature", columns).agg(F.max("value"))
    return wide.fillna(0.0, [c for c in columns if c.startswith("took_")])


def feature_report(matrix: DataFrame, columns: list[str]) -> DataFrame:
    """Per feature: persons with a value, missing share, mean, distinct-ness flag; one pass over the matrix."""
    long = matrix.select(*[F.col(c).cast("double").alias(c) for c in columns]).unpivot([], columns, "feature", "v")
    return long.groupBy("feature").agg(F.count("v").alias("n"), F.avg(F.col("v").isNull().cast("double")).alias("missing"), F.avg("v").alias("mean"), (F.min("v") == F.max("v")).alias("constant"))


# folds and fits --------------------------------------------------------------------------------------------------------------
def assign_folds(ids: DataFrame, k: int, seed: int, key: str = "iid") -> DataFrame:
    """Fold by hash of id and seed: the same for every run and partitioning."""
    return ids.withColumn("fold", F.pmod(F.xxhash64(F.col(key), F.lit(seed)), F.lit(k)).cast("int"))


def stable_split(df: DataFrame, share: float, seed: int, model: str, key: str = "iid") -> DataFrame:
    """Early-stop rows of a model, by hash of id, seed and model name."""
    return df.withColumn("early_stop", F.pmod(F.xxhash64(F.col(key), F.lit(seed), F.lit(model)), F.lit(10_000)) < int(share * 10_000))


def booster(rounds: int = 20, depth: int = 3, rate: float = 0.1) -> GBTRegressor:
    return GBTRegressor(featuresCol="_features", labelCol="_label", predictionCol="_pred", maxIter=rounds, maxDepth=depth, stepSize=rate, seed=11)


def _pipeline(features: list[str], model: GBTRegressor) -> Pipeline:
    return Pipeline(stages=[
        Imputer(inputCols=features, outputCols=[f"_f_{c}" for c in features], strategy="median"),
        VectorAssembler(inputCols=[f"_f_{c}" for c in features], outputCol="_features"), model,
    ])


def _rounds(fitted) -> int:
    return fitted.stages[-1].getNumTrees


def cross_fit(
    df: DataFrame, features: list[str], label: str | Column, fold: str = "fold", allowed: Column | None = None, rounds: int = 20, depth: int = 3, early: float = 0.1, seed: int = 11
) -> DataFrame:
    """Out-of-fold predictions for labelled rows and final-model predictions for the rest, with a z over all of them.

    Fold k's model never sees fold k; the final model, at the median of the folds' rounds, predicts rows of role 'applied', which
    train nothing. `allowed` limits the rows of the final fit further (relatives of applied rows). Fits are distributed MLlib fits,
    one after the other; predictions are columns, and the union of the parts is cut once.
    """
    label = F.col(label) if isinstance(label, str) else label
    df = cut(df.withColumn("_label", label.cast("double")).withColumn("_fold", F.col(fold)))
    train = df.where("role = 'oof' and _label is not null")
    folds = sorted(x[0] for x in train.select("_fold").distinct().collect())  # a handful of folds
    keep = [c for c in df.columns if c != "_label"]
    parts, used = [], []
    for k in folds:
        rows = stable_split(train.where(F.col("_fold") != k), early, seed, f"fold{k}")
        model = booster(rounds, depth).setValidationIndicatorCol("early_stop") if early > 0 else booster(rounds, depth)
        fitted = _pipeline(features, model).fit(rows)
        used.append(_rounds(fitted))
        parts.append(fitted.transform(train.where(F.col("_fold") == k)).select(*keep, F.col("_pred").alias("pred")))
    final_rows = train if allowed is None else train.where(allowed)
    final = _pipeline(features, booster(int(statistics.median(used)), depth)).fit(final_rows)
    parts.append(final.transform(df.where("role = 'applied'")).select(*keep, F.col("_pred").alias("pred")))
    return zscore(cut(union_all(parts).drop("_fold")), "pred", None, "pred_z")


def residual_boost(df: DataFrame, features: list[str], base: str, label: str, fold: str = "fold", rounds: int = 10, depth: int = 3) -> DataFrame:
    """Second stage: boosters on what the base prediction leaves of the aligned label, added to the base; same fold rules."""
    out = cross_fit(df, features, F.col(label) - F.col(base), fold, None, rounds, depth)
    return out.withColumn("boosted", F.col(base) + F.col("pred")).drop("pred", "pred_z")


def direct_fit(df: DataFrame, features: list[str], label: str, fold: str = "fold", rounds: int = 20, depth: int = 3) -> DataFrame:
    """A model of the factor target from scratch; same fold rules."""
    return cross_fit(df, features, label, fold, None, rounds, depth).withColumnsRenamed({"pred": "direct", "pred_z": "direct_z"})


def fold_metrics(df: DataFrame, pred: str, target: str, by: str = "fold") -> DataFrame:
    """Per fold and in all: n, correlation, error measures."""
    d = F.col(pred) - F.col(target)
    out = df.where(d.isNotNull()).rollup(by).agg(F.count(F.lit(1)).alias("n"), N.safe_corr(pred, target).alias("r"), F.sqrt(F.avg(d * d)).alias("rmse"), F.avg(F.abs(d)).alias("mae"), F.grouping(by).alias("_all"))
    return out.withColumn("group", F.when(F.col("_all") == 1, "all").otherwise(F.col(by).cast("string"))).drop("_all", by)


def align_label(df: DataFrame, target: str, base: str, mask: Column, out: str = "aligned") -> DataFrame:
    """The target on the scale of the base prediction: base mean + base SD * z of the target, moments from the masked rows."""
    both = mask & F.col(target).isNotNull() & F.col(base).isNotNull()
    one = df.where(both).agg(F.avg(target).alias("_tm"), F.stddev_samp(target).alias("_ts"), F.avg(base).alias("_bm"), F.stddev_samp(base).alias("_bs"))
    return df.crossJoin(F.broadcast(one)).withColumn(out, F.when(F.col("_ts") > 0, F.col("_bm") + F.col("_bs") * (F.col(target) - F.col("_tm")) / F.col("_ts"))).drop("_tm", "_ts", "_bm", "_bs")


def calibrate(df: DataFrame, features: list[str], target: str, fold: str = "fold", allowed: Column | None = None, out: str = "calibrated") -> DataFrame:
    """Linear calibration: each fold by a fit on the other folds, applied rows by a fit on all allowed rows; z over all.

    One aggregation gives the sums of every fold; leaving a fold out is a subtraction of its sums, so the rows are read once.
    """
    cols = [*features, target]
    p = len(features)
    labelled = df.where("role = 'oof'").dropna(subset=cols)
    centre = labelled.agg(*[F.avg(c) for c in cols]).first()  # p + 1 numbers, to keep the sums small
    x = [F.col(c) - F.lit(float(m)) for c, m in zip(cols, centre)]
    ok = F.lit(True) if allowed is None else F.coalesce(allowed, F.lit(False))
    moments = [F.lit(1.0), *x]
    tri = [(i, j) for i in range(p + 2) for j in range(i, p + 2)]
    grams = labelled.groupBy(F.col(fold).alias("k"), ok.alias("ok")).agg(F.array(*[F.sum(moments[i] * moments[j]) for i, j in tri]).alias("s")).collect()  # folds x 2 rows
    sums = {(g["k"], g["ok"]): S.unpack(g["s"], p + 2) for g in grams}
    total = sum(sums.values())

    def solve(m: np.ndarray) -> list[float]:
        a, b = m[: p + 1, : p + 1], m[: p + 1, p + 1]
        return [float(v) for v in np.linalg.lstsq(a, b, rcond=None)[0]]

    fits = [(int(k), solve(total - sum(v for (kk, _), v in sums.items() if kk == k))) for k in sorted({k for k, _ in sums})]
    fits.append((-1, solve(sum(v for (_, good), v in sums.items() if good))))
    table = df.sparkSession.createDataFrame(fits, "_k int, _b array<double>")
    rows = df.withColumn("_k", F.when(F.col("role") == "applied", F.lit(-1)).otherwise(F.col(fold))).join(F.broadcast(table), "_k", "left")  # folds + 1 rows
    value = F.element_at("_b", 1) + F.lit(float(centre[p]))
    for i in range(p):
        value = value + F.element_at("_b", i + 2) * x[i]
    return zscore(rows.withColumn(out, value).drop("_k", "_b"), out, None, f"{out}_z")


def input_package(scores: DataFrame, covars: DataFrame, keep: DataFrame, score_cols: list[str], covar_cols: list[str]) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Phenotype, covariate and keep tables over the same complete persons; fails when their ids differ."""
    whole = scores.dropna(subset=score_cols).join(covars.dropna(subset=covar_cols), "iid").join(keep.select("iid").distinct(), "iid", "left_semi")
    fid = F.coalesce(F.col("fid"), F.col("iid")) if "fid" in whole.columns else F.col("iid")
    pheno = whole.select(fid.alias("FID"), F.col("iid").alias("IID"), *score_cols)
    covar = whole.select(fid.alias("FID"), F.col("iid").alias("IID"), *covar_cols)
    ids = whole.select(fid.alias("FID"), F.col("iid").alias("IID"))
    marked = pheno.select("IID", F.lit(1).alias("a"), F.lit(0).alias("b")).unionByName(covar.select("IID", F.lit(0).alias("a"), F.lit(1).alias("b")))
    if marked.groupBy("IID").agg(F.sum("a").alias("a"), F.sum("b").alias("b")).where("a <> 1 or b <> 1").limit(1).count():
        raise ValueError("phenotype and covariate tables do not hold the same persons once each")
    return pheno, covar, ids
