"""Ranks, quantiles, regression, factor scores and calibration against numpy on small data."""

import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortloom.operators import features as M
from cohortloom.operators import ranks
from cohortloom.operators import stats as S


def rows(spark, n=400, seed=3):
    g = np.random.default_rng(seed)
    x1, x2 = g.normal(size=n), g.normal(size=n)
    y = 1 + 2 * x1 - 0.5 * x2 + g.normal(size=n)
    k = ["hot" if i % 3 else f"k{i % 5}" for i in range(n)]
    return spark.createDataFrame([(int(i), k[i], float(x1[i]), float(x2[i]), float(y[i])) for i in range(n)], "iid long, k string, x1 double, x2 double, y double")


@pytest.mark.parametrize("buckets", [1, 4, 32])
def test_average_rank_matches_pandas(spark, buckets):
    df = rows(spark).withColumn("v", F.round("x1", 1))
    got = ranks.average_rank(df.select("iid", "k", "v"), ["k"], "v", buckets=buckets).toPandas().set_index("iid").sort_index()
    pdf = df.toPandas().set_index("iid").sort_index()
    assert np.allclose(got["rank"], pdf.groupby("k")["v"].rank())


def test_quantiles_match_numpy(spark):
    df = rows(spark)
    v = np.sort(df.toPandas()["y"])
    got = ranks.exact_quantiles(df, [], "y", {"a": 0.005, "b": 0.5, "c": 0.995}, buckets=16).first()
    assert np.allclose(list(got), np.quantile(v, [0.005, 0.5, 0.995]))
    near = ranks.nearest_rank_quantiles(df, [], "y", {"p": 0.9}, buckets=16).first()["p"]
    assert near == v[round((len(v) - 1) * 0.9)]


def test_residuals_match_lstsq_and_dependent_columns(spark):
    df = rows(spark).withColumn("x3", F.col("x1") * 2)
    got = S.residualize(df, ["k"], "y", ["x1", "x2", "x3"]).toPandas()
    for _, part in got.groupby("k"):
        x = np.column_stack([np.ones(len(part)), part[["x1", "x2", "x3"]]])
        want = part["y"] - x @ np.linalg.lstsq(x, part["y"], rcond=None)[0]
        assert np.allclose(part["resid"], want, atol=1e-9)
    fit = S.ols_fit(df, [], "y", ["x1", "x2", "x3"]).first()
    assert fit["rank"] == 3


def test_rank_normal_residuals(spark):
    v = rows(spark).select(F.lit("t").alias("pheno_id"), "iid", "y", "x1", "x2")
    out = S.rank_normal_residuals(v, ["x1"]).toPandas()
    assert abs(out["resid"].mean()) < 1e-9 and abs(np.corrcoef(out["resid"], out["x1"])[0, 1]) < 1e-9


def test_correlation_guards(spark):
    df = spark.createDataFrame([("a", 1.0, 2.0), ("a", 2.0, 1.0), ("b", 1.0, 1.0), ("b", 1.0, 2.0), ("b", 1.0, 3.0)], "k string, x double, y double")
    assert {r["k"]: r["r"] for r in S.pearson(df, ["k"], "x", "y").collect()} == {"a": None, "b": None}


def test_one_factor_recovers_loadings(spark):
    g = np.random.default_rng(0)
    lam = np.array([0.8, 0.6, 0.7, 0.5])
    f = g.normal(size=4000)
    x = f[:, None] * lam + g.normal(size=(4000, 4)) * np.sqrt(1 - lam**2)
    df = spark.createDataFrame([tuple(map(float, r)) for r in x], "a double, b double, c double, d double")
    scored, info = S.one_factor(df, list("abcd"))
    assert np.allclose(list(info["loadings"].values()), lam, atol=0.06) and info["max_residual"] < 0.05
    assert scored.where("factor is null").count() == 0


def test_first_component_stands_in_where_factors_do_not_settle(spark):
    g = np.random.default_rng(1)
    df = spark.createDataFrame([tuple(map(float, r)) for r in g.normal(size=(200, 3)) + g.normal(size=(200, 1))], "a double, b double, c double")
    scored, info = S.one_factor(df, list("abc"), rounds=1)
    want, _ = S.first_pc(df, list("abc"), "factor")
    assert info["method"] == "first_pc" and [r["factor"] for r in scored.collect()] == [r["factor"] for r in want.collect()]
    assert S.one_factor(df, list("abc"))[1]["method"] == "one_factor"


def test_pattern_weights_full_pattern_equals_matrix_form(spark):
    lam, psi = np.array([0.8, 0.5, 0.3]), np.array([0.36, 0.75, 0.91])
    patterns = spark.createDataFrame([("".join(x),) for x in itertools.product("01", repeat=len(lam))], "pattern string")
    w = {r["pattern"]: r["w"] for r in S.pattern_weights(patterns, list(lam), list(psi)).collect()}
    assert len(w) == 7 and np.allclose(w["111"], np.linalg.solve(np.outer(lam, lam) + np.diag(psi), lam)) and np.isclose(w["010"][1], 0.5)


def test_prune_and_alpha(spark):
    df = rows(spark).withColumn("copy", F.col("x1") + F.col("x2") * 0.01)
    assert S.prune_redundant(df, ["x1", "x2", "copy"], {"x1": 1, "copy": 2}) == ["x1", "x2"]
    x = df.select("x1", "copy").toPandas().to_numpy()
    want = 2 * (1 - x.var(axis=0, ddof=1).sum() / x.sum(axis=1).var(ddof=1))
    assert np.isclose(S.cronbach_alpha(df, ["x1", "copy"]).first()["alpha"], want)


def scored(spark):
    return rows(spark).withColumn("fold", (F.col("iid") % 4).cast("int")).withColumn("role", F.when(F.col("iid") % 7 == 0, "applied").otherwise("oof"))


def test_calibration_leaves_the_fold_out(spark):
    df = scored(spark)
    got = M.calibrate(df, ["x1", "x2"], "y").toPandas()
    for k in range(4):
        fit = got[(got.role == "oof") & (got.fold != k)]
        x = np.column_stack([np.ones(len(fit)), fit[["x1", "x2"]]])
        b = np.linalg.lstsq(x, fit["y"], rcond=None)[0]
        held = got[(got.role == "oof") & (got.fold == k)]
        assert np.allclose(held["calibrated"], np.column_stack([np.ones(len(held)), held[["x1", "x2"]]]) @ b)
    assert np.isclose(got["calibrated_z"].std(), 1.0)


def test_cross_fit_never_sees_its_own_fold(spark):
    """The label of fold 0 is shifted: predictions of fold 0 must not move, those of the other folds must."""
    df = scored(spark).withColumn("fold", F.col("fold") % 2)
    shifted = df.withColumn("y", F.when(F.col("fold") == 0, F.col("y") + 100).otherwise(F.col("y")))
    a, b = (M.cross_fit(d, ["x1", "x2"], "y", rounds=3, depth=2, early=0).where("role = 'oof'").select("iid", "fold", "pred").toPandas().set_index("iid").sort_index() for d in (df, shifted))
    own = a["fold"] == 0
    assert np.allclose(a["pred"][own], b["pred"][own]) and (b["pred"][~own] - a["pred"][~own]).min() > 10


def test_folds_do_not_depend_on_partitions(spark):
    df = rows(spark)
    a = {r["iid"]: r["fold"] for r in M.assign_folds(df.select("iid"), 5, 1).collect()}
    b = {r["iid"]: r["fold"] for r in M.assign_folds(df.select("iid").repartition(7), 5, 1).collect()}
    assert a == b and set(a.values()) == set(range(5))
