"""Statistics over the given tables, with the flagship: survey rows to rank-normal residuals."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from ..functions import fixed
from ..operators import aggregates as A
from ..operators import ranks
from ..operators import stats as S
from ..operators import windows as X
from ..session import cut
from . import roles
from .aggregations import rcols
from .registry import query, r, rs, table
from .roles import role, sql


def _poly(coefs, x):
    return reduce(lambda acc, a: f"({acc} * {x} + CAST({a!r} AS DOUBLE))", reversed(coefs[:-1]), f"CAST({coefs[-1]!r} AS DOUBLE)")


def s_ppf(p):
    tail = f"sqrt(-ln(least({p}, 1.0 - {p})))"
    centre = f"(CAST(0.180625 AS DOUBLE) - ({p} - 0.5) * ({p} - 0.5))"
    near, far = f"({tail} - CAST(1.6 AS DOUBLE))", f"({tail} - 5.0)"
    outer = f"(CASE WHEN {tail} <= 5.0 THEN {_poly(fixed.PPF_C, near)} / {_poly(fixed.PPF_D, near)} ELSE {_poly(fixed.PPF_E, far)} / {_poly(fixed.PPF_F, far)} END)"
    return f"(CASE WHEN abs({p} - 0.5) <= 0.425 THEN ({p} - 0.5) * {_poly(fixed.PPF_A, centre)} / {_poly(fixed.PPF_B, centre)} WHEN {p} < 0.5 THEN -{outer} ELSE {outer} END)"


role("ranked", """SELECT *, (rank() OVER (PARTITION BY pheno_id ORDER BY y) + (count(*) OVER (PARTITION BY pheno_id, y) - 1) / CAST(2.0 AS DOUBLE) - CAST(0.5 AS DOUBLE)) / count(*) OVER (PARTITION BY pheno_id) AS pr
 FROM traits""", "traits")
role("normal", f"SELECT pheno_id, iid, y, age, {s_ppf('pr')} AS z FROM ranked", "ranked")


@query("flagship_trait_residuals", sql("single", f"""WITH q AS (SELECT *, (rank() OVER (PARTITION BY qid ORDER BY y) + (count(*) OVER (PARTITION BY qid, y) - 1) / CAST(2.0 AS DOUBLE) - CAST(0.5 AS DOUBLE)) / count(*) OVER (PARTITION BY qid) AS pr FROM single),
 z AS (SELECT qid, pid, age, {s_ppf('pr')} AS z FROM q), b AS (SELECT qid, regr_slope(z, age) AS s, regr_intercept(z, age) AS i FROM z GROUP BY qid)
 SELECT qid AS pheno_id, pid AS iid, {rs('z')} AS z, {rs('z - (i + s * age)')} AS resid FROM z JOIN b USING (qid)"""))
def flagship(spark, sf):
    # The selected responses are written once; ranks, fits and residuals read that table.
    v = cut(roles.single(spark, sf).select(F.col("qid").alias("pheno_id"), F.col("pid").alias("iid"), "y", "age"))
    z = ranks.rank_normal(v, ["pheno_id"], "y", "z")
    return rcols(S.residualize(z, ["pheno_id"], "z", ["age"]).select("pheno_id", "iid", "z", "resid"), "z", "resid")


@query("T1_rank_normal", sql("normal", f"SELECT pheno_id, iid, {rs('z')} AS z FROM normal"))
def _(spark, sf):
    return rcols(ranks.rank_normal(roles.traits(spark, sf), ["pheno_id"], "y").select("pheno_id", "iid", "z"), "z")


def two(y, a, b):
    """Slopes of y on a and b in closed form."""
    d = f"(covar_pop({a}, {a}) * covar_pop({b}, {b}) - covar_pop({a}, {b}) * covar_pop({a}, {b}))"
    return (f"(covar_pop({y}, {a}) * covar_pop({b}, {b}) - covar_pop({y}, {b}) * covar_pop({a}, {b})) / {d} AS b1, (covar_pop({y}, {b}) * covar_pop({a}, {a}) - covar_pop({y}, {a}) * covar_pop({a}, {b})) / {d} AS b2, "
            f"avg({y}) AS my, avg({a}) AS ma, avg({b}) AS mb")


@query("T2_residualize", sql("normal people", f"""WITH d AS (SELECT t.pheno_id, t.iid, t.z, t.age, p.pc1 FROM normal t JOIN people p USING (iid)), b AS (SELECT pheno_id, {two('z', 'age', 'pc1')} FROM d GROUP BY pheno_id)
 SELECT pheno_id, iid, {rs('z - (my + b1 * (age - ma) + b2 * (pc1 - mb))')} AS resid FROM d JOIN b USING (pheno_id)"""))
def _(spark, sf):
    z = ranks.rank_normal(roles.traits(spark, sf), ["pheno_id"], "y").join(roles.people(spark, sf).select("iid", "pc1"), "iid")
    return rcols(S.residualize(z, ["pheno_id"], "z", ["age", "pc1"]).select("pheno_id", "iid", "resid"), "resid")


def s_ols(start, ids, keys, y, xs):
    """CTE chain for a least-squares residual: columns are made orthogonal one after the other. The last CTE is named `fitted`."""
    ctes, src, left = [], start, list(xs)
    key = ", ".join(keys)
    while left:
        x, left = left[0], left[1:]
        rest = [*left, y]
        fit = ", ".join(f"regr_slope({c}, {x}) AS s_{c}, regr_intercept({c}, {x}) AS i_{c}" for c in rest)
        name = "fitted" if not left else f"o{len(left)}"
        join = f"JOIN b{len(left)} USING ({key})" if keys else f"CROSS JOIN b{len(left)}"
        ctes.append(f"b{len(left)} AS (SELECT {key + ', ' if keys else ''}{fit} FROM {src}{' GROUP BY ' + key if keys else ''})")
        ctes.append(f"{name} AS (SELECT {', '.join([*keys, *ids])}, " + ", ".join(f"{c} - (i_{c} + s_{c} * {x}) AS {c}" for c in rest) + f" FROM {src} {join})")
        src = name
    return ", ".join(ctes)


_DESIGN = """WITH c AS (SELECT t.pheno_id, t.iid, t.y, t.age, p.sex_01, p.pc1, p.pc2, p.pc3 FROM traits t JOIN people p USING (iid) WHERE p.sex_01 IS NOT NULL), m AS (SELECT pheno_id, avg(age) AS ma FROM c GROUP BY pheno_id),
 d AS (SELECT pheno_id, iid, y, age - ma AS age_c, sex_01 - CAST(0.5 AS DOUBLE) AS sex_h, (age - ma) * (sex_01 - CAST(0.5 AS DOUBLE)) AS age_sex, pc1, pc2, pc3 FROM c JOIN m USING (pheno_id)), """


@query("T3_covariate_design", sql("traits people", f"""WITH c AS (SELECT t.pheno_id, t.iid, t.y, t.age, p.sex_01, p.pc1, p.pc2 FROM traits t JOIN people p USING (iid) WHERE p.sex_01 IS NOT NULL), m AS (SELECT pheno_id, avg(age) AS ma FROM c GROUP BY pheno_id)
 SELECT pheno_id, iid, {rs('age - ma')} AS age_c, {rs('sex_01 - 0.5')} AS sex_h, {rs('(age - ma) * (sex_01 - 0.5)')} AS age_sex, {rs('pc1')} AS pc1, {rs('pc2')} AS pc2 FROM c JOIN m USING (pheno_id)"""))
def _(spark, sf):
    d, cols = S.design(roles.traits(spark, sf), roles.people(spark, sf), "full", ["pc1", "pc2"])
    return rcols(d.select("pheno_id", "iid", *cols), *cols)


@query("T3_design_residuals", sql("traits people", _DESIGN + s_ols("d", ["iid"], ["pheno_id"], "y", ["age_c", "sex_h", "age_sex", "pc1", "pc2", "pc3"]) + f" SELECT pheno_id, iid, {rs('y', 5)} AS resid FROM fitted"))
def _(spark, sf):
    d, cols = S.design(roles.traits(spark, sf), roles.people(spark, sf), "full", ["pc1", "pc2", "pc3"])
    return S.residualize(d, ["pheno_id"], "y", cols).select("pheno_id", "iid", r("resid", 5).alias("resid"))


@query("T4_eligibility", sql("exact_traits single", """SELECT pheno_id, n, cases, controls, levels, CASE WHEN n < 100 THEN 'too_few_rows' WHEN levels < 3 THEN 'too_few_levels' END AS skip_reason FROM
 (SELECT pheno_id, count(*) AS n, count(*) FILTER (y = 1) AS cases, count(*) FILTER (y = 0) AS controls, count(DISTINCT y) AS levels FROM (SELECT pheno_id, y FROM exact_traits UNION ALL SELECT qid, y FROM single UNION ALL SELECT 'flag', (y > 2)::INT::DOUBLE FROM single) GROUP BY pheno_id)"""))
def _(spark, sf):
    s = roles.single(spark, sf)
    v = roles.exact_traits(spark, sf).select("pheno_id", "y").unionByName(s.select(F.col("qid").alias("pheno_id"), "y")).unionByName(s.select(F.lit("flag").alias("pheno_id"), (F.col("y") > 2).cast("double").alias("y")))
    return S.eligible(A.eligibility_counts(v), "quant", min_n=100)


@query("T4_binary_eligibility", sql("single", """SELECT pheno_id, n, cases, controls, levels, CASE WHEN cases < 20 THEN 'too_few_cases' WHEN controls < 20 THEN 'too_few_controls' END AS skip_reason FROM
 (SELECT qid AS pheno_id, count(*) AS n, count(*) FILTER (y > 2) AS cases, count(*) FILTER (y <= 2) AS controls, count(DISTINCT y > 2) AS levels FROM single GROUP BY qid)"""))
def _(spark, sf):
    v = roles.single(spark, sf).select(F.col("qid").alias("pheno_id"), (F.col("y") > 2).cast("double").alias("y"))
    return S.eligible(A.eligibility_counts(v), "binary", 20, 20)


@query("T5_masked_residual_z", sql("scores", f"""WITH b AS (SELECT {two('target', 'x1', 'x2')} FROM scores WHERE role = 'oof'), d AS (SELECT iid, role, target - (my + b1 * (x1 - ma) + b2 * (x2 - mb)) AS e FROM scores, b)
 SELECT iid, role, {rs('(e - m) / s')} AS z FROM d, (SELECT avg(e) AS m, stddev_samp(e) AS s FROM d WHERE role = 'oof')"""))
def _(spark, sf):
    oof, app = F.col("role") == "oof", F.col("role") == "applied"
    return rcols(S.masked_residual_z(roles.scores(spark, sf), "target", ["x1", "x2"], oof, app).select("iid", "role", "z"), "z")


@query("T6_regression_fit", sql("scores", f"""SELECT segment, n, {rs('my - b1 * ma - b2 * mb')} AS b0, {rs('b1')} AS b1, {rs('b2')} AS b2, {rs('(b1 * c1 + b2 * c2) / v')} AS r2, CAST(3 AS INTEGER) AS rank FROM
 (SELECT segment, count(*) AS n, {two('target', 'x1', 'x2')}, covar_pop(target, x1) AS c1, covar_pop(target, x2) AS c2, var_pop(target) AS v FROM scores GROUP BY segment)"""))
def _(spark, sf):
    f = S.ols_fit(roles.scores(spark, sf), ["segment"], "target", ["x1", "x2"])
    return f.select("segment", "n", r(F.col("beta")[0]).alias("b0"), r(F.col("beta")[1]).alias("b1"), r(F.col("beta")[2]).alias("b2"), r("r2").alias("r2"), "rank")


@query("T7_correlations", sql("scores", f"""WITH k AS (SELECT segment, rank() OVER (PARTITION BY segment ORDER BY x2) + (count(*) OVER (PARTITION BY segment, x2) - 1) / 2.0 AS a, rank() OVER (PARTITION BY segment ORDER BY target) + (count(*) OVER (PARTITION BY segment, target) - 1) / 2.0 AS b FROM scores)
 SELECT segment, n, pearson, spearman FROM (SELECT segment, count(*) AS n, {rs('corr(x2, target)')} AS pearson FROM scores GROUP BY segment) JOIN (SELECT segment, {rs('corr(a, b)')} AS spearman FROM k GROUP BY segment) USING (segment)"""))
def _(spark, sf):
    s = roles.scores(spark, sf)
    p = S.pearson(s, ["segment"], "x2", "target").withColumnRenamed("r", "pearson")
    return rcols(p.join(S.spearman(s, ["segment"], "x2", "target").select("segment", F.col("r").alias("spearman")), "segment"), "pearson", "spearman")


@query("T8_correlation_grid", sql("scores", " UNION ALL ".join(f"SELECT role, '{a}' AS score, '{b}' AS target, count(*) AS n, {rs(f'corr({a}, {b})')} AS r FROM scores GROUP BY role" for a in ("x1", "x2") for b in ("target", "x3"))))
def _(spark, sf):
    return rcols(S.corr_grid(roles.scores(spark, sf), ["role"], ["x1", "x2"], ["target", "x3"]), "r")


@query("T9_winsorized_z", sql("scores", f"""WITH q AS (SELECT quantile_cont(x3, 0.005) AS lo, quantile_cont(x3, 0.995) AS hi FROM scores), w AS (SELECT iid, least(greatest(x3, lo), hi) AS x FROM scores, q)
 SELECT iid, {rs('(x - m) / s')} AS x3 FROM w, (SELECT avg(x) AS m, stddev_samp(x) AS s FROM w)"""))
def _(spark, sf):
    return rcols(S.winsorize(roles.scores(spark, sf).select("iid", "x3"), ["x3"]), "x3")


@query("T10_half_min_positive", f"SELECT {rs('least(min(l_discount) FILTER (l_discount > 0), min(l_tax) FILTER (l_tax > 0)) / 2.0')} AS eps FROM lineitem")
def _(spark, sf):
    return rcols(S.half_min_positive(table(spark, sf, "lineitem"), ["l_discount", "l_tax"]), "eps")


def indicators(spark, sf):
    return roles.scores(spark, sf).select("iid", "x1", "x2", "x3", "target", "segment", "role", (F.col("x3") * 2 + F.col("x1") / 1000.0).alias("x4"))


role("indicators", "SELECT iid, x1, x2, x3, target, segment, role, x3 * 2 + x1 / 1000.0 AS x4 FROM scores", "scores")


@query("T11_redundancy_pruning", sql("indicators", f"SELECT 'x4' AS dropped, iid, {rs('x1')} AS x1, {rs('x2')} AS x2, {rs('x3')} AS x3 FROM indicators WHERE (SELECT corr(x3, x4) FROM indicators) > 0.95"))
def _(spark, sf):
    d = indicators(spark, sf)
    cols = ["x1", "x2", "x3", "x4"]
    left = S.prune_redundant(d, cols, {"x1": 1, "x2": 2, "x3": 3, "x4": 4})
    return rcols(d.select(F.lit(";".join(c for c in cols if c not in left)).alias("dropped"), "iid", *left), *left)


@query("T12_cronbach_alpha", sql("scores", f"SELECT count(*) AS n, {rs('1.5 * (1 - (var_samp(x1) + var_samp(x3) + var_samp(target)) / var_samp(x1 + x3 + target))')} AS alpha FROM scores"))
def _(spark, sf):
    return rcols(S.cronbach_alpha(roles.scores(spark, sf), ["x1", "x3", "target"]), "alpha")


@query("T13_age_sex_z", sql("people", "WITH d AS (SELECT iid, pc1 AS y, age, age * age AS age2, CAST(sex_01 AS DOUBLE) AS sex_d FROM people WHERE sex_01 IS NOT NULL), " + s_ols("d", ["iid"], [], "y", ["age", "age2", "sex_d"])
 + f" SELECT iid, {rs('(y - m) / s')} AS z FROM fitted, (SELECT avg(y) AS m, stddev_samp(y) AS s FROM fitted)"))
def _(spark, sf):
    p = roles.people(spark, sf).where("sex_01 is not null")
    return rcols(S.age_sex_z(p, "pc1").select("iid", "z"), "z")


@query("T14_first_component", sql("scores", f"""WITH m AS (SELECT avg(x2) AS m2, stddev_samp(x2) AS s2, avg(x3) AS m3, stddev_samp(x3) AS s3 FROM scores)
 SELECT iid, {rs('((x2 - m2) / s2 + (x3 - m3) / s3) / sqrt(2.0)')} AS pc1 FROM scores, m"""))
def _(spark, sf):
    return rcols(S.first_pc(roles.scores(spark, sf).select("iid", "x2", "x3"), ["x2", "x3"])[0].select("iid", "pc1"), "pc1")


@query("T15_one_factor_score")
def _(spark, sf):
    return S.one_factor(roles.scores(spark, sf).select("iid", "x1", "x2", "x3", "target"), ["x2", "x3", "target"])[0].select("iid", "factor")


def gappy(spark, sf):
    return roles.scores(spark, sf).select("iid", F.when(F.col("iid") % 3 != 0, F.col("x1")).alias("a"), F.when(F.col("iid") % 4 != 0, F.col("x3")).alias("b"), "target", "role")


role("gappy", "SELECT iid, CASE WHEN iid % 3 <> 0 THEN x1 END AS a, CASE WHEN iid % 4 <> 0 THEN x3 END AS b, target, role FROM scores", "scores")


@query("T16_pattern_scores", sql("gappy", f"""SELECT iid, CASE WHEN a IS NULL THEN '0' ELSE '1' END || CASE WHEN b IS NULL THEN '0' ELSE '1' END AS pattern, {rs('''CASE WHEN a IS NULL AND b IS NULL THEN NULL WHEN b IS NULL THEN a * 0.7 / (0.49 + 0.51) WHEN a IS NULL THEN b * 0.5 / (0.25 + 0.75)
 ELSE (a * 0.7 / 0.51 + b * 0.5 / 0.75) / (1 + 0.49 / 0.51 + 0.25 / 0.75) END''')} AS score FROM gappy"""))
def _(spark, sf):
    return rcols(S.pattern_scores(gappy(spark, sf), ["a", "b"], [0.7, 0.5], [0.51, 0.75]).select("iid", "pattern", "score"), "score")


@query("T17_recommended_scores", sql("scores", f"SELECT iid, {rs('(x1 + x3) / 2')} AS price, {rs('x2')} AS count_task FROM scores"))
def _(spark, sf):
    s = S.unit_mean(roles.scores(spark, sf), ["x1", "x3"], "unit")
    long = s.select("iid", F.lit("price").alias("task"), F.lit("unit").alias("method"), F.col("unit").alias("score"))
    long = long.unionByName(s.select("iid", F.lit("price").alias("task"), F.lit("simple").alias("method"), F.col("x1").alias("score")))
    long = long.unionByName(s.select("iid", F.lit("count_task").alias("task"), F.lit("simple").alias("method"), F.col("x2").alias("score")))
    rules = spark.createDataFrame([("price", "unit"), ("count_task", "simple")], "task string, method string")
    return rcols(S.recommended_scores(long, rules, ["price", "count_task"]), "price", "count_task")


@query("T18_admin_sensitivity", sql("scores", f"""WITH k AS (SELECT segment, row_number() OVER (ORDER BY segment) AS lv FROM (SELECT DISTINCT segment FROM scores)), d AS (SELECT iid, target AS base, target AS y, x1, x2, {', '.join(f'CAST((lv = {i}) AS INTEGER)::DOUBLE AS d{i}' for i in range(2, 6))} FROM scores JOIN k USING (segment)), """
 + s_ols("d", ["iid"], [], "base", ["x1", "x2"]).replace("fitted", "plain").replace("b0", "p0").replace("b1", "p1").replace("o1", "q1") + ", " + s_ols("d", ["iid"], [], "y", ["x1", "x2", "d2", "d3", "d4", "d5"])
 + f" SELECT count(*) AS n, {rs('corr(base, y)')} AS r, CAST((SELECT count(*) FROM k) AS INTEGER) AS n_levels FROM plain JOIN fitted USING (iid)"))
def _(spark, sf):
    return rcols(S.admin_sensitivity(roles.scores(spark, sf), "target", "segment", ["x1", "x2"]), "r")


@query("T19_refit_sensitivity", sql("indicators", f"""WITH b AS (SELECT regr_slope(x3, x1) AS s3, regr_intercept(x3, x1) AS i3, regr_slope(x2, x1) AS s2, regr_intercept(x2, x1) AS i2 FROM indicators WHERE role = 'oof'),
 e AS (SELECT iid, target, x3 - (i3 + s3 * x1) AS e3, x2 - (i2 + s2 * x1) AS e2 FROM indicators, b WHERE role = 'oof'), m AS (SELECT avg(e3) AS m3, stddev_samp(e3) AS d3, avg(e2) AS m2, stddev_samp(e2) AS d2 FROM e)
 SELECT count(*) AS n, {rs('corr(target, ((e3 - m3) / d3 + (e2 - m2) / d2) / 2)')} AS r FROM e, m"""))
def _(spark, sf):
    return rcols(S.refit_sensitivity(indicators(spark, sf), ["x3", "x2"], "target", F.col("role") == "oof", ["x1"]), "r")


@query("T20_bland_altman", f"SELECT count(*) AS n, {rs('avg(l_discount - l_tax)')} AS bias, {rs('avg(l_discount - l_tax) - 1.96 * stddev_samp(l_discount - l_tax)')} AS lower, {rs('avg(l_discount - l_tax) + 1.96 * stddev_samp(l_discount - l_tax)')} AS upper FROM lineitem")
def _(spark, sf):
    return rcols(S.bland_altman(table(spark, sf, "lineitem"), "l_discount", "l_tax"), "bias", "lower", "upper")


@query("T21_candidate_scores", sql("gappy", f"""WITH c AS (SELECT *, CASE WHEN a IS NOT NULL AND b IS NOT NULL THEN (a + b) / 2 ELSE coalesce(a, b) END AS am, CASE WHEN a IS NOT NULL OR b IS NOT NULL THEN (coalesce(a * 0.7, 0) + coalesce(b * 0.5, 0)) / ((a IS NOT NULL)::INT * 0.7 + (b IS NOT NULL)::INT * 0.5) END AS wm FROM gappy),
 m AS (SELECT avg(a) AS ma, stddev_samp(a) AS sa, avg(b) AS mb, stddev_samp(b) AS sb, sign(corr(a, b)) AS g FROM gappy WHERE role = 'oof' AND a IS NOT NULL AND b IS NOT NULL), d AS (SELECT c.*, (a - ma) / sa + (b - mb) / sb AS cp FROM c, m)
 SELECT 'available_mean_z' AS score, 'target' AS target, count(am) AS n, {rs('corr(am, target)')} AS r FROM d UNION ALL SELECT 'weighted_mean_z', 'target', count(wm), {rs('corr(wm, target)')} FROM d"""))
def _(spark, sf):
    c = S.compare_candidates(gappy(spark, sf), ["a", "b"], {"a": 0.7, "b": 0.5}, F.col("role") == "oof", ["target"])
    return rcols(c.where("score <> 'component_z'"), "r")


@query("T21_component_candidate")
def _(spark, sf):
    return S.compare_candidates(gappy(spark, sf), ["a", "b"], {"a": 0.7, "b": 0.5}, F.col("role") == "oof", ["target"]).where("score = 'component_z'")


@query("T22_model_acceptance", sql("scores", f"""WITH l AS (SELECT segment AS model, 'x2' AS i, corr(x2, target) AS loading FROM scores GROUP BY segment UNION ALL SELECT segment, 'x3', corr(x3, target) FROM scores GROUP BY segment),
 p AS (SELECT segment AS model, corr(x2, x3) AS r FROM scores GROUP BY segment), j AS (SELECT model, min(loading) AS ll, count(*) FILTER (loading >= 0.2) AS ns, min(r) AS lr FROM l JOIN p USING (model) GROUP BY model)
 SELECT model, {rs('ll')} AS least_loading, ns AS n_strong, {rs('lr')} AS least_r, coalesce(array_to_string(list_filter([CASE WHEN ll <= 0 THEN 'nonpositive_loading' END, CASE WHEN ns < 2 THEN 'too_few_strong_loadings' END, CASE WHEN lr < -0.05 THEN 'negative_pair_correlation' END], lambda x: x IS NOT NULL), ';'), '') AS reasons,
 NOT (ll <= 0 OR ns < 2 OR lr < -0.05) AS accepted FROM j"""))
def _(spark, sf):
    s = roles.scores(spark, sf)
    loads = S.corr_grid(s, ["segment"], ["x2", "x3"], ["target"]).select(F.col("segment").alias("model"), F.col("r").alias("loading"))
    pair = S.pair_grid(s, ["segment"], ["x2", "x3"]).select(F.col("segment").alias("model"), "r")
    return rcols(S.accept_model(loads, pair, 2), "least_loading", "least_r")


_BANK = {"a": "x3 + 0.2 * x1", "b": "x3 + 0.15 * x2", "c": "x3 + 1.5 * target"}


def _model(third: str) -> str:
    """One-factor score of three indicators in closed form: loadings from the three correlations, regression weights from loadings and uniqueness."""
    return f"""(WITH d AS (SELECT iid, a, b, {third} AS c FROM bank), r AS (SELECT corr(a, b) AS ab, corr(a, c) AS ac, corr(b, c) AS bc, avg(a) AS ma, avg(b) AS mb, avg(c) AS mc, stddev_samp(a) AS sa, stddev_samp(b) AS sb, stddev_samp(c) AS sc FROM d),
 l AS (SELECT *, sqrt(ab * ac / bc) AS la, sqrt(ab * bc / ac) AS lb, sign(ac) * sqrt(ac * bc / ab) AS lc FROM r), w AS (SELECT *, 1 + la * la / (1 - la * la) + lb * lb / (1 - lb * lb) + lc * lc / (1 - lc * lc) AS t FROM l)
 SELECT iid, ((a - ma) / sa * la / (1 - la * la) + (b - mb) / sb * lb / (1 - lb * lb) + (c - mc) / sc * lc / (1 - lc * lc)) / t AS score, concat_ws(';', CASE WHEN least(la, lb, lc) <= 0 THEN 'nonpositive_loading' END,
  CASE WHEN (la >= 0.2)::INT + (lb >= 0.2)::INT + (lc >= 0.2)::INT < 2 THEN 'too_few_strong_loadings' END, CASE WHEN least(ab, ac, bc) < -0.05 THEN 'negative_pair_correlation' END) AS reasons FROM d, w)"""


role("bank", "SELECT iid, " + ", ".join(f"{e} AS {n}" for n, e in _BANK.items()) + " FROM scores", "scores")


def rcols4(df, *names):
    return df.withColumns({n: r(n, 4) for n in names})


@query("T22_model_comparison", sql("bank", f"""SELECT iid, CASE WHEN t.reasons = '' THEN {rs('t.score', 4)} END AS three, t.reasons = '' AS three_accepted, t.reasons AS three_reasons, CASE WHEN u.reasons = '' THEN {rs('u.score', 4)} END AS turned, u.reasons = '' AS turned_accepted,
 u.reasons AS turned_reasons, CASE WHEN u.reasons <> '' THEN {rs('u.score', 4)} END AS turned_forced FROM {_model('c')} t JOIN {_model('-c')} u USING (iid)"""))
def _(spark, sf):
    """Two candidate models over one bank of indicators: the rejected one's score is null, and given in a column of its own as it is forced."""
    s = roles.scores(spark, sf).select("iid", *[F.expr(e).alias(n) for n, e in _BANK.items()]).withColumn("minus_c", -F.col("c"))
    out = S.compare_models(s, {"three": ["a", "b", "c"], "turned": ["a", "b", "minus_c"]}, strong_needed=2, forced={"turned"}).drop("a", "b", "c", "minus_c")
    return rcols4(out, "three", "turned", "turned_forced")


@query("T23_score_pairs", sql("scores", " UNION ALL ".join(f"SELECT role, '{a}' AS a, '{b}' AS b, count(*) AS n, {rs(f'corr({a}, {b})')} AS r FROM scores GROUP BY role" for a, b in (("x1", "x2"), ("x1", "x3"), ("x2", "x3")))))
def _(spark, sf):
    return rcols(S.pair_grid(roles.scores(spark, sf), ["role"], ["x1", "x2", "x3"]), "r")


@query("T24_model_report", sql("gappy", " UNION ALL ".join(f"SELECT '{c}' AS indicator, count({c}) AS n, {rs(f'avg(CASE WHEN {c} IS NULL THEN 1.0 ELSE 0.0 END)')} AS missing, {rs(f'avg({c})')} AS mean, {rs(f'stddev_samp({c})')} AS sd, CAST({l} AS DOUBLE) AS loading, CAST({u} AS DOUBLE) AS uniqueness, {f} AS at_floor FROM gappy" for c, l, u, f in (("a", 0.7, 0.51, "false"), ("b", 0.999, 0.005, "true")))))
def _(spark, sf):
    return rcols(S.model_report(gappy(spark, sf), ["a", "b"], {"a": 0.7, "b": 0.999}, {"a": 0.51, "b": 0.005}), "missing", "mean", "sd")


@query("W9_zscore_by_group_reference", f"SELECT l_orderkey, l_linenumber, l_partkey, {rs('(l_quantity - m) / s')} AS z FROM lineitem, (SELECT avg(l_quantity) AS m, stddev_pop(l_quantity) AS s FROM lineitem)")
def _(spark, sf):
    z = X.zscore(table(spark, sf, "lineitem"), "l_quantity", None, "z", ddof=0)
    return z.select("l_orderkey", "l_linenumber", "l_partkey", r("z").alias("z"))
