"""Features, cross-fitted scores and calibration over the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import features as M
from ..operators import responses as R
from ..operators import vocabulary as Y
from ..session import cut
from . import roles, statistics, traits
from .aggregations import rcols
from .registry import query, r, rs, table
from .roles import role, sql

_ORD, _HOT = ("click", "error"), ("purchase", "signup", "view")
_M1 = {**{f"took_{q}": f"CAST(count(*) FILTER (qid = '{q}') > 0 AS INTEGER)::DOUBLE" for q in traits.QIDS}, **{f"age_at_{q}": rs(f"min(age) FILTER (qid = '{q}')") for q in traits.QIDS},
       **{f"ord_{q}": f"max(right(answer, 1)::DOUBLE * 2) FILTER (qid = '{q}')" for q in _ORD},
       **{f"is_{q}_{i}": f"CASE WHEN count(*) FILTER (qid = '{q}') > 0 THEN CAST(count(*) FILTER (qid = '{q}' AND answer = 'Level: {i}') AS DOUBLE) END" for q in _HOT for i in range(5)}}


def _ordinal(spark):
    levels = spark.range(5).select(F.concat(F.lit("Level: "), F.col("id").cast("string")).alias("answer"), (F.col("id") * 2).cast("double").alias("value"))
    return levels.select(F.explode(F.array(*map(F.lit, _ORD))).alias("qid"), "answer", "value")


@query("M1_feature_matrix", sql("answers", f"SELECT pid AS iid, {', '.join(f'{e} AS {n}' for n, e in _M1.items())} FROM answers GROUP BY pid"))
def _(spark, sf):
    return rcols(M.feature_matrix(M.feature_rows(traits.answers(spark, sf), _ordinal(spark)), list(_M1)), *(f"age_at_{q}" for q in traits.QIDS))


_AREA = {"n_customers": "count(*)", "balance": "avg(c_acctbal)"}


def features(spark, sf):
    """Surveys, areas, numeric, ordinal, one-hot and non-response features of all answers."""
    e = roles.responses(spark, sf).withColumnRenamed("pid", "iid")
    a = traits.answers(spark, sf).withColumnRenamed("pid", "iid")
    people = e.select("iid").distinct().withColumn("place", F.when(F.col("iid") % 7 != 0, F.col("iid") % 25))
    area = table(spark, sf, "customer").groupBy(F.col("c_nationkey").cast("long").alias("place")).agg(*[F.expr(v).cast("double").alias(k) for k, v in _AREA.items()])
    listed = lambda *qids: spark.createDataFrame([(q,) for q in qids], "qid string")
    return R.union_all([
        Y.survey_features(e.select("iid", "survey", "age")), Y.area_features(people, area, "place", list(_AREA)), Y.answer_features(a, _ordinal(spark), listed("purchase")),
        Y.nonresponse_features(e, listed("view", "signup"), F.col("answer") == "PMI: Skip")])


role("m1", f"""SELECT pid AS iid, 'took_' || survey AS feature, 'took' AS kind, NULL AS scope, CAST(1 AS DOUBLE) AS value FROM responses GROUP BY pid, survey
 UNION ALL SELECT pid, 'age_at_' || survey, 'numeric', NULL, max(age) FROM responses GROUP BY pid, survey
 UNION ALL SELECT pid, 'area_' || name, 'numeric', NULL, v FROM (SELECT DISTINCT pid FROM responses) JOIN (UNPIVOT (SELECT c_nationkey, {', '.join(f'CAST({v} AS DOUBLE) AS {k}' for k, v in _AREA.items())} FROM customer GROUP BY 1) ON {', '.join(_AREA)} INTO NAME name VALUE v) ON pid % 7 <> 0 AND pid % 25 = c_nationkey
 UNION ALL SELECT pid, 'q_purchase_num', 'numeric', NULL, max(right(answer, 1)::DOUBLE) FROM answers WHERE qid = 'purchase' GROUP BY pid
 UNION ALL SELECT pid, 'q_' || qid || '_ord', 'ordinal', NULL, max(right(answer, 1)::DOUBLE * 2) FROM answers WHERE qid IN {_ORD} GROUP BY pid, qid
 UNION ALL SELECT DISTINCT pid, 'q_' || qid || '_a_' || right(answer, 1), 'one_hot', qid, CAST(1 AS DOUBLE) FROM answers WHERE qid IN ('signup', 'view')
 UNION ALL SELECT pid, 'q_' || qid || '_nonresponse', 'nonresponse', NULL, CAST(CAST(bool_or(answer = 'PMI: Skip') AS INTEGER) AS DOUBLE) FROM responses WHERE qid IN ('signup', 'view') GROUP BY pid, qid""", "responses answers")
role("m1_catalog", """SELECT CAST(row_number() OVER (ORDER BY feature) - 1 AS INTEGER) AS idx, feature, kind, scope, coalesce(n_scope, n) AS n_known, n_nonzero FROM (SELECT feature, kind, scope, count(DISTINCT iid) AS n, count(*) FILTER (value <> 0) AS n_nonzero FROM m1 GROUP BY ALL)
 LEFT JOIN (SELECT scope AS s, count(DISTINCT iid) AS n_scope FROM m1 WHERE scope IS NOT NULL GROUP BY 1) ON scope = s""", "m1")


@query("M1_sparse_vectors", sql("m1_catalog", f"SELECT iid, idx, {rs('value')} AS value, scopes FROM m1 JOIN m1_catalog USING (feature) JOIN (SELECT iid, array_to_string(list_sort(list(DISTINCT scope)), ',') AS scopes FROM m1 GROUP BY iid) USING (iid)"))
def _(spark, sf):
    """The cells of every person's sparse vector, over the vocabulary of all features."""
    rows = cut(features(spark, sf))
    v = Y.vectors(rows, Y.vocabulary(rows))
    cells = v.select("iid", F.array_join("scopes", ",").alias("scopes"), F.explode(F.arrays_zip("indices", "values")).alias("c"))
    return cells.select("iid", F.col("c.indices").alias("idx"), r(F.col("c.values")).alias("value"), "scopes")


@query("M12_feature_catalog", sql("m1_catalog", "SELECT * FROM m1_catalog"))
def _(spark, sf):
    return Y.vocabulary(cut(features(spark, sf)))


@query("M12_feature_counts", sql("m1_catalog", "SELECT 'feature_columns' AS metric, count(*) AS value FROM m1_catalog UNION ALL SELECT k || '_columns', (SELECT count(*) FROM m1_catalog WHERE kind = k) FROM (SELECT unnest(['took', 'numeric', 'ordinal', 'nonresponse', 'one_hot']) AS k)"))
def _(spark, sf):
    return Y.feature_counts(Y.vocabulary(cut(features(spark, sf))))


@query("M2_ordinal_eligible", """SELECT o_orderpriority AS qid, bool_and(n = 1) AND bool_and(mapped) AS eligible FROM (SELECT o_orderpriority, o_custkey, count(DISTINCT CASE WHEN o_orderpriority < '3' THEN 'P' ELSE o_orderstatus END) AS n, bool_and(o_orderpriority <> '2-HIGH') AS mapped FROM orders GROUP BY ALL) GROUP BY 1""")
def _(spark, sf):
    ans = F.when(F.col("o_orderpriority") < "3", "P").otherwise(F.col("o_orderstatus"))
    a = table(spark, sf, "orders").select(F.col("o_orderpriority").alias("qid"), F.col("o_custkey").alias("pid"), ans.alias("answer"))
    v = a.where("qid <> '2-HIGH'").select("qid", "answer").distinct().withColumn("value", F.lit(1.0))
    return M.ordinal_eligible(a, v)


_RULES = [("signup", "Level: 0", "purchase", 0.0), ("signup", "Level: 1", "purchase", 0.0), ("view", "Level: 0", "click", -1.0)]
_IMPLIED = """SELECT pid, CASE qid WHEN 'signup' THEN 'purchase' ELSE 'click' END AS child, qid AS source, CASE qid WHEN 'signup' THEN 0.0 ELSE -1.0 END AS value FROM single WHERE y < 3 AND ((qid = 'signup' AND y IN (0, 1)) OR (qid = 'view' AND y = 0))"""


def recoded(spark, sf):
    a = roles.single(spark, sf).where("y <> 4 or qid <> 'purchase'").select("pid", "qid", "answer", F.col("y").alias("value"))
    return M.branch_recode(a, spark.createDataFrame(_RULES, "parent_qid string, parent_answer string, child_qid string, value double"))


role("branch", "SELECT pid, qid, y AS value FROM single WHERE y <> 4 OR qid <> 'purchase'", "single")


@query("M3_branch_recode", sql("branch", f"SELECT pid, qid, value, false AS recoded FROM branch UNION ALL SELECT pid, child, value, true FROM ({_IMPLIED}) i WHERE NOT EXISTS (SELECT 1 FROM branch b WHERE b.pid = i.pid AND b.qid = i.child)"))
def _(spark, sf):
    return recoded(spark, sf)[0]


@query("M3_branch_audit", sql("branch", f"SELECT source, child AS child_qid, count(*) AS n FROM ({_IMPLIED}) i WHERE NOT EXISTS (SELECT 1 FROM branch b WHERE b.pid = i.pid AND b.qid = i.child) GROUP BY ALL"))
def _(spark, sf):
    return recoded(spark, sf)[1]


@query("M4_fold_assignment")
def _(spark, sf):
    return M.assign_folds(roles.people(spark, sf).select("iid"), 5, 11)


FEATURES = ["x1", "x2", "x3"]


@query("M5_cross_fitted_scores")
def _(spark, sf):
    return M.cross_fit(roles.scores(spark, sf), FEATURES, "target", rounds=5, depth=2).select("iid", "role", "fold", "pred", "pred_z")


@query("M6_fold_metrics", sql("scores", f"""SELECT coalesce(CAST(fold AS VARCHAR), 'all') AS "group", count(*) AS n, {rs('corr(x3 / 4.0, target)')} AS r, {rs('sqrt(avg((x3 / 4.0 - target) * (x3 / 4.0 - target)))')} AS rmse, {rs('avg(abs(x3 / 4.0 - target))')} AS mae FROM scores GROUP BY ROLLUP (fold)"""))
def _(spark, sf):
    s = roles.scores(spark, sf).withColumn("pred", F.col("x3") / 4.0)
    return rcols(M.fold_metrics(s, "pred", "target"), "r", "rmse", "mae")


@query("M7_aligned_label", sql("scores", f"""SELECT iid, {rs('bm + bs * (target - tm) / ts')} AS aligned FROM scores, (SELECT avg(target) AS tm, stddev_samp(target) AS ts, avg(x3) AS bm, stddev_samp(x3) AS bs FROM scores WHERE role = 'oof')"""))
def _(spark, sf):
    return rcols(M.align_label(roles.scores(spark, sf), "target", "x3", F.col("role") == "oof").select("iid", "aligned"), "aligned")


@query("M8_residual_boost")
def _(spark, sf):
    s = M.align_label(roles.scores(spark, sf), "target", "x3", F.col("role") == "oof")
    return M.residual_boost(s, ["x1", "x2"], "x3", "aligned", rounds=3, depth=2).select("iid", "role", "boosted")


@query("M9_stable_split")
def _(spark, sf):
    return M.stable_split(roles.people(spark, sf).select("iid"), 0.1, 11, "model_a")


@query("M10_direct_fit")
def _(spark, sf):
    return M.direct_fit(roles.scores(spark, sf), FEATURES, "target", rounds=3, depth=2).select("iid", "role", "direct", "direct_z")


def calibrated(spark, sf):
    return M.calibrate(roles.scores(spark, sf), ["x3"], "target", allowed=F.col("x1") > 0)


@query("M11_fold_safe_calibration", sql("scores", f"""WITH o AS (SELECT f.fold AS k, regr_slope(s.target, s.x3) AS b, regr_intercept(s.target, s.x3) AS a FROM (SELECT DISTINCT fold FROM scores) f JOIN scores s ON s.fold <> f.fold AND s.role = 'oof' GROUP BY f.fold),
 g AS (SELECT regr_slope(target, x3) AS b, regr_intercept(target, x3) AS a FROM scores WHERE role = 'oof' AND x1 > 0), c AS (SELECT iid, role, CASE WHEN role = 'applied' THEN g.a + g.b * x3 ELSE o.a + o.b * x3 END AS calibrated FROM scores JOIN o ON o.k = fold, g)
 SELECT iid, role, {rs('calibrated')} AS calibrated, {rs('(calibrated - m) / s')} AS calibrated_z FROM c, (SELECT avg(calibrated) AS m, stddev_samp(calibrated) AS s FROM c)"""))
def _(spark, sf):
    return rcols(calibrated(spark, sf).select("iid", "role", "calibrated", "calibrated_z"), "calibrated", "calibrated_z")


@query("M12_feature_report", sql("gappy", " UNION ALL ".join(f"SELECT '{c}' AS feature, count({c}) AS n, {rs(f'avg(CASE WHEN {c} IS NULL THEN 1.0 ELSE 0.0 END)')} AS missing, {rs(f'avg({c})')} AS mean, min({c}) = max({c}) AS constant FROM gappy" for c in ("a", "b", "target"))))
def _(spark, sf):


    return rcols(M.feature_report(statistics.gappy(spark, sf), ["a", "b", "target"]), "missing", "mean")


@query("M13_input_package", sql("scores people", f"""SELECT iid AS "IID", {rs('target')} AS target, sex_01, {rs('age')} AS age FROM scores JOIN people USING (iid) WHERE sex_01 IS NOT NULL AND iid IN (SELECT o_custkey FROM orders WHERE o_totalprice > 200000)"""))
def _(spark, sf):
    keep = table(spark, sf, "orders").where("o_totalprice > 200000").select(F.col("o_custkey").alias("iid"))
    pheno, covar, _ = M.input_package(roles.scores(spark, sf).select("iid", "target"), roles.people(spark, sf).select("iid", "sex_01", "age"), keep, ["target"], ["sex_01", "age"])
    return pheno.join(covar.drop("FID"), "IID").select("IID", r("target").alias("target"), "sex_01", r("age").alias("age"))
