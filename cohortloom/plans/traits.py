"""Rule tables and trait builders over the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import builders as B
from ..operators import composites as C
from ..operators import criteria as K
from ..operators import responses as R
from ..operators import rules as U
from ..operators import sparse_traits as Q
from ..operators import windows as X
from . import roles
from .aggregations import rcols
from .registry import query, r, rs, table
from .roles import role, sql

QIDS = ["click", "error", "purchase", "signup", "view"]
role("wide", "SELECT pid, " + ", ".join(f"max(y) FILTER (qid = '{q}') AS v_{q}, max(age) FILTER (qid = '{q}') AS a_{q}" for q in QIDS) + " FROM single GROUP BY pid", "single")
role("long_answers", "SELECT DISTINCT pid, qid, ts, age AS age0, answer FROM latest", "latest")
role("answers", "SELECT l.pid, l.qid, l.answer, s.age FROM long_answers l JOIN selected s USING (pid, qid)", "long_answers selected")


def wide(spark, sf):
    return B.by_question(roles.single(spark, sf), QIDS)


def answers(spark, sf):
    return R.answers_long(roles.selected(spark, sf)).select("pid", "qid", "answer", "age")


def as_iid(df):
    return df.withColumnRenamed("pid", "iid")


# rule tables -----------------------------------------------------------------------------------------------------------------
_RULES = "SELECT p_type AS rule, 'level ' || CAST(lv AS VARCHAR) AS label, CAST(lv * 2 AS DOUBLE) AS value, lv = 4 AS local_missing FROM (SELECT DISTINCT p_type FROM part), (SELECT unnest(range(0, 5)) AS lv)"


@query("P12_rule_values", f"""WITH rules AS ({_RULES}), d AS (SELECT p_partkey, p_type AS rule, 'Grade: Level ' || CAST(p_size % 6 AS VARCHAR) || CASE WHEN p_size % 4 = 0 THEN '; often' ELSE '.' END AS answer, p_size % 6 AS lv FROM part)
 SELECT p_partkey, CASE WHEN lv < 4 THEN value WHEN lv = 5 AND d.rule = (SELECT min(p_type) FROM part) THEN CAST(55 AS DOUBLE) END AS value FROM d LEFT JOIN rules ON rules.rule = d.rule AND rules.label = 'level ' || CAST(lv AS VARCHAR)""")
def _(spark, sf):
    p = table(spark, sf, "part")
    tail = F.when(F.col("p_size") % 4 == 0, "; often").otherwise(".")
    d = p.select("p_partkey", F.col("p_type").alias("rule"), F.concat(F.lit("Grade: Level "), (F.col("p_size") % 6).cast("string"), tail).alias("answer"))
    lv = F.explode(F.sequence(F.lit(0), F.lit(4))).alias("lv")
    rules = p.select(F.col("p_type").alias("rule")).distinct().select("rule", lv).select("rule", F.concat(F.lit("level "), F.col("lv").cast("string")).alias("label"), (F.col("lv") * 2).cast("double").alias("value"), (F.col("lv") == 4).alias("local_missing"))
    # one rule knows level 5 by override; level 4 is missing there although an override has a value, and levels 0 to 3 keep the rule's value
    first = p.agg(F.min("p_type").alias("rule"))
    over = first.select("rule", F.explode(F.sequence(F.lit(3), F.lit(5))).alias("lv")).select("rule", F.concat(F.lit("level "), F.col("lv").cast("string")).alias("label"), (F.col("lv") + 50).cast("double").alias("value"))
    return U.apply_rules(d, rules, over).select("p_partkey", "value")


@query("B1_one_vs_rest", sql("answers", f"""SELECT 'bin_' || a.qid || '_' || right(o.answer, 1) AS pheno_id, a.pid AS iid, CAST(list_contains(a.c, o.answer) AS INTEGER)::DOUBLE AS y, {rs('a.age')} AS age
 FROM (SELECT pid, qid, list(answer) AS c, min(age) AS age FROM answers GROUP BY ALL) a JOIN (SELECT DISTINCT qid, answer FROM answers) o USING (qid)"""))
def _(spark, sf):
    return rcols(B.one_vs_rest(answers(spark, sf)).select("pheno_id", "iid", "y", "age"), "age")


MANIFEST = [("click", "binary_only", False, "", "clicks"), ("view", "ordinal_and_binary", False, "grown_up", "views"), ("error", "excluded_date", False, "", "errors"), ("purchase", "nominal_binary", True, "", "purchases"), ("signup", "flagged_review", False, "", "sign-up")]
MIN_AGES = [("grown_up", 45.0), ("unused", 1.0)]
_YES = "CASE WHEN qid = 'signup' THEN CASE WHEN answer IN ('Level: 3', 'Level: 4') THEN 'Yes' ELSE 'No, never' END ELSE answer END"
role("polled", f"SELECT pid, qid, {_YES} AS answer, min(age) AS age FROM (SELECT * FROM answers UNION ALL SELECT pid, 'extra', 'Level: 1', age FROM answers WHERE qid = 'click' AND pid % 3 = 0) GROUP BY 1, 2, 3", "answers")
role("sparse", f"""WITH m AS (SELECT * FROM (VALUES {", ".join(str(x).replace("False", "false").replace("True", "true") for x in MANIFEST)}) v(qid, disposition, multi, rule, question)), g AS (SELECT p.* FROM polled p LEFT JOIN m USING (qid) LEFT JOIN (VALUES {", ".join(map(str, MIN_AGES))}) a(rule, min_age) USING (rule) WHERE min_age IS NULL OR age >= min_age),
 n AS (SELECT qid, answer, count(DISTINCT pid) AS n FROM g GROUP BY ALL), t AS (SELECT qid, count(DISTINCT pid) AS total FROM g GROUP BY qid), k AS (SELECT qid, count(*) AS options FROM n GROUP BY qid),
 c AS (SELECT s.qid, s.answer, 'bin_' || s.qid || '_' || CASE s.answer WHEN 'Yes' THEN 'yes' WHEN 'No, never' THEN 'no_never' ELSE right(s.answer, 1) END AS pheno_id, n_seen, coalesce(n, 0) AS n_cases, coalesce(total - n, 0) AS n_controls, disposition, multi, options, question, rule
  FROM (SELECT qid, answer, count(DISTINCT pid) AS n_seen FROM polled GROUP BY ALL) s LEFT JOIN n USING (qid, answer) LEFT JOIN t USING (qid) LEFT JOIN m USING (qid) LEFT JOIN k USING (qid))
 SELECT *, CASE WHEN disposition IS NULL THEN 'not_in_manifest' WHEN starts_with(disposition, 'excluded') THEN 'excluded' WHEN n_cases = 0 THEN 'below_min_age' WHEN options = 2 AND NOT multi AND answer <> 'Yes' THEN 'redundant_complement' WHEN n_cases < 5 OR n_controls < 5 THEN 'too_few' ELSE 'made' END AS status FROM c""", "polled")


def sparse(spark, sf):
    a = answers(spark, sf)
    a = a.unionByName(a.where("qid = 'click' and pid % 3 = 0").select("pid", F.lit("extra").alias("qid"), F.lit("Level: 1").alias("answer"), "age"))
    a = a.withColumn("answer", F.expr(_YES)).groupBy("pid", "qid", "answer").agg(F.min("age").alias("age"))
    known = spark.createDataFrame(MANIFEST, "qid string, disposition string, multi boolean, rule string, question string")
    return Q.build(a, known, spark.createDataFrame(MIN_AGES, "rule string, min_age double"), spark.createDataFrame([], "qid string, answer string, value double"), 5, 5)


@query("B1_sparse_cases", sql("sparse", "SELECT pheno_id, pid AS iid FROM polled JOIN sparse USING (qid, answer) WHERE status = 'made' AND (rule <> 'grown_up' OR age >= 45)"))
def _(spark, sf):
    """Cases of all traits that pass disposition, least age and complement rules."""
    return sparse(spark, sf).cases


@query("B31_answer_coverage", sql("sparse", "SELECT qid, answer, pheno_id, n_seen, n_cases, n_controls, status FROM sparse"))
def _(spark, sf):
    return sparse(spark, sf).catalog.select("qid", "answer", "pheno_id", "n_seen", "n_cases", "n_controls", "status")


@query("B32_dictionary", sql("sparse", """SELECT pheno_id, question, rule, status, CASE WHEN status = 'redundant_complement' THEN 'complement_of:bin_' || qid || '_yes' END AS construction_id, 'answered ''' || answer || ''' to ' || question AS case_wording,
 CASE WHEN multi THEN 'question shown, option not selected' ELSE 'any other valid answer to ' || question END AS control_wording FROM sparse WHERE disposition IS NOT NULL"""))
def _(spark, sf):
    """Wording and source of every trait whose question is in the manifest."""
    return sparse(spark, sf).catalog.where("question is not null").select("pheno_id", "question", "rule", "status", "construction_id", "case_wording", "control_wording")


_BATCH = [f"bin_click_{i}" for i in range(5)] + ["bin_signup_yes", "bin_purchase_2"]


@query("B1_sparse_batch", sql("sparse", f"""WITH g AS (SELECT pid, qid, answer FROM polled WHERE qid IN ('click', 'signup', 'purchase')) SELECT pid AS iid, {', '.join(f"CASE WHEN bool_or(qid = '{n.split('_')[1]}') AND '{n}' IN (SELECT pheno_id FROM sparse WHERE status = 'made') THEN CAST(CAST(bool_or(p = '{n}') AS INTEGER) AS DOUBLE) END AS {n}" for n in _BATCH)}
 FROM (SELECT g.*, CASE WHEN status = 'made' THEN pheno_id ELSE '' END AS p FROM g JOIN sparse USING (qid, answer)) WHERE qid IN (SELECT qid FROM sparse WHERE status = 'made' AND pheno_id IN ({', '.join(f"'{n}'" for n in _BATCH)})) GROUP BY pid"""))
def _(spark, sf):
    return Q.wide_batch(sparse(spark, sf), _BATCH)


@query("B2_complement_collapse", """WITH a AS (SELECT DISTINCT o_orderpriority AS qid, o_custkey AS pid, CASE WHEN o_custkey % 3 = 0 THEN 'Yes' WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'No, never' ELSE CASE WHEN o_custkey % 3 = 1 THEN 'Other' ELSE 'No' END END AS answer FROM orders),
 o AS (SELECT qid, answer, count(*) OVER (PARTITION BY qid) AS n FROM (SELECT DISTINCT qid, answer FROM a))
 SELECT qid, answer, CASE WHEN n <> 2 THEN 'kept' WHEN answer = 'Yes' THEN 'kept_complement' ELSE 'skipped_complement' END AS status FROM o""")
def _(spark, sf):
    k, p = F.col("o_custkey") % 3, F.col("o_orderpriority")
    ans = F.when(k == 0, "Yes").when(p.isin("1-URGENT", "2-HIGH"), "No, never").when(k == 1, "Other").otherwise("No")
    a = table(spark, sf, "orders").select(p.alias("qid"), F.col("o_custkey").alias("pid"), ans.alias("answer")).distinct()
    return B.collapse_complement(a, a.select("qid", "answer").distinct().withColumn("value", F.lit(None).cast("double")))


@query("B3_ordinal_trait", sql("single", f"""SELECT pid, qid, CASE WHEN qid = 'click' AND y = 4 THEN CAST(99 AS DOUBLE) WHEN qid IN ('click', 'view') THEN y * 10 ELSE y + 1 END AS y, {rs('age')} AS age FROM single WHERE qid IN ('click', 'view', 'signup')"""))
def _(spark, sf):
    s = roles.single(spark, sf).select("pid", "qid", F.col("qid").alias("item"), F.concat(F.lit("How often <b>"), "qid", F.lit("</b>?")).alias("question"), "answer", "age")
    lv = spark.range(5).select(F.col("id").cast("string").alias("label"), F.col("id").cast("double").alias("v"))
    live = lv.where("label = '4'").select(F.lit("click").alias("item"), "label", F.lit(99.0).alias("value"))
    items = lv.select(F.explode(F.array(F.lit("click"), F.lit("view"))).alias("item"), "label", (F.col("v") * 10).alias("value"))
    texts = lv.select(F.lit("how often signup").alias("question"), "label", (F.col("v") + 1).alias("value"))
    o = U.ordinal_trait(s, live, items, texts)
    return rcols(o.select("pid", "qid", "y", "age"), "age")


@query("B4_numeric_trait", f"""SELECT 'num_' || l_returnflag AS pheno_id, l_orderkey * 100 + l_linenumber AS iid, l_quantity AS y FROM lineitem WHERE (l_returnflag = 'A' AND l_quantity BETWEEN 5 AND 20) OR (l_returnflag = 'N' AND l_quantity BETWEEN 0 AND 15) OR l_returnflag = 'R'""")
def _(spark, sf):
    li = table(spark, sf, "lineitem").select((F.col("l_orderkey") * 100 + F.col("l_linenumber")).alias("pid"), F.col("l_returnflag").alias("qid"), F.col("l_quantity").cast("string").alias("answer"), F.lit(30.0).alias("age"))
    ranges = spark.createDataFrame([("A", 5.0, 20.0), ("N", 0.0, 15.0), ("R", None, None)], "qid string, lo double, hi double")
    return B.numeric_trait(li, ranges, integer=True).select("pheno_id", "iid", "y")


@query("B5_min_age", sql("traits", f"SELECT pheno_id, iid, {rs('y')} AS y, age FROM traits WHERE NOT (pheno_id = '1-URGENT' AND age < 26) AND NOT (pheno_id = '5-LOW' AND age < 60)"))
def _(spark, sf):
    rules = spark.createDataFrame([("1-URGENT", 26.0), ("5-LOW", 60.0)], "pheno_id string, min_age double")
    return rcols(B.min_age(roles.traits(spark, sf), rules), "y")


role("pooled", """SELECT pid, item, arg_min(y, p) AS y, arg_min(age, p) AS age, min(p) AS from_fill FROM (SELECT pid, qid AS item, y, age, 0 AS p FROM single WHERE qid IN ('click', 'view', 'error')
 UNION ALL SELECT pid, CASE qid WHEN 'purchase' THEN 'click' ELSE 'view' END, y, age, 1 FROM single WHERE qid IN ('purchase', 'signup')) GROUP BY pid, item""", "single")


def pooled(spark, sf):
    s = roles.items(spark, sf)
    fill = s.where("item in ('purchase', 'signup')").withColumn("item", F.when(F.col("item") == "purchase", "click").otherwise("view"))
    return B.pooled_items(s.where("item in ('click', 'view', 'error')"), fill)


@query("B6_pooled_items", sql("pooled", f"SELECT pid, item, y, {rs('age')} AS age, from_fill FROM pooled"))
def _(spark, sf):
    return rcols(pooled(spark, sf), "age")


@query("B6_pooled_scale", sql("pooled", f"SELECT pid AS iid, {rs('avg(CASE WHEN item = $$view$$ THEN 4 - y ELSE y END) * 3')} AS y, {rs('avg(age)')} AS age, max(from_fill) AS from_fill, count(*) AS n_valid FROM pooled GROUP BY pid HAVING count(*) >= 2".replace("$$", "'")))
def _(spark, sf):
    rev = spark.createDataFrame([("view", 4.0)], "item string, top double")
    return rcols(B.pooled_scale(pooled(spark, sf), rev, 3), "y", "age")


@query("B7_harmonize", sql("single", "SELECT pid, qid, CAST(CASE y WHEN 0 THEN 0 WHEN 1 THEN 1 WHEN 2 THEN 1 WHEN 3 THEN 2 END AS DOUBLE) AS y FROM single WHERE y < 4"))
def _(spark, sf):
    m = spark.createDataFrame([(0.0, 0.0), (1.0, 1.0), (2.0, 1.0), (3.0, 2.0)], "source double, target double")
    return U.harmonize(roles.single(spark, sf).select("pid", "qid", "y"), m)


_SCREEN = "CASE WHEN v_signup >= 2 THEN 1 WHEN v_signup < 2 THEN 0 END"


def screen(c="v_signup"):
    return F.when(F.col(c) >= 2, 1).when(F.col(c) < 2, 0)


@query("B8_short_scale", sql("wide", f"""SELECT pid, CASE WHEN n >= 2 THEN {rs('s / n * 3')} END AS standard, CASE WHEN g = 0 THEN 0.0 WHEN g = 1 AND n >= 2 THEN {rs('s / n * 3')} END AS population FROM
 (SELECT pid, {_SCREEN} AS g, (v_click IS NOT NULL)::INT + (v_view IS NOT NULL)::INT + (v_error IS NOT NULL)::INT AS n, coalesce(v_click, 0) + coalesce(v_view, 0) + coalesce(v_error, 0) AS s FROM wide)"""))
def _(spark, sf):
    w = wide(spark, sf)
    items = [F.col("v_click"), F.col("v_view"), F.col("v_error")]
    yes = F.lit(1)
    standard = B.symptom_sum(items, yes)
    return w.select("pid", r(standard).alias("standard"), F.when(screen() == 0, F.lit(0.0)).when(screen() == 1, r(standard)).alias("population"))


@query("B9_paired_sum", sql("pooled", f"SELECT pid AS iid, {rs('avg(y) * 2')} AS y, max(from_fill) AS from_fill FROM pooled WHERE item IN ('click', 'error') GROUP BY pid HAVING count(*) = 2"))
def _(spark, sf):
    none = spark.createDataFrame([], "item string, top double")
    return rcols(B.pooled_scale(pooled(spark, sf).where("item in ('click', 'error')"), none, 2, complete=True).select("iid", "y", "from_fill"), "y")


@query("B10_gated_floor", sql("wide", f"""SELECT 'floor_minus1' AS pheno_id, pid AS iid, CASE WHEN g = 0 THEN CAST(-1 AS DOUBLE) ELSE v_purchase END AS y, {rs('CASE WHEN g = 0 THEN a_signup ELSE coalesce(a_purchase, a_signup) END')} AS age FROM (SELECT *, {_SCREEN} AS g FROM wide) WHERE g = 0 OR (g = 1 AND v_purchase IS NOT NULL)
 UNION ALL SELECT 'floor_0', pid, CASE WHEN g = 0 THEN CAST(0 AS DOUBLE) ELSE v_error END, {rs('CASE WHEN g = 0 THEN a_signup ELSE coalesce(a_error, a_signup) END')} FROM (SELECT *, {_SCREEN} AS g FROM wide) WHERE g = 0 OR (g = 1 AND v_error BETWEEN 1 AND 3)"""))
def _(spark, sf):
    w = wide(spark, sf)
    a = B.gated_trait(w, "floor_minus1", screen(), F.col("v_purchase"), ["a_purchase", "a_signup"], -1)
    b = B.gated_trait(w, "floor_0", screen(), F.col("v_error"), ["a_error", "a_signup"], 0, 1, 3)
    return rcols(a.unionByName(b), "age")


@query("B10_activity_and_packs", f"""SELECT l_orderkey, l_linenumber, {rs('q * d * 1000 * 8 + q * t * 1000 * 4 + q * 10 * CAST(3.3 AS DOUBLE)')} AS met, {rs('CASE WHEN q BETWEEN 0 AND 200 AND t * 1000 BETWEEN 0 AND 100 THEN q / 20.0 * (t * 1000) END')} AS packs
 FROM (SELECT l_orderkey, l_linenumber, l_quantity AS q, l_discount AS d, l_tax AS t FROM lineitem)""")
def _(spark, sf):
    li = table(spark, sf, "lineitem")
    q, d, t = F.col("l_quantity"), F.col("l_discount") * 1000, F.col("l_tax") * 1000
    met = B.activity_minutes({"vigorous": q, "moderate": q, "walking": q}, {"vigorous": d, "moderate": t, "walking": F.lit(10.0)})
    return li.select("l_orderkey", "l_linenumber", r(met).alias("met"), r(B.pack_years(q, t)).alias("packs"))


_GATE = "SELECT pid, CASE WHEN max(y) > 1 THEN 'reporter' WHEN count(*) = 3 THEN 'screen_negative' END AS gate, count(*) AS n_valid FROM single WHERE qid IN ('click', 'view', 'error') GROUP BY pid"


def gates(spark, sf):
    s = roles.items(spark, sf).where("item in ('click', 'view', 'error')")
    return B.battery_gate(s.withColumn("y", F.col("y") - 1), 3)


@query("B11_battery_gate", sql("single", _GATE))
def _(spark, sf):
    return gates(spark, sf)


@query("B11_ground_breadth", sql("single answers", f"""SELECT pid AS iid, CASE WHEN gate = 'screen_negative' THEN CAST(-1 AS DOUBLE) ELSE CAST(n AS DOUBLE) END AS y FROM ({_GATE}) LEFT JOIN
 (SELECT pid, count(DISTINCT answer) AS n FROM answers WHERE qid IN ('signup', 'purchase') GROUP BY pid) USING (pid) WHERE gate = 'screen_negative' OR (gate = 'reporter' AND n IS NOT NULL)"""))
def _(spark, sf):
    g = answers(spark, sf).where("qid in ('signup', 'purchase')").select("pid", F.col("answer").alias("ground"))
    return B.breadth(gates(spark, sf), g)


_RELS = ["Self", "Mother", "Daughter", "Grandmother", "None"]
_RELCASE = "CASE right(answer, 1) " + " ".join(f"WHEN '{i}' THEN 'Condition - {x}'" for i, x in enumerate(_RELS)) + " END"


def family(spark, sf):
    a = answers(spark, sf)
    return a.where("qid = 'click'").withColumn("answer", F.expr(_RELCASE)), a.where("qid = 'view'").select("pid", "age")


@query("B12_self_history", sql("answers", f"""SELECT coalesce(s.pid, c.pid) AS iid, CASE WHEN c.pid IS NULL THEN 0.0 ELSE 1.0 END::DOUBLE AS y, {rs('coalesce(c.age, s.age)')} AS age FROM (SELECT pid, min(age) AS age FROM answers WHERE qid = 'view' GROUP BY pid) s
 FULL JOIN (SELECT pid, min(age) AS age FROM answers WHERE qid = 'click' AND answer = 'Level: 0' GROUP BY pid) c ON s.pid = c.pid"""))
def _(spark, sf):
    chosen, done = family(spark, sf)
    return rcols(B.self_history(chosen.where(T.relation_norm("answer") == "self"), done), "age")


@query("B12_family_burden", sql("answers", f"""SELECT coalesce(s.pid, c.pid) AS iid, coalesce(c.w, 0)::DOUBLE AS y, {rs('coalesce(c.age, s.age)')} AS age FROM (SELECT pid, min(age) AS age FROM answers WHERE qid = 'view' GROUP BY pid) s
 FULL JOIN (SELECT pid, min(age) AS age, sum(CASE right(answer, 1) WHEN '0' THEN 1 WHEN '1' THEN 0.5 WHEN '2' THEN 0.5 WHEN '3' THEN 0.25 ELSE 0 END) AS w FROM answers WHERE qid = 'click' GROUP BY pid) c ON s.pid = c.pid"""))
def _(spark, sf):
    chosen, done = family(spark, sf)
    return rcols(B.family_burden(chosen, done), "age")


@query("B13_composite_scales", sql("single", f"""WITH i AS (SELECT * FROM (VALUES ('mood', 'i1', 'click', 1, false), ('mood', 'i1', 'signup', 2, false), ('mood', 'i2', 'view', 1, true), ('mood', 'i3', 'error', 1, false), ('drive', 'd1', 'purchase', 1, true)) v(instrument, item, qid, place, rev)),
 f AS (SELECT instrument, pid, item, arg_min(CASE WHEN rev THEN 4 - y ELSE y END, place) AS v, arg_min(age, place) AS age FROM single JOIN i USING (qid) GROUP BY ALL)
 SELECT instrument AS pheno_id, pid AS iid, {rs("avg(v) * CASE instrument WHEN 'mood' THEN 3 ELSE 1 END")} AS y, {rs('arg_max(age, item)')} AS age, count(*) AS n_valid FROM f GROUP BY instrument, pid HAVING count(*) >= CASE instrument WHEN 'mood' THEN 2 ELSE 1 END"""))
def _(spark, sf):
    rows = [("mood", "i1", "click", 1, False), ("mood", "i1", "signup", 2, False), ("mood", "i2", "view", 1, True), ("mood", "i3", "error", 1, False), ("drive", "d1", "purchase", 1, True)]
    si = spark.createDataFrame([(*x[:4], 0.0, 4.0, x[4]) for x in rows], "instrument string, item string, qid string, place int, value_lo double, value_hi double, reverse boolean")
    return rcols(B.composite(roles.single(spark, sf), si), "y", "age")


@query("B14_diagnoses", sql("wide", """SELECT pid, CASE WHEN v_click >= 3 OR v_view >= 3 OR v_error >= 3 THEN true WHEN v_click IS NULL AND v_view IS NULL AND v_error IS NULL THEN NULL ELSE false END AS any_yes,
 CASE WHEN c >= 2 THEN true WHEN c + u < 2 THEN false END AS at_least_two FROM (SELECT *, coalesce((v_click >= 2)::INT, 0) + coalesce((v_view >= 2)::INT, 0) + coalesce((v_error >= 2)::INT, 0) AS c, (v_click IS NULL)::INT + (v_view IS NULL)::INT + (v_error IS NULL)::INT AS u FROM wide)"""))
def _(spark, sf):
    cols = [F.col(f"v_{q}") for q in ("click", "view", "error")]
    return wide(spark, sf).select("pid", B.any_yes([c >= 3 for c in cols]).alias("any_yes"), B.sure_count([c >= 2 for c in cols], 2).alias("at_least_two"))


CRITERIA_LEAVES = [
    ("worry", "signup", ["3", "4"], [], ["0", "1"], None), ("excess_1", "click", ["4"], [], ["0", "1", "2"], None), ("excess_2", "view", ["4"], [], ["0", "1"], None),
    ("sign_1", "error", ["3", "4"], [], ["0", "1"], None), ("sign_2", "purchase", ["2", "3", "4"], [], ["0"], None), ("sign_3", "view", ["1", "4"], [], ["0", "2"], None),
    ("high", "click", ["3"], [], None, None), ("irritable", "error", ["3"], [], None, None), ("many", "purchase", [], [], None, 1), ("long", "view", [], ["3", "4"], None, None),
    ("trouble", "signup", [], ["2", "4"], None, None), ("low", "click", ["1"], [], None, None), ("flat", "view", ["1"], [], None, None), ("several", "error", [], ["2"], None, None),
    ("talk", "purchase", ["1"], [], None, None), ("rest", "purchase", ["3"], [], None, None)]
CRITERIA = [
    K.anxiety("gad", "worry", ["excess_1", "excess_2"], ["sign_1", "sign_2", "sign_3"], 2), K.episode("mania", ["high", "irritable"], ["many"]), K.episode("bipolar", [], ["long", "trouble"], of="mania"),
    K.episode("depressed", ["low", "flat"], []), K.episode("recurrent", [], ["several"], of="depressed"), K.symptoms_by_screener("mania_high", "high", ["talk", "rest"]),
    K.symptoms_by_screener("mania_irritable", "irritable", ["talk", "rest"])]
DIAGNOSES = ["gad", "mania", "bipolar", "depressed", "recurrent", "mania_high__talk", "mania_high__rest", "mania_irritable__talk", "mania_irritable__rest"]


def _leaf(name: str) -> str:
    """true, false or null of one leaf from the lists of a person's answers."""
    _, q, yes, part, no, need = next(x for x in CRITERIA_LEAVES if x[0] == name)
    if need:
        return f"(len({q}) >= {need})"
    listed = lambda v: "[" + ", ".join(f"'{x}'" for x in v) + "]"
    return f"(CASE WHEN {q} IS NULL THEN NULL WHEN list_has_any({q}, {listed(yes + part)}) THEN true WHEN {'true' if no is None else f'list_has_any({q}, {listed(no)})'} THEN false END)"


def _ages(*leaves: str) -> str:
    return "coalesce(" + ", ".join(f"a_{x[1]}" for x in CRITERIA_LEAVES if x[0] in leaves) + ")"


def _counted(leaves, need):
    yes, unknown = (" + ".join(f"coalesce(({_leaf(x)}){test}::INT, 0)" for x in leaves) for test in ("", " IS NULL"))
    return f"(CASE WHEN {yes} >= {need} THEN true WHEN {yes} + {unknown} < {need} THEN false END)"


def _any(*leaves):
    return "(CASE WHEN " + " OR ".join(f"coalesce({_leaf(x)}, false)" for x in leaves) + " THEN true WHEN " + " OR ".join(f"{_leaf(x)} IS NOT NULL" for x in leaves) + " THEN false END)"


def _gated(gate, body):
    return f"(CASE WHEN {gate} THEN {body} WHEN NOT {gate} THEN false END)"


_all = lambda *leaves: "(" + " AND ".join(f"coalesce({_leaf(x)}, false)" for x in leaves) + ")"
_mania = _gated(_any("high", "irritable"), _all("many"))
_CRITERIA_SQL = {
    "gad": (_gated(_leaf("worry"), f"({_counted(['excess_1', 'excess_2'], 1)} AND {_counted(['sign_1', 'sign_2', 'sign_3'], 2)})"), _ages("worry", "excess_1", "excess_2", "sign_1", "sign_2", "sign_3")),
    "mania": (_mania, _ages("high", "irritable", "many")), "bipolar": (_gated(_mania, _all("long", "trouble")), _ages("high", "irritable", "many", "long", "trouble")),
    "depressed": (_any("low", "flat"), _ages("low", "flat")), "recurrent": (_gated(_any("low", "flat"), _all("several")), _ages("low", "flat", "several")),
    **{f"mania_{p}__{s}": (_gated(_leaf(p), _all(s)), _ages(p, s)) for p in ("high", "irritable") for s in ("talk", "rest")}}


@query("B14_criteria", sql("answers", "WITH a AS (SELECT pid, qid, list(DISTINCT right(answer, 1)) AS v, min(age) AS age FROM answers GROUP BY ALL), x AS (SELECT pid, " + ", ".join(f"max(v) FILTER (qid = '{q}') AS {q}, max(age) FILTER (qid = '{q}') AS a_{q}" for q in QIDS)
       + " FROM a GROUP BY pid) SELECT * FROM (" + " UNION ALL ".join(f"SELECT '{n}' AS pheno_id, pid, CAST({v} AS DOUBLE) AS y, {rs(age)} AS age FROM x" for n, (v, age) in _CRITERIA_SQL.items()) + ") WHERE y IS NOT NULL AND age IS NOT NULL"))
def _(spark, sf):
    """Anxiety, mania, bipolar, depression and symptom-by-screener rows in one table."""
    nodes, edges = (sum((c[k] for c in CRITERIA), []) for k in (0, 1))
    tables = (spark.createDataFrame(rows, schema) for rows, schema in ((CRITERIA_LEAVES, K.LEAVES), (nodes, K.NODES), (edges, K.EDGES)))
    found = K.diagnoses(answers(spark, sf), *tables, DIAGNOSES)
    return found.withColumn("age", r("age"))


@query("B15_symptom_count", sql("wide", f"""SELECT pid, CASE WHEN g = 0 THEN 0.0 WHEN n >= 3 THEN {rs('s / CAST(n AS DOUBLE) * 4')} END AS y FROM (SELECT pid, {_SCREEN} AS g, (v_click IS NOT NULL)::INT + (v_view IS NOT NULL)::INT + (v_error IS NOT NULL)::INT + (v_purchase IS NOT NULL)::INT AS n,
 coalesce((v_click >= 2)::INT, 0) + coalesce((v_view >= 2)::INT, 0) + coalesce((v_error >= 2)::INT, 0) + coalesce((v_purchase >= 2)::INT, 0) AS s FROM wide)"""))
def _(spark, sf):
    vals = [(F.col(f"v_{q}") >= 2).cast("double") for q in ("click", "view", "error", "purchase")]
    return wide(spark, sf).select("pid", r(B.symptom_sum(vals, screen())).alias("y"))


@query("B16_hurdle", sql("wide", f"""WITH e AS (SELECT pid, v_click AS a, v_view AS b, 2.0 AS c FROM wide WHERE v_signup >= 2 AND v_click IS NOT NULL AND v_view IS NOT NULL),
 m AS (SELECT avg(a) AS ma, stddev_pop(a) AS sa, avg(b) AS mb, stddev_pop(b) AS sb FROM e), z AS (SELECT pid, (CASE WHEN sa > 0 THEN (a - ma) / sa ELSE 0 END) + (CASE WHEN sb > 0 THEN (b - mb) / sb ELSE 0 END) AS z FROM e, m)
 SELECT pid AS iid, {rs('z - (SELECT min(z) FROM z)')} AS y FROM z UNION ALL SELECT pid, CAST(-1 AS DOUBLE) FROM wide WHERE v_signup < 2"""))
def _(spark, sf):
    w = wide(spark, sf).select("pid", F.when(screen() == 1, "endorser").when(screen() == 0, "negative").alias("gate"), F.col("v_click").alias("a"), F.col("v_view").alias("b"), F.lit(2.0).alias("c"))
    return rcols(B.hurdle(w, ["a", "b", "c"]), "y")


@query("B17_chronicity", sql("wide", f"SELECT pid, CASE WHEN g = 0 THEN 0 WHEN g = 1 AND v_error = 1 THEN 1 WHEN g = 1 AND v_error > 1 THEN 2 END::DOUBLE AS y FROM (SELECT *, {_SCREEN} AS g FROM wide)"))
def _(spark, sf):
    return wide(spark, sf).select("pid", B.chronicity(screen(), F.col("v_error")).alias("y"))


@query("B18_index_sum", sql("wide", f"SELECT pid, {rs('CASE WHEN v_click IS NOT NULL THEN (v_click >= 2)::INT + coalesce((v_view >= 3)::INT, 0) + CASE WHEN v_view >= 3 THEN 1 ELSE coalesce(v_error / 4.0, 0) END END')} AS y FROM wide"))
def _(spark, sf):
    w = wide(spark, sf)
    y = B.index_sum((F.col("v_click") >= 2).cast("double"), (F.col("v_view") >= 3).cast("double"), F.col("v_error") / 4.0)
    return w.select("pid", r(y).alias("y"))


@query("B19_membership", sql("people", """SELECT 'region_' || CAST(r_regionkey AS VARCHAR) AS pheno_id, iid, CAST(CAST(n_regionkey = r_regionkey AS INTEGER) AS DOUBLE) AS y, age FROM people JOIN nation ON nation = n_nationkey, region"""))
def _(spark, sf):
    n = table(spark, sf, "nation").groupBy("n_regionkey").agg(F.array_join(F.collect_set(F.col("n_nationkey").cast("string")), "|").alias("members"))
    c = n.select(F.concat(F.lit("region_"), F.col("n_regionkey").cast("string")).alias("cluster"), "members")
    return B.membership(roles.people(spark, sf), "nation", c)


@query("B20_area_traits", f"""WITH l AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS k FROM orders) WHERE k = 1)
 SELECT 'price' AS pheno_id, o_custkey AS iid, CAST(30 AS DOUBLE) AS age, {rs('o_totalprice / 1000.0')} AS y FROM l UNION ALL SELECT 'year', o_custkey, CAST(30 AS DOUBLE), CAST(year(o_orderdate) AS DOUBLE) FROM l""")
def _(spark, sf):
    o = table(spark, sf, "orders").select(F.col("o_custkey").alias("iid"), "o_orderdate", "o_orderkey", "o_totalprice")
    latest = X.latest_row(o, ["iid"], ["o_orderdate", "o_orderkey"])
    w = latest.select("iid", F.lit(30.0).alias("age"), (F.col("o_totalprice") / 1000.0).alias("price"), F.year("o_orderdate").cast("double").alias("year"))
    return rcols(B.area_traits(w, ["price", "year"]), "y")


@query("B21_code_trait", sql("people", "SELECT iid, CASE WHEN segment IN ('BUILDING', 'MACHINERY') THEN 1.0 ELSE 0.0 END::DOUBLE AS y, age FROM people WHERE segment IN ('BUILDING', 'MACHINERY', 'FURNITURE') AND sex_01 IS NOT NULL"))
def _(spark, sf):
    p = roles.people(spark, sf)
    return B.code_trait(p.select("iid", F.col("segment").alias("code")), ["BUILDING", "MACHINERY"], ["FURNITURE"], p.where("sex_01 is not null").select("iid", "age"))


@query("B22_followup_binaries", sql("answers single", f"""WITH f AS (SELECT pid, list(DISTINCT right(answer, 1)) AS c, min(age) AS age FROM answers WHERE qid = 'purchase' GROUP BY pid), p AS (SELECT pid, age FROM single WHERE qid = 'signup' AND y IN (0, 1)),
 o AS (SELECT DISTINCT right(answer, 1) AS option FROM answers WHERE qid = 'purchase')
 SELECT o.option, coalesce(f.pid, p.pid) AS iid, CAST(coalesce(list_contains(f.c, o.option), false)::INT AS DOUBLE) AS y, {rs('CASE WHEN f.pid IS NOT NULL THEN f.age ELSE p.age END')} AS age FROM f FULL JOIN p USING (pid), o"""))
def _(spark, sf):
    parent = roles.single(spark, sf).where("qid = 'signup'").select("pid", "answer", "age")
    follow = answers(spark, sf).where("qid = 'purchase'").select("pid", "answer", "age")
    return rcols(B.followup_binary(parent, follow, ["0", "1"]), "age")


role("resolved", """SELECT pid, qid, CASE WHEN max(bad) = 1 OR min(v) <> max(v) OR (max(refused) = 1 AND min(v) IS NOT NULL) THEN 'invalid' WHEN min(v) IS NULL THEN 'missing' ELSE 'scored' END AS status, min(v) AS v, min(age) AS age FROM
 (SELECT pid, qid, CASE WHEN concept = '1004' THEN 1 ELSE 0 END AS bad, CASE WHEN concept = '1003' THEN 1 ELSE 0 END AS refused, CASE WHEN concept IN ('1000', '1001', '1002') THEN CASE WHEN concept = '1000' THEN 0 ELSE 1 END END AS v, age FROM latest) GROUP BY pid, qid""", "latest")


def resolved(spark, sf):
    s = roles.selected(spark, sf)
    c = spark.createDataFrame([("1000", 0.0), ("1001", 1.0), ("1002", 1.0), ("1003", None)], "concept string, value double")
    t = spark.createDataFrame([("0", 0.0), ("1", 1.0), ("2", 1.0), ("3", None)], "label string, value double")
    return B.resolve_items(s, c.withColumn("qid", F.explode(F.array(*[F.lit(q) for q in QIDS]))), t)


@query("B23_resolved_items", sql("resolved", f"SELECT pid, qid, CASE WHEN status = 'scored' THEN CAST(v AS DOUBLE) END AS value, status, {rs('age')} AS age FROM resolved"))
def _(spark, sf):
    return rcols(resolved(spark, sf), "age")


@query("B23_approved_composite", sql("resolved", f"""SELECT pid AS iid, CASE WHEN count(*) FILTER (status = 'invalid') = 0 AND count(*) FILTER (status = 'scored') = 5 THEN CAST(sum(v) AS DOUBLE) END AS y,
 CASE WHEN count(*) FILTER (status = 'invalid') > 0 THEN 'invalid' WHEN count(*) FILTER (status = 'scored') = 5 THEN 'scored' ELSE 'incomplete' END AS status, count(*) FILTER (status = 'scored') AS observed, {rs("avg(CASE WHEN status = 'scored' THEN age END)")} AS age FROM resolved GROUP BY pid"""))
def _(spark, sf):
    return rcols(B.approved_composite(resolved(spark, sf), 5), "age")


_BOXES = [(c, q, str(1000 + k), code, kind) for c, q in (("tried", "click"), ("problems", "view")) for k, (code, kind) in enumerate([("none", "none"), ("a", "class"), ("b", "class"), ("other", "other")])]
_LABELS = [("tried", "click", "level: 1", "a", "class"), ("problems", "view", "level: 2", "a", "class"), ("problems", "view", "level: 1", "a", "class"), ("problems", "view", "level: 1", "b", "class"), ("tried", "click", "pmi: skip", "declined", "declined"), ("tried", "click", "level: 3", "other", "other")]
role("boxes", f"""WITH c AS (SELECT * FROM (VALUES {", ".join(map(str, _BOXES))}) v(composite, qid, concept, code, kind)), l AS (SELECT composite, qid, label, min(code) AS label_code, count(DISTINCT code) AS n_codes FROM (VALUES {", ".join(map(str, _LABELS))}) v(composite, qid, label, code, kind) GROUP BY ALL),
 x AS (SELECT s.composite, pid, qid, max(ts) OVER (PARTITION BY pid, qid) AS ts, min(age) OVER (PARTITION BY pid, qid) AS age, survey, CASE WHEN k % 3 = 0 THEN '' ELSE r.concept END AS concept, lower(answer) AS label FROM responses r JOIN (SELECT DISTINCT composite, qid FROM c) s USING (qid) WHERE k < 16),
 y AS (SELECT x.*, c.code AS cc, label_code, n_codes FROM x LEFT JOIN c USING (composite, qid, concept) LEFT JOIN l USING (composite, qid, label)),
 z AS (SELECT *, concept <> '' AND (cc IS NULL OR (label_code IS NOT NULL AND (n_codes > 1 OR label_code <> cc))) AS bad FROM y),
 w AS (SELECT z.*, CASE WHEN concept <> '' AND NOT bad THEN cc WHEN concept = '' AND n_codes = 1 THEN label_code END AS code FROM z), k AS (SELECT DISTINCT composite, qid, code, kind FROM (SELECT composite, qid, code, kind FROM c UNION ALL SELECT composite, qid, code, kind FROM (VALUES {", ".join(map(str, _LABELS))}) v(composite, qid, label, code, kind))),
 g AS (SELECT composite, pid AS iid, bool_or(bad) AS bad, bool_or(code IS NULL OR coalesce(kind = 'declined', false)) AS open, bool_or(coalesce(kind = 'none', false)) AS none, count(DISTINCT CASE WHEN kind = 'class' THEN code END) AS n, min(age) AS age, array_to_string(list_sort(list(DISTINCT survey)), '|') AS source_surveys,
  array_to_string(list_sort(list(DISTINCT qid || ':' || CAST(ts AS VARCHAR))), '|') AS source_event FROM w LEFT JOIN k USING (composite, qid, code) GROUP BY composite, pid)
 SELECT *, CASE WHEN bad THEN 'invalid' WHEN open THEN 'missing' WHEN none AND n > 0 THEN 'contradiction' WHEN none OR n > 0 THEN 'scored' ELSE 'missing' END AS status FROM g""", "responses")


def boxes(spark, sf):
    """All answers of a person to a question as one event; every third row has lost its concept."""
    e = roles.responses(spark, sf).where("k < 16").withColumn("concept", F.when(F.col("k") % 3 == 0, "").otherwise(F.col("concept")))
    s = e.groupBy("pid", "qid").agg(F.max("ts").alias("ts"), F.min("age").alias("age"), F.collect_set(F.struct(F.col("answer").alias("text"), "concept", "survey")).alias("answers"))
    return C.checkbox_counts(s, spark.createDataFrame(_BOXES, "composite string, qid string, concept string, code string, kind string"), spark.createDataFrame(_LABELS, "composite string, qid string, label string, code string, kind string"))


@query("B23_checkbox_composites", sql("boxes", f"SELECT composite, iid, CASE WHEN status = 'scored' THEN CAST(n AS DOUBLE) END AS y, CAST(CASE WHEN status IN ('scored', 'contradiction') THEN 2 ELSE 0 END AS BIGINT) AS observed, status, {rs('age')} AS age, source_surveys, source_event FROM boxes"))
def _(spark, sf):
    return rcols(boxes(spark, sf), "age")


@query("B23_composite_report", sql("boxes", "WITH s AS (SELECT composite, status, CASE WHEN status = 'scored' THEN CAST(n AS DOUBLE) END AS y FROM boxes) " + " UNION ALL ".join(
    f"SELECT composite, '{m}' AS metric, {rs(e)} AS value FROM s GROUP BY composite" for m, e in {**{k: f"count(*) FILTER (status = '{k}')" for k in ("scored", "missing", "invalid", "contradiction")}, "minimum": "min(y)", "maximum": "max(y)", "mean": "avg(y)", "sd": "stddev_pop(y)"}.items())))
def _(spark, sf):
    return rcols(C.composite_report(boxes(spark, sf)), "value")


@query("B24_stratified", sql("traits people", f"SELECT pheno_id || '_male' AS pheno_id, iid, {rs('y')} AS y, t.age FROM traits t JOIN people p USING (iid) WHERE p.sex_01 = 1"))
def _(spark, sf):
    return rcols(B.stratified_trait(roles.traits(spark, sf), roles.people(spark, sf), 1, "_male"), "y")


@query("B25_sex_rules", """SELECT p_partkey, CASE WHEN p_size % 7 = 0 THEN 'male' WHEN p_brand IN ('Brand#3', 'Brand#5') THEN 'female' ELSE 'all' END AS sex_filter,
 CASE WHEN p_size % 7 = 0 OR p_brand IN ('Brand#3', 'Brand#5') THEN 'agepc' ELSE 'full' END AS covar_mode FROM part""")
def _(spark, sf):
    meta = table(spark, sf, "part").select("p_partkey", F.col("p_brand").alias("item"), F.when(F.col("p_size") % 7 == 0, "male").otherwise("all").alias("sex_filter"), F.lit("full").alias("covar_mode"))
    rules = spark.createDataFrame([("Brand#3", "Female"), ("Brand#5", " female")], "item string, sex_filter string")
    return U.sex_rules(meta, rules).select("p_partkey", "sex_filter", "covar_mode")


_PLOIDY = "CASE WHEN iid % 29 = 0 THEN '' WHEN iid % 31 = 0 THEN 'XXY' WHEN iid % 37 = 0 THEN 'XX' WHEN iid % 2 = 1 THEN 'XY' ELSE 'XX' END"
_STATUS = f"""SELECT iid, sex_01 AS reported, p AS ploidy, CASE WHEN sex_01 IS NULL THEN 'missing_or_nonbinary_sex_at_birth' WHEN p = '' THEN 'missing_wgs_sex_ploidy' WHEN p = CASE sex_01 WHEN 0 THEN 'XX' ELSE 'XY' END THEN 'concordant_binary'
 WHEN p IN ('XX', 'XY') THEN 'discordant_binary' ELSE 'noncanonical_wgs_sex_ploidy' END AS status FROM (SELECT *, {_PLOIDY} AS p FROM people)"""


def statuses(spark, sf):
    return B.sex_status(roles.people(spark, sf).select("iid", F.col("sex_01").alias("reported"), F.expr(_PLOIDY).alias("ploidy")))


@query("B26_sex_status", sql("people", _STATUS))
def _(spark, sf):
    return statuses(spark, sf)


_ANSWER = "CASE iid % 4 WHEN 0 THEN 'PMI: Skip' WHEN 1 THEN 'I prefer not to  answer' WHEN 2 THEN 'Something else' END"
_ADDED = f"""SELECT *, CASE WHEN rule = 'withheld_xx' THEN 0 ELSE 1 END AS sex_01 FROM (SELECT *, CASE WHEN reported = 1 AND ploidy = 'X0' THEN 'assigned_male_x0_xo' WHEN reported IS NULL AND iid % 4 IN (0, 1) THEN CASE ploidy WHEN 'XX' THEN 'withheld_xx' WHEN 'XY' THEN 'withheld_xy' END END AS rule
 FROM (SELECT iid, reported, CASE WHEN iid % 31 = 0 THEN 'X0' ELSE ploidy END AS ploidy, {_ANSWER} AS answer, status FROM ({_STATUS}))) WHERE rule IS NOT NULL"""


def asked(spark, sf):
    """Statuses with the answer to sex at birth; samples with an odd ploidy have one X here."""
    return statuses(spark, sf).withColumn("ploidy", F.when(F.col("iid") % 31 == 0, "X0").otherwise(F.col("ploidy"))).withColumn("answer", F.expr(_ANSWER))


@query("B26_sex_additions", sql("people", f"SELECT iid, reported AS sex_01, 'concordant' AS source FROM ({_STATUS}) WHERE status = 'concordant_binary' UNION ALL SELECT iid, sex_01, 'imputed' FROM ({_ADDED}) WHERE status <> 'concordant_binary'"))
def _(spark, sf):
    return B.sex_additions(asked(spark, sf))[0]


@query("B26_sex_audit", sql("people", f"SELECT iid, sex_01, rule, answer, ploidy, status FROM ({_ADDED}) WHERE status <> 'concordant_binary'"))
def _(spark, sf):
    return B.sex_additions(asked(spark, sf))[1]


_CLS = "CASE p_size % 9 WHEN 0 THEN 'descriptive' WHEN 1 THEN 'date_text' WHEN 2 THEN 'numeric_text' WHEN 3 THEN 'multi_select' WHEN 4 THEN 'slider' WHEN 5 THEN 'free_text' ELSE 'single_select' END"
_OPTS = "CASE p_partkey % 6 WHEN 0 THEN '1=Never | 2=Sometimes | 3=Often | 9=Prefer not to answer' WHEN 1 THEN '1=Yes | 0=No' WHEN 2 THEN '1=Red | 2=Blue | 3=Green' WHEN 3 THEN '1=Less | 3=More | 4=Does not apply' WHEN 4 THEN '1=Only | 2=Skip' ELSE '1=Never | 2=Sometimes | 3=Never again' END"


@query("B27_catalog_classes", f"""SELECT p_partkey AS item, d AS disposition, CAST(n AS BIGINT) AS n_core, CASE WHEN d = 'ordinal_and_binary' THEN CASE WHEN o = 0 THEN 'freq' ELSE 'change' END END AS rule,
 CASE WHEN d = 'ordinal_and_binary' THEN CAST(CASE WHEN o = 0 THEN 3 ELSE 2 END AS BIGINT) END AS levels, '' AS topics FROM (SELECT *, CASE WHEN c = 'descriptive' THEN 'excluded_descriptive' WHEN c = 'date_text' THEN 'excluded_date' WHEN c = 'free_text' THEN 'excluded_free_text'
 WHEN regexp_matches(p_name, 'bolt') THEN 'excluded_race_pii_admin' WHEN c = 'numeric_text' THEN 'numeric' WHEN c = 'multi_select' THEN 'binary_only' WHEN n < 2 THEN 'excluded_degenerate' WHEN p_brand = 'Brand#9' THEN 'nominal_binary' WHEN o IN (0, 3) THEN 'ordinal_and_binary'
 WHEN n = 2 THEN 'binary_only' ELSE 'flagged_review' END AS d FROM (SELECT p_partkey, p_name, p_brand, {_CLS} AS c, p_partkey % 6 AS o, CASE p_partkey % 6 WHEN 0 THEN 3 WHEN 1 THEN 2 WHEN 4 THEN 1 ELSE 3 END AS n FROM part))""")
def _(spark, sf):
    p = table(spark, sf, "part")
    items = p.select(F.col("p_partkey").alias("item"), F.col("p_name").alias("field_label"), F.expr(_CLS).alias("phenotype_class"), F.expr(_OPTS).alias("options"))
    rules = spark.createDataFrame(
        [("freq", "never", 0.0, False, 1), ("freq", "sometimes", 1.0, False, 1), ("freq", "often", 2.0, False, 1), ("change", "less", -1.0, False, 2), ("change", "more", 1.0, False, 2), ("change", "does not apply", None, True, 2)],
        "rule string, label string, value double, local_missing boolean, priority int").withColumn("confidence", F.lit("high"))
    nominal = p.where("p_brand = 'Brand#9'").select(F.col("p_partkey").alias("item"))
    return U.classify_catalog(items, rules, nominal, "bolt")


@query("B28_parse_options", """SELECT p_partkey, trim(string_split(t, '=')[1]) AS code, trim(substr(t, strpos(t, '=') + 1)) AS label FROM (SELECT p_partkey, unnest(string_split('1=' || p_name || ' | 2=' || p_brand || ' | none | 3 = a=b', ' | ')) AS t FROM part) WHERE strpos(t, '=') > 0""")
def _(spark, sf):
    p = table(spark, sf, "part").select("p_partkey", F.concat(F.lit("1="), "p_name", F.lit(" | 2="), "p_brand", F.lit(" | none | 3 = a=b")).alias("o"))
    return p.select("p_partkey", F.explode(T.parse_options("o")).alias("x")).select("p_partkey", "x.code", "x.label")


@query("B29_reserved_ids", "SELECT p_partkey AS pheno_id, p_brand AS construction_id, 'Brand#1' AS expected FROM part WHERE p_size > 40 AND p_brand <> 'Brand#1'")
def _(spark, sf):
    p = table(spark, sf, "part")
    m = p.select(F.col("p_partkey").alias("pheno_id"), F.col("p_brand").alias("construction_id"))
    return U.check_reserved(m, p.where("p_size > 40").select(F.col("p_partkey").alias("pheno_id"), F.lit("Brand#1").alias("construction_id")))


@query("B31_coverage_audit", sql("responses", """SELECT qid, count(DISTINCT pid) AS n_persons, n_made, n_skipped, CASE qid WHEN 'click' THEN 'covered_passed_and_qc_skipped' WHEN 'view' THEN 'covered_passed' WHEN 'error' THEN 'covered_qc_skipped' WHEN 'signup' THEN 'explicitly_excluded' ELSE 'missing_metadata_no_encoding_rule' END AS status
 FROM (SELECT *, CAST(CASE WHEN qid = 'click' THEN 2 WHEN qid = 'view' THEN 1 ELSE 0 END AS BIGINT) AS n_made, CAST(CASE WHEN qid IN ('click', 'error') THEN 1 ELSE 0 END AS BIGINT) AS n_skipped FROM responses) GROUP BY qid, n_made, n_skipped"""))
def _(spark, sf):
    scan = R.question_scan(roles.responses(spark, sf)).select("qid", "n_persons")
    cat = spark.createDataFrame([("click", "binary_only"), ("view", "numeric"), ("error", "numeric"), ("signup", "excluded_date")], "qid string, disposition string")
    made = spark.createDataFrame([("click",), ("click",), ("view",)], "qid string")
    skipped = spark.createDataFrame([("click",), ("error",)], "qid string")
    return R.coverage(scan, cat, made, skipped).select("qid", "n_persons", "n_made", "n_skipped", "status")


@query("B32_trait_dictionary", """SELECT p_type AS qid, p_name AS answer, p_partkey AS pheno_id, CASE WHEN p_size > 30 THEN 'run' WHEN p_size > 15 THEN 'skipped' ELSE 'not built' END AS status, 'case: answered ''' || p_name || '''; control: any other valid answer' AS definition FROM part""")
def _(spark, sf):
    p = table(spark, sf, "part")
    pick = lambda cond: p.where(cond).select(F.col("p_partkey").alias("pheno_id"))
    a = p.select(F.col("p_type").alias("qid"), F.col("p_name").alias("answer"), F.col("p_partkey").alias("pheno_id"))
    return U.trait_dictionary(a, pick("p_size > 30"), pick("p_size > 15 and p_size <= 30"))


@query("B30_selected_builders", sql("answers single", f"""SELECT 'bin' AS builder, pheno_id, iid, y, {rs('age')} AS age FROM (SELECT 'bin_' || a.qid || '_' || right(o.answer, 1) AS pheno_id, a.pid AS iid, CAST(list_contains(a.c, o.answer) AS INTEGER)::DOUBLE AS y, a.age
 FROM (SELECT pid, qid, list(answer) AS c, min(age) AS age FROM answers GROUP BY ALL) a JOIN (SELECT DISTINCT qid, answer FROM answers) o USING (qid)) WHERE pheno_id = 'bin_view_1' OR starts_with(pheno_id, 'bin_click_')
 UNION ALL SELECT 'num', 'num_error', pid, y, {rs('age')} FROM single WHERE qid = 'error' AND y BETWEEN 1 AND 3"""))
def _(spark, sf):
    """Two kinds of traits from the builders of all questions; the third builder is not planned."""
    levels = roles.single(spark, sf).withColumn("answer", F.col("y").cast("string"))
    ranges = spark.createDataFrame([("error", 1.0, 3.0)], "qid string, lo double, hi double")
    builders = {"bin": lambda: B.one_vs_rest(answers(spark, sf)), "num": lambda: B.numeric_trait(levels, ranges), "sparse": lambda: sparse(spark, sf).cases}
    return rcols(B.select_builders(builders, ["bin_view_1", "bin_click_", "num_error"]).select("builder", "pheno_id", "iid", "y", "age"), "age")


@query("B25_legacy_ids", sql("sparse", "SELECT qid, answer, 'bin_' || CASE qid WHEN 'view' THEN 'seen_pages' ELSE 'xgb_q' || qid END || '__' || CASE answer WHEN 'Yes' THEN 'yes' WHEN 'No, never' THEN 'no_never' ELSE right(answer, 1) END AS pheno_id, n_cases, n_controls FROM sparse WHERE qid IN ('view', 'signup') AND n_cases > 0"))
def _(spark, sf):
    """One-hot ids that questions had before they became ordinal, for all their answers."""
    return Q.legacy_ids(sparse(spark, sf).catalog, spark.createDataFrame([("view", "seen_pages"), ("signup", None)], "qid string, item string"))
