"""Aggregations, windows and top rows over the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import aggregates as A
from ..operators import joins as J
from ..operators import ranks
from ..operators import responses as R
from ..operators import windows as X
from ..sources import sinks
from . import roles
from .registry import query, r, rs, table
from .roles import sql


def rcols(df, *names):
    """Round the named columns, keep the others."""
    return df.select(*[r(c).alias(c) if c in names else F.col(c) for c in df.columns])


@query("A1_person_means", sql("wear", f"""SELECT pid, {rs('CASE WHEN count(steps) >= 10 THEN avg(steps) END')} AS steps, {rs('CASE WHEN count(sleep) >= 10 THEN avg(sleep) END')} AS sleep,
 count(steps) AS n_steps, count(sleep) AS n_sleep, {rs('avg(age)')} AS age FROM wear GROUP BY pid"""))
def _(spark, sf):
    return rcols(A.person_means(roles.wear(spark, sf), ["steps", "sleep"]), "steps", "sleep", "age")


@query("A2_person_median", sql("measures", f"SELECT pid, {rs('median(value2)')} AS median, {rs('avg(age)')} AS age, count(*) AS n FROM measures WHERE value2 >= 5 GROUP BY pid"))
def _(spark, sf):
    return rcols(A.person_median(roles.measures(spark, sf), "value2", 5.0), "median", "age")


@query("A3_onset_hour", f"""SELECT pid, {rs('avg(CASE WHEN h < 12 THEN h + 24 ELSE h END)')} AS onset, count(*) AS nights FROM (SELECT pid, hour(t) + minute(t) / CAST(60.0 AS DOUBLE) AS h
 FROM (SELECT user_id AS pid, CAST(ts AS DATE) AS night, min(ts) AS t FROM events GROUP BY ALL)) GROUP BY pid""")
def _(spark, sf):
    e = table(spark, sf, "events").select(F.col("user_id").alias("pid"), "ts", F.to_date("ts").alias("night"))
    return rcols(A.onset_hour(e, "ts", "night"), "onset")


def _rate(flt):
    return f"CASE WHEN sum(reaction_time / 1000.0) FILTER ({flt}) > 0 THEN count(*) FILTER ({flt} AND correct) / (sum(reaction_time / 1000.0) FILTER ({flt})) END"


@query("A4_trial_rates", sql("trials", "SELECT pid, sitting_id, " + ", ".join(
    f"count(*) FILTER ({c}) AS n_{n}, count(*) FILTER ({c} AND correct) AS correct_{n}, {rs(_rate(c))} AS rate_{n}" for n, c in [("all", "true"), ("user", "emotion = 'user'"), ("assistant", "emotion = 'assistant'")]
) + " FROM trials GROUP BY pid, sitting_id"))
def _(spark, sf):
    return rcols(A.trial_rates(roles.sittings(spark, sf), ["user", "assistant"]), "rate_all", "rate_user", "rate_assistant")


def tasks(spark, sf):
    s = roles.sittings(spark, sf).select("pid", "sitting_id", "restarted").distinct()
    e = table(spark, sf, "events").select(F.col("user_id").alias("pid"), F.col("event_id").alias("sitting_id"), F.col("value").alias("score"))
    o = table(spark, sf, "orders").select(F.col("o_custkey").alias("pid"), F.col("o_orderkey").alias("sitting_id"), (F.col("o_orderstatus") == "P").cast("int").alias("flagged"))
    return A.union_tasks({"talk": s, "event": e, "order": o}, ["restarted", "flagged"])


roles.role("tasks", """SELECT DISTINCT 'talk' AS task, conv_id % 40 AS pid, conv_id AS sitting_id, CAST(NULL AS DOUBLE) AS score FROM conversations WHERE length(text) <= 400
 UNION ALL SELECT 'event', user_id, event_id, value FROM events UNION ALL SELECT 'order', o_custkey, o_orderkey, NULL FROM orders WHERE o_orderstatus <> 'P'""")


@query("A5_union_tasks", sql("tasks", f"SELECT task, pid, sitting_id, {rs('score')} AS score FROM tasks"))
def _(spark, sf):
    return rcols(tasks(spark, sf).select("task", "pid", "sitting_id", "score"), "score")


@query("A6_repeat_summary", sql("tasks", f"SELECT task, count(*) AS persons, count(*) FILTER (n >= 2) AS repeaters, {rs('avg(n)')} AS mean_sittings, max(n) AS max_sittings FROM (SELECT task, pid, count(DISTINCT sitting_id) AS n FROM tasks GROUP BY task, pid) GROUP BY task"))
def _(spark, sf):
    return rcols(A.repeat_summary(tasks(spark, sf)), "mean_sittings")


_Q = ", ".join(f"{rs(f'quantile_cont(value, {p})')} AS {n}" for n, p in A.PROBS.items())


@query("A7_distribution", f"""SELECT l_returnflag, "column", count(*) AS n, {rs('avg(value)')} AS mean, {rs('stddev_samp(value)')} AS sd, {rs('skewness(value)')} AS skew, {rs('min(value)')} AS min, {rs('max(value)')} AS max, {_Q}
 FROM (SELECT l_returnflag, 'l_discount' AS "column", l_discount AS value FROM lineitem UNION ALL SELECT l_returnflag, 'price', l_extendedprice / 1000.0 FROM lineitem) GROUP BY ALL""")
def _(spark, sf):
    li = table(spark, sf, "lineitem").withColumn("price", F.col("l_extendedprice") / 1000.0)
    d = A.distribution(li, ["l_returnflag"], ["l_discount", "price"])
    return rcols(d, "mean", "sd", "skew", "min", "max", *A.PROBS)


@query("A8_threshold_summary", " UNION ALL ".join(f"SELECT CAST({t} AS DOUBLE) AS threshold, count(*) AS n, {rs('avg(l_discount)')} AS mean_value, {rs('max(l_tax)')} AS max_tax FROM lineitem WHERE l_quantity >= {t}" for t in (10, 25, 40, 60)))
def _(spark, sf):
    li = table(spark, sf, "lineitem")
    d = A.threshold_summary(li, "l_quantity", [10, 25, 40, 60], "l_discount")
    t = A.threshold_summary(li, "l_quantity", [10, 25, 40, 60], "l_tax").select("threshold", F.col("max_value").alias("max_tax"))
    return rcols(d.select("threshold", "n", "mean_value").join(t, "threshold"), "mean_value", "max_tax")


_BINS = [("below_third", -1e9, 0.0442), ("third", 0.0442, 0.0884), ("second", 0.0884, 0.1767), ("first", 0.1767, 0.3535), ("duplicate", 0.3535, 0.9), ("above", 0.9, None)]


@query("A9_bin_counts", sql("edges", " UNION ALL ".join(f"SELECT '{n}' AS bin, count(*) FILTER (kinship >= {lo}{'' if hi is None else f' AND kinship < {hi}'}) AS n FROM edges" for n, lo, hi in _BINS)))
def _(spark, sf):
    return A.bin_counts(roles.edges(spark, sf), "kinship", [b[1] for b in _BINS], [b[0] for b in _BINS])


@query("A10_ordered_counts", """SELECT coalesce(category, c) AS category, CAST(coalesce(place, 4) AS INTEGER) AS place, coalesce(n, 0) AS n FROM (SELECT * FROM (VALUES (0, 'PROMO'), (1, 'SMALL'), (2, 'NONE'), (3, 'ECONOMY')) v(place, category))
 FULL JOIN (SELECT p_type AS c, count(*) AS n FROM part GROUP BY p_type) ON category = c""")
def _(spark, sf):
    return A.ordered_counts(table(spark, sf, "part"), "p_type", ["PROMO", "SMALL", "NONE", "ECONOMY"])


@query("A11_crosstab", f"SELECT o_orderstatus, o_orderpriority, n, {rs('n / CAST(sum(n) OVER (PARTITION BY o_orderstatus) AS DOUBLE)')} AS row_share FROM (SELECT o_orderstatus, o_orderpriority, count(*) AS n FROM orders GROUP BY ALL)")
def _(spark, sf):
    return rcols(A.crosstab(table(spark, sf, "orders"), "o_orderstatus", "o_orderpriority"), "row_share")


@query("A12_overlap_metrics", f"""SELECT b AS both, a AS a_only, o AS b_only, n AS neither, {rs('b / CAST(b + a + o AS DOUBLE)')} AS jaccard, {rs('b / CAST(b + a AS DOUBLE)')} AS precision, {rs('b / CAST(b + o AS DOUBLE)')} AS recall
 FROM (SELECT count(*) FILTER (x AND y) AS b, count(*) FILTER (x AND NOT y) AS a, count(*) FILTER (NOT x AND y) AS o, count(*) FILTER (NOT x AND NOT y) AS n
 FROM (SELECT n_chars > 400 AS x, coalesce(quality = 1, false) AS y FROM documents LEFT JOIN labels USING (doc_id)))""")
def _(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", "n_chars").join(table(spark, sf, "labels"), "doc_id", "left")
    return rcols(A.overlap_metrics(d, F.col("n_chars") > 400, F.col("quality") == 1), "jaccard", "precision", "recall")


@query("A13_pair_agreement", f"""WITH d AS (SELECT l_returnflag AS g, l_discount AS a, l_tax AS b, abs(l_discount - l_tax) AS x FROM lineitem),
 k AS (SELECT g, rank() OVER (PARTITION BY g ORDER BY a) + (count(*) OVER (PARTITION BY g, a) - 1) / 2.0 AS ra, rank() OVER (PARTITION BY g ORDER BY b) + (count(*) OVER (PARTITION BY g, b) - 1) / 2.0 AS rb FROM d),
 o AS (SELECT g, x, row_number() OVER (PARTITION BY g ORDER BY x) - 1 AS i, count(*) OVER (PARTITION BY g) AS n FROM d)
 SELECT l_returnflag, n, pearson, bias, mae, rmse, max_abs, share_above_0, spearman, median_abs, p90_abs, p99_abs FROM
 (SELECT g AS l_returnflag, count(*) AS n, {rs('corr(a, b)')} AS pearson, {rs('avg(a - b)')} AS bias, {rs('avg(x)')} AS mae, {rs('sqrt(avg(x * x))')} AS rmse, {rs('max(x)')} AS max_abs, {rs('avg(CASE WHEN x > 0.05 THEN 1.0 ELSE 0.0 END)')} AS share_above_0,
 {rs('median(x)')} AS median_abs FROM d GROUP BY g) JOIN (SELECT g AS l_returnflag, {rs('corr(ra, rb)')} AS spearman FROM k GROUP BY g) USING (l_returnflag)
 JOIN (SELECT g AS l_returnflag, {rs("max(CASE WHEN i = round_even((n - 1) * 0.9, 0) THEN x END)")} AS p90_abs, {rs("max(CASE WHEN i = round_even((n - 1) * 0.99, 0) THEN x END)")} AS p99_abs FROM o GROUP BY g) USING (l_returnflag)""")
def _(spark, sf):
    li = table(spark, sf, "lineitem")
    a = A.agreement(li.select("l_returnflag", "l_discount", "l_tax"), ["l_returnflag"], "l_discount", "l_tax", [0.05])
    return rcols(a, "pearson", "bias", "mae", "rmse", "max_abs", "share_above_0", "spearman", "median_abs", "p90_abs", "p99_abs")


_STEPS = ["freq", "maf", "missing"]
_LADDER = """SELECT *, CASE WHEN f IS NULL OR f < 0.05 THEN 'freq' WHEN least(f, 1 - f) < 0.2 THEN 'maf' WHEN f_miss IS NULL OR f_miss > 0.07 THEN 'missing' END AS failed_step
 FROM (SELECT *, CASE WHEN obs_ct > 0 THEN alt_ct / CAST(obs_ct AS DOUBLE) END AS f FROM variants)"""


def laddered(spark, sf):
    v = roles.variants(spark, sf).withColumn("f", F.when(F.col("obs_ct") > 0, F.col("alt_ct") / F.col("obs_ct")))
    f = F.col("f")
    return A.ladder(v, [("freq", f >= 0.05), ("maf", F.least(f, 1 - f) >= 0.2), ("missing", F.col("f_miss") <= 0.07)])


_FILTER_STEPS = f"""SELECT CAST(step AS INTEGER) AS step, name, dropped, CAST(total AS BIGINT) AS total, CAST(total - sum(dropped) OVER (ORDER BY step) AS BIGINT) AS remaining FROM (SELECT step, name, (SELECT count(*) FROM ({_LADDER}) WHERE failed_step = name) AS dropped,
 (SELECT count(*) FROM variants) AS total FROM (VALUES (1, 'freq'), (2, 'maf'), (3, 'missing')) v(step, name))"""


@query("A14_filter_ladder", sql("variants", _FILTER_STEPS))
def _(spark, sf):
    return A.filter_steps(laddered(spark, sf), _STEPS)


@query("A15_rollup_summary", "SELECT coalesce(p_type, 'all') AS p_type, sum(p_size)::BIGINT AS sum_p_size, (round(min(p_retailprice), 2) + 0.0) AS min_p_retailprice, (round(max(p_retailprice), 2) + 0.0) AS max_p_retailprice FROM part GROUP BY ROLLUP (p_type)")
def _(spark, sf):
    s = A.rollup_summary(table(spark, sf, "part"), "p_type", ["p_size"], ["p_retailprice"], ["p_retailprice"])
    return s.select("p_type", "sum_p_size", r("min_p_retailprice", 2).alias("min_p_retailprice"), r("max_p_retailprice", 2).alias("max_p_retailprice"))


@query("A16_level_histogram", "SELECT CAST(l AS INTEGER) AS level, (SELECT count(*) FROM lineitem WHERE CAST(l_quantity AS INTEGER) = l) AS n FROM (SELECT unnest(range(0, 61)) AS l)")
def _(spark, sf):
    return A.level_histogram(table(spark, sf, "lineitem"), "l_quantity", 0, 60)


@query("A16_level_moments", f"SELECT l_returnflag, count(*) AS n, {rs('avg(l_quantity)')} AS mean, {rs('stddev_pop(l_quantity)')} AS sd_pop, min(l_quantity) AS min, max(l_quantity) AS max FROM lineitem GROUP BY l_returnflag")
def _(spark, sf):
    return rcols(A.level_moments(table(spark, sf, "lineitem"), ["l_returnflag"], "l_quantity"), "mean", "sd_pop")


@query("A17_question_scan", sql("responses", """SELECT qid, count(*) AS n_rows, count(DISTINCT pid) AS n_persons, count(DISTINCT pid) FILTER (answer <> 'PMI: Skip') AS n_valid_persons,
 count(DISTINCT answer) FILTER (answer <> 'PMI: Skip') AS n_answers FROM responses GROUP BY qid"""))
def _(spark, sf):
    return R.question_scan(roles.responses(spark, sf))


@query("A18_prorated_sum", sql("items", f"SELECT pid, {rs('avg(y) * 5')} AS score, count(*) AS n_valid, {rs('avg(age)')} AS age FROM items GROUP BY pid HAVING count(*) >= 3"))
def _(spark, sf):
    return rcols(A.prorated_sum(roles.items(spark, sf), ["pid"], 5), "score", "age")


@query("A19_complete_sum", sql("items", f"SELECT pid, count(*) AS n_valid, sum(y) AS score, {rs('avg(age)')} AS age FROM items GROUP BY pid HAVING count(*) = 5"))
def _(spark, sf):
    return rcols(A.complete_sum(roles.items(spark, sf), ["pid"], 5), "age")


@query("A20_option_count", """WITH o AS (SELECT l_orderkey, list(DISTINCT l_partkey % 9) AS opts FROM lineitem GROUP BY l_orderkey),
 x AS (SELECT l_orderkey, opts, len([v FOR v IN opts IF v IN (1, 2, 3, 4, 5)]) AS hits, len([v FOR v IN opts IF v = 0]) AS nones, len([v FOR v IN opts IF v = 8]) AS refused, len(opts) AS n FROM o)
 SELECT l_orderkey, CAST(CASE WHEN refused > 0 OR (nones > 0 AND n > nones) THEN NULL WHEN nones > 0 THEN 0 WHEN hits > 0 THEN hits END AS BIGINT) AS option_count FROM x""")
def _(spark, sf):
    o = table(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.collect_set((F.col("l_partkey") % 9).cast("string")).alias("opts"))
    c = A.option_count(F.col("opts"), list("12345"), ["0"], ["6", "7"], ["8"])
    return o.select("l_orderkey", c.cast("long").alias("option_count"))


@query("A21_weighted_options", f"SELECT l_orderkey, {rs('sum(coalesce(CASE WHEN r_regionkey IS NOT NULL THEN r_regionkey / 4.0 END, 0))')} AS score FROM (SELECT DISTINCT l_orderkey, l_suppkey % 8 AS o FROM lineitem) LEFT JOIN region ON o = r_regionkey GROUP BY l_orderkey")
def _(spark, sf):
    chosen = table(spark, sf, "lineitem").select("l_orderkey", (F.col("l_suppkey") % 8).cast("int").alias("option")).distinct()
    weights = table(spark, sf, "region").select(F.col("r_regionkey").alias("option"), (F.col("r_regionkey") / 4.0).alias("weight"))
    return rcols(A.weighted_options(chosen, weights, ["l_orderkey"]), "score")


@query("A22_eligibility_counts", sql("single", "SELECT qid AS pheno_id, count(*) AS n, count(*) FILTER (y = 1) AS cases, count(*) FILTER (y = 0) AS controls, count(DISTINCT y) AS levels FROM single GROUP BY qid"))
def _(spark, sf):
    return A.eligibility_counts(roles.single(spark, sf).select(F.col("qid").alias("pheno_id"), "y"))


@query("A23_variant_frequency", sql("genotypes", f"""SELECT variant_id, CAST(sum(dosage) AS BIGINT) AS alt_ct, count(dosage) * 2 AS obs_ct, {rs('CASE WHEN count(dosage) > 0 THEN sum(dosage) / CAST(count(dosage) * 2 AS DOUBLE) END')} AS freq
 FROM genotypes WHERE sample_id IN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 2000) GROUP BY variant_id"""))
def _(spark, sf):
    s = table(spark, sf, "supplier").where("s_acctbal > 2000").select(F.col("s_suppkey").alias("sample_id"))
    return rcols(A.variant_freq(roles.genotypes(spark, sf), s), "freq")


@query("A24_missingness", sql("genotypes", " UNION ALL ".join(f"SELECT '{a}' AS axis, {a} AS id, count(*) FILTER (dosage IS NULL) AS n_missing, count(*) AS n, {rs('avg(CASE WHEN dosage IS NULL THEN 1.0 ELSE 0.0 END)')} AS f_miss FROM genotypes GROUP BY {a}" for a in ("variant_id", "sample_id"))))
def _(spark, sf):
    g = roles.genotypes(spark, sf)
    return rcols(R.union_all([A.missingness(g, a).select(F.lit(a).alias("axis"), F.col(a).alias("id"), "n_missing", "n", "f_miss") for a in ("variant_id", "sample_id")]), "f_miss")


@query("A25_pass_extremes", sql("variants", f"SELECT {rs('min(f)')} AS min_f, {rs('max(f)')} AS max_f, {rs('min(f_miss)')} AS min_f_miss, {rs('max(f_miss)')} AS max_f_miss, count(*) AS n_pass FROM ({_LADDER}) WHERE failed_step IS NULL"))
def _(spark, sf):
    return rcols(A.pass_extremes(laddered(spark, sf), ["f", "f_miss"]), "min_f", "max_f", "min_f_miss", "max_f_miss")


# windows ------------------------------------------------------------------------------------------------------------------
@query("W1_latest_valid", sql("selected", f"SELECT pid, qid, CAST(ts AS VARCHAR) AS ts, {rs('age')} AS age, array_to_string(answers, '|') AS answers FROM selected"))
def _(spark, sf):
    s = roles.selected(spark, sf)
    texts = F.array_join(F.array_sort(F.array_distinct(F.transform("answers", lambda a: a["text"]))), "|")
    return s.select("pid", "qid", F.col("ts").cast("string").alias("ts"), r("age").alias("age"), texts.alias("answers"))


@query("W2_latest_row", "SELECT o_custkey, o_orderkey, o_orderstatus, n_records FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS k, count(*) OVER (PARTITION BY o_custkey) AS n_records FROM orders) WHERE k = 1")
def _(spark, sf):
    o = table(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_orderstatus", "o_orderdate")
    return X.latest_row(o, ["o_custkey"], ["o_orderdate", "o_orderkey"]).drop("o_orderdate")


@query("W3_average_rank", f"SELECT o_orderkey, {rs('rank() OVER (PARTITION BY o_orderpriority ORDER BY t) + (count(*) OVER (PARTITION BY o_orderpriority, t) - 1) / 2.0')} AS rank FROM (SELECT o_orderkey, o_orderpriority, floor(o_totalprice / 100) AS t FROM orders)")
def _(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority", F.floor(F.col("o_totalprice") / 100).cast("double").alias("t"))
    return rcols(ranks.average_rank(o, ["o_orderpriority"], "t").select("o_orderkey", "rank"), "rank")


@query("W4_first_sitting", sql("tasks", "SELECT task, pid, min(sitting_id) AS sitting_id FROM tasks GROUP BY task, pid"))
def _(spark, sf):
    return X.first_valid(tasks(spark, sf).select("task", "pid", "sitting_id"), ["task", "pid"], ["sitting_id"])


@query("W5_earliest_in_range", sql("measures", "SELECT pid, measure, CAST(dt AS VARCHAR) AS dt, value FROM (SELECT *, row_number() OVER (PARTITION BY pid, measure ORDER BY dt, oid, line, value) AS k FROM measures WHERE value BETWEEN 10 AND 40) WHERE k = 1"))
def _(spark, sf):
    m = roles.measures(spark, sf).select("pid", "measure", "dt", "oid", "line", "value")
    e = X.earliest_in_range(m, ["pid", "measure"], "value", ["dt", "oid", "line", "value"], 10, 40)
    return e.select("pid", "measure", F.col("dt").cast("string").alias("dt"), "value")


@query("W6_strict_best", """SELECT l_orderkey, p AS l_partkey, l_quantity FROM (SELECT l_orderkey, l_quantity, min(l_partkey) AS p, count(*) AS n, rank() OVER (PARTITION BY l_orderkey ORDER BY l_quantity DESC) AS k FROM lineitem GROUP BY l_orderkey, l_quantity) WHERE k = 1 AND n = 1""")
def _(spark, sf):
    return J.strict_best(table(spark, sf, "lineitem"), ["l_orderkey"], ["l_quantity"], "l_partkey")


@query("W7_running_remaining", "SELECT CAST(step AS INTEGER) AS step, dropped, total, CAST(total - sum(dropped) OVER (ORDER BY step) AS BIGINT) AS remaining FROM (SELECT n_nationkey AS step, (SELECT count(*) FROM customer WHERE c_nationkey = n_nationkey) AS dropped, (SELECT count(*) FROM customer) AS total FROM nation)")
def _(spark, sf):
    c = table(spark, sf, "customer")
    per = c.groupBy(F.col("c_nationkey").alias("step")).agg(F.count(F.lit(1)).alias("dropped"))
    return A.running_remaining(per.crossJoin(F.broadcast(c.agg(F.count(F.lit(1)).alias("total")))), "step")


@query("W8_dominant_component", "SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN d >= t AND d >= q THEN 'discount' WHEN t >= q THEN 'tax' ELSE 'quantity' END AS dominant FROM (SELECT *, l_discount AS d, l_tax AS t, l_quantity / 1000.0 AS q FROM lineitem)")
def _(spark, sf):
    li = table(spark, sf, "lineitem").withColumn("q", F.col("l_quantity") / 1000.0)
    return li.select("l_orderkey", "l_linenumber", "l_partkey", X.dominant(["l_discount", "l_tax", "q"], ["discount", "tax", "quantity"]).alias("dominant"))


@query("W9_zscore_by_reference", f"SELECT o_orderkey, {rs('(o_totalprice - m) / s')} AS z FROM orders, (SELECT avg(o_totalprice) AS m, stddev_samp(o_totalprice) AS s FROM orders WHERE o_orderstatus = 'F')")
def _(spark, sf):
    z = X.zscore(table(spark, sf, "orders"), "o_totalprice", F.col("o_orderstatus") == "F")
    return z.select("o_orderkey", r("z").alias("z"))


@query("W10_ordered_ids", "SELECT c_custkey, c_name FROM customer")
def _(spark, sf):
    return X.order_ids(table(spark, sf, "customer").select("c_custkey", "c_name"), "c_custkey")


@query("W11_fixed_batches", "SELECT c_custkey, CAST((row_number() OVER (ORDER BY c_custkey) - 1) // 64 AS INTEGER) AS batch FROM customer")
def _(spark, sf):
    return sinks.assign_batches(table(spark, sf, "customer").select("c_custkey"), "c_custkey", 64).select(F.col("c_custkey").cast("long").alias("c_custkey"), "batch")


@query("W12_top_features", f"SELECT p_name, {rs('s', 2)} AS importance FROM (SELECT p_name, sum(p_retailprice) AS s FROM part GROUP BY p_name) ORDER BY round(s, 4) DESC, p_name LIMIT 20")
def _(spark, sf):
    s = table(spark, sf, "part").groupBy("p_name").agg(F.round(F.sum("p_retailprice"), 4).alias("s"))
    return X.top_k(s, "s", "p_name", 20).select("p_name", r("s", 2).alias("importance"))
