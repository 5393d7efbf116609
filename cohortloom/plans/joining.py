"""Joins and set operations over the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import joins as J
from ..operators import responses as R
from ..session import scratch_path
from ..sources import ledger, sinks, tables
from . import roles
from .projections import s_compact, s_norm_question, s_tokens
from .registry import query, r, rs, table
from .roles import sql


@query("J1_validated_join", "SELECT o_orderkey, c_mktsegment, n_name FROM orders LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey")
def _(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", F.col("o_custkey").alias("c_custkey"))
    c = table(spark, sf, "customer").select("c_custkey", "c_mktsegment", F.col("c_nationkey").alias("n_nationkey"))
    n = table(spark, sf, "nation").select("n_nationkey", "n_name")
    return J.validated_join(J.validated_join(o, c, ["c_custkey"]), n, ["n_nationkey"]).select("o_orderkey", "c_mktsegment", "n_name")


_ATTR = """SELECT iid, CASE WHEN iid IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0) THEN 'excluded_qc' WHEN sex_01 IS NULL THEN 'missing_sex'
 WHEN iid NOT IN (SELECT o_custkey FROM orders) THEN 'missing_orders' WHEN iid NOT IN (SELECT pid FROM single) THEN 'missing_survey' END AS failed_step FROM people"""


@query("J2_attrition", sql("people single", f"SELECT coalesce(failed_step, 'kept') AS step, count(*) AS n FROM ({_ATTR}) GROUP BY 1"))
def _(spark, sf):
    p = roles.people(spark, sf)
    c = table(spark, sf, "customer")
    out = J.attrition(
        p.select("iid"), "iid", {"qc": c.where("c_acctbal < 0").select(F.col("c_custkey").alias("iid"))},
        {"sex": p.where("sex_01 is not null"), "orders": table(spark, sf, "orders").select(F.col("o_custkey").alias("iid")), "survey": roles.single(spark, sf).select(F.col("pid").alias("iid"))},
    )
    return out.groupBy(F.coalesce("failed_step", F.lit("kept")).alias("step")).agg(F.count(F.lit(1)).alias("n"))


@query("J3_keep_and_drop", """SELECT o_orderkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')
 AND o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal < 1000)""")
def _(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", F.col("o_custkey").alias("c_custkey"))
    c = table(spark, sf, "customer")
    return tables.anti_scan(tables.semi_scan(o, c.where("c_mktsegment = 'BUILDING'"), "c_custkey"), c.where("c_acctbal < 1000"), "c_custkey").select("o_orderkey")


_OTHER = "SELECT iid2 AS iid1, iid1 AS iid2, kinship + ((iid1 + iid2) % 7 - 3) / CAST(1000.0 AS DOUBLE) AS kinship FROM edges WHERE ibs0 < 0.0025 AND kinship >= 0.035"


def other_edges(spark, sf):
    """A second pair table: reversed order, shifted values, some pairs absent."""
    e = roles.edges(spark, sf).where("ibs0 < 0.0025 and kinship >= 0.035")
    s = F.col("iid1") + F.col("iid2")
    return e.select(F.col("iid2").alias("iid1"), F.col("iid1").alias("iid2"), (F.col("kinship") + (s % 7 - 3) / 1000.0).alias("kinship"))


@query("J4_pair_compare", sql("edges", f"""SELECT coalesce(a.iid1, b.iid2) AS iid1, coalesce(a.iid2, b.iid1) AS iid2, {rs('a.kinship')} AS left_value, {rs('b.kinship')} AS right_value,
 CASE WHEN a.iid1 IS NULL THEN 'right_only' WHEN b.iid1 IS NULL THEN 'left_only' ELSE 'both' END AS side FROM edges a FULL JOIN ({_OTHER}) b ON a.iid1 = b.iid2 AND a.iid2 = b.iid1"""))
def _(spark, sf):
    j = J.pair_compare(roles.edges(spark, sf), other_edges(spark, sf), "iid1", "iid2", "kinship")
    return j.select("iid1", "iid2", r("left_value").alias("left_value"), r("right_value").alias("right_value"), "side")


@query("J5_latest_with_ties", sql("responses", "SELECT pid, qid, event_id, CAST(ts AS VARCHAR) AS day FROM (SELECT *, rank() OVER (PARTITION BY pid, qid ORDER BY ts DESC) AS place FROM responses) WHERE place = 1"))
def _(spark, sf):
    return J.latest_ties(roles.responses(spark, sf), ["pid", "qid"], "ts").select("pid", "qid", "event_id", F.col("ts").cast("string").alias("day"))


@query("J6_same_time_pair", sql("measures", """SELECT pid, CAST(min(dt) AS VARCHAR) AS dt, arg_min(hi, dt) AS first_value, arg_min(lo, dt) AS second_value FROM (SELECT a.pid, a.dt, max(a.value) AS hi, min(b.value) AS lo
 FROM measures a JOIN measures b ON a.pid = b.pid AND a.dt = b.dt AND a.measure = 'A' AND b.measure = 'R' AND a.value > b.value GROUP BY a.pid, a.dt) GROUP BY pid"""))
def _(spark, sf):
    p = J.same_time_pair(roles.measures(spark, sf), ["pid"], "dt", "measure", "A", "R", "value")
    return p.withColumn("dt", F.col("dt").cast("string"))


@query("J7_prompt_crosswalk", f"""WITH live AS (SELECT doc_id AS qid, {s_norm_question('text')} AS norm, {s_compact('text')} AS compact, {s_tokens('text')} AS tok FROM documents),
 cat AS (SELECT 'item_' || CAST(item_id AS VARCHAR) AS item, {s_norm_question('text')} AS norm, 'item' || CAST(item_id AS VARCHAR) AS compact, {s_tokens('text')} AS tok FROM benchmark),
 s1 AS (SELECT doc_id AS qid, 1 AS step, 'item_' || CAST(n_chars % 97 AS VARCHAR) AS item FROM documents WHERE lang = 'fr' AND 'item_' || CAST(n_chars % 97 AS VARCHAR) IN (SELECT item FROM cat)),
 s2 AS (SELECT qid, 2 AS step, min(item) AS item FROM live JOIN cat USING (norm) GROUP BY qid),
 s3 AS (SELECT qid, 3 AS step, min(cat.item) AS item FROM live JOIN cat ON live.compact <> '' AND (ends_with(live.compact, cat.compact) OR ends_with(cat.compact, live.compact)) GROUP BY qid HAVING count(DISTINCT cat.item) = 1),
 pr AS (SELECT qid, item, len(cat.tok) AS n, len(list_intersect(cat.tok, live.tok)) AS hit FROM live, cat WHERE len(cat.tok) >= 2 AND len(live.tok) > 0),
 cand AS (SELECT *, hit / CAST(n AS DOUBLE) AS cov, rank() OVER (PARTITION BY qid ORDER BY hit / CAST(n AS DOUBLE) DESC, hit DESC, n DESC) AS k FROM pr WHERE hit / CAST(n AS DOUBLE) >= 0.8),
 s4 AS (SELECT qid, 4 AS step, min(item) AS item FROM cand WHERE k = 1 GROUP BY qid HAVING count(*) = 1),
 f AS (SELECT * FROM s1 UNION ALL SELECT * FROM s2 UNION ALL SELECT * FROM s3 UNION ALL SELECT * FROM s4)
 SELECT qid, min(step) AS step, arg_min(item, step) AS item FROM f GROUP BY qid""")
def _(spark, sf):
    d = table(spark, sf, "documents")
    live = d.select(F.col("doc_id").alias("qid"), F.lit("all").alias("survey"), F.col("text").alias("question"))
    cat = table(spark, sf, "benchmark").select(F.concat(F.lit("item_"), F.col("item_id").cast("string")).alias("item"), F.lit("all").alias("survey"), F.col("text").alias("label"))
    explicit = d.where("lang = 'fr'").select(F.col("doc_id").alias("qid"), F.concat(F.lit("item_"), (F.col("n_chars") % 97).cast("string")).alias("item"))
    return J.crosswalk(live, cat, explicit)


@query("J8_supplement", "SELECT c_custkey AS k, 'base' AS origin FROM customer WHERE c_acctbal > 5000 UNION ALL SELECT DISTINCT o_custkey, 'extra' FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal > 5000)")
def _(spark, sf):
    base = table(spark, sf, "customer").where("c_acctbal > 5000").select(F.col("c_custkey").alias("k"), F.lit("base").alias("origin"))
    extra = table(spark, sf, "orders").select(F.col("o_custkey").alias("k")).distinct().withColumn("origin", F.lit("extra"))
    return J.supplement(base, extra, "k")


@query("J9_range_exclusion", sql("variants", """SELECT variant_id, chrom, pos FROM variants v WHERE NOT EXISTS (SELECT 1 FROM
 (SELECT (CASE WHEN n_regionkey % 2 = 0 THEN 'ECONOMY' ELSE 'SMALL' END) AS chrom, n_nationkey * 3000 AS s, n_nationkey * 3000 + 1100 AS e FROM nation) r WHERE r.chrom = v.chrom AND v.pos > r.s AND v.pos <= r.e)"""))
def _(spark, sf):
    n = table(spark, sf, "nation").select(F.when(F.col("n_regionkey") % 2 == 0, "ECONOMY").otherwise("SMALL").alias("chrom"), (F.col("n_nationkey") * 3000).alias("start"), (F.col("n_nationkey") * 3000 + 1100).alias("end"))
    return J.exclude_ranges(roles.variants(spark, sf).select("variant_id", "chrom", "pos"), n)


@query("J10_neighbours", sql("edges", """SELECT c_custkey AS iid FROM customer WHERE c_acctbal > 8000 UNION SELECT iid2 FROM edges WHERE kinship >= 0.4 AND iid1 IN (SELECT c_custkey FROM customer WHERE c_acctbal > 8000)
 UNION SELECT iid1 FROM edges WHERE kinship >= 0.4 AND iid2 IN (SELECT c_custkey FROM customer WHERE c_acctbal > 8000)"""))
def _(spark, sf):
    seeds = table(spark, sf, "customer").where("c_acctbal > 8000").select(F.col("c_custkey").alias("iid"))
    return J.expand_neighbours(seeds, roles.edges(spark, sf), 0.4)


@query("J11_same_order", """SELECT count(*) FILTER (a.p = b.p) AS n_same, count(*) FILTER (a.p <> b.p) AS n_moved, count(*) FILTER (a.p IS NULL) AS n_right_only, count(*) FILTER (b.p IS NULL) AS n_left_only
 FROM (SELECT p_partkey AS k, p_partkey AS p FROM part WHERE p_size < 48) a FULL JOIN (SELECT p_partkey AS k, CASE WHEN p_size % 9 = 0 THEN p_partkey + 1 ELSE p_partkey END AS p FROM part WHERE p_size > 2) b ON a.k = b.k""")
def _(spark, sf):
    p = table(spark, sf, "part")
    a = p.where("p_size < 48").select(F.col("p_partkey").alias("k"), F.col("p_partkey").alias("p"))
    b = p.where("p_size > 2").select(F.col("p_partkey").alias("k"), F.when(F.col("p_size") % 9 == 0, F.col("p_partkey") + 1).otherwise(F.col("p_partkey")).alias("p"))
    return J.same_order(a, b, "k", "p")


@query("J12_match_reference", sql("reference_freq", """SELECT match, count(*) AS n FROM (SELECT CASE WHEN f.variant_id IS NULL THEN 'absent' WHEN v.pos <> f.pos THEN 'pos_differs' WHEN v.alt IS DISTINCT FROM f.a1 THEN 'alt_differs'
 WHEN v.ref IS DISTINCT FROM f.a2 THEN 'ref_differs' ELSE 'ok' END AS match FROM variants v LEFT JOIN reference_freq f USING (variant_id)) GROUP BY match"""))
def _(spark, sf):
    ref = roles.reference_freq(spark, sf).select("variant_id", "pos", F.col("a1").alias("alt"), F.col("a2").alias("ref"))
    return J.match_reference(roles.variants(spark, sf), ref, "variant_id", ["pos", "alt", "ref"]).groupBy("match").agg(F.count(F.lit(1)).alias("n"))


@query("J13_union_scores", f"""SELECT 'balance' AS pheno_id, c_custkey AS iid, {rs('c_acctbal')} AS y FROM customer UNION ALL SELECT 'supply', s_suppkey, {rs('s_acctbal')} FROM supplier
 UNION ALL SELECT 'best', o_custkey, {rs('max(o_totalprice)', 2)} FROM orders GROUP BY o_custkey""")
def _(spark, sf):
    best = table(spark, sf, "orders").groupBy("o_custkey").agg(F.max("o_totalprice").alias("m"))
    u = J.union_scores([("balance", table(spark, sf, "customer"), "c_custkey", "c_acctbal"), ("supply", table(spark, sf, "supplier"), "s_suppkey", "s_acctbal"), ("best", best, "o_custkey", "m")])
    return u.select("pheno_id", "iid", r("y").alias("y"))


@query("J14_outer_with_source", """SELECT side, count(*) AS n FROM (SELECT CASE WHEN d.doc_id IS NULL THEN 'right_only' WHEN l.doc_id IS NULL THEN 'left_only' ELSE 'both' END AS side
 FROM (SELECT doc_id FROM documents WHERE n_chars > 300) d FULL JOIN labels l USING (doc_id)) GROUP BY side""")
def _(spark, sf):
    d = table(spark, sf, "documents").where("n_chars > 300").select("doc_id")
    return J.outer_with_source(d, table(spark, sf, "labels"), ["doc_id"]).groupBy("side").agg(F.count(F.lit(1)).alias("n"))


@query("J15_positional_zip", "SELECT CAST(o_orderkey // 400 AS BIGINT) AS batch, CAST(o_orderkey % 400 AS BIGINT) AS row_idx, o_custkey, (round(o_totalprice, 2) + 0.0) AS y FROM orders")
def _(spark, sf):
    o = table(spark, sf, "orders").withColumn("batch", F.floor(F.col("o_orderkey") / 400)).withColumn("row_idx", F.col("o_orderkey") % 400)
    return J.zip_rows(o.select("batch", "row_idx", "o_custkey"), o.select("batch", "row_idx", r("o_totalprice", 2).alias("y")))


@query("U1_union_sources", "SELECT src, count(*) AS n, count(lang) AS n_lang FROM (SELECT 'doc' AS src, lang FROM documents UNION ALL SELECT 'page', NULL FROM pages UNION ALL SELECT 'talk', NULL FROM conversations) GROUP BY src")
def _(spark, sf):
    u = R.union_all([table(spark, sf, "documents").select(F.lit("doc").alias("src"), "lang"), table(spark, sf, "pages").select(F.lit("page").alias("src")), table(spark, sf, "conversations").select(F.lit("talk").alias("src"))])
    return u.groupBy("src").agg(F.count(F.lit(1)).alias("n"), F.count("lang").alias("n_lang"))


@query("U2_sample_sets", """SELECT 'both' AS part, k FROM (SELECT c_custkey AS k FROM customer WHERE c_acctbal > 0 INTERSECT SELECT o_custkey FROM orders WHERE o_totalprice > 300000)
 UNION ALL SELECT 'only', k FROM (SELECT c_custkey AS k FROM customer WHERE c_acctbal > 0 EXCEPT SELECT o_custkey FROM orders WHERE o_totalprice > 300000)""")
def _(spark, sf):
    a = table(spark, sf, "customer").where("c_acctbal > 0").select(F.col("c_custkey").alias("k"))
    b = table(spark, sf, "orders").where("o_totalprice > 300000").select(F.col("o_custkey").alias("k"))
    return J.set_and(a, b, "k").select(F.lit("both").alias("part"), "k").unionByName(J.set_minus(a, b, "k").select(F.lit("only").alias("part"), "k"))


@query("U3_distinct_persons", sql("selected", "SELECT DISTINCT pid FROM selected WHERE qid IN ('click', 'purchase')"))
def _(spark, sf):
    return J.distinct_persons(roles.selected(spark, sf), ["click", "purchase"])


@query("U4_merge_manifest", """SELECT o_custkey AS pheno_id, 'new' AS run, count(*) AS n FROM orders WHERE o_totalprice > 250000 GROUP BY o_custkey UNION ALL
 SELECT c_custkey, 'old', CAST(0 AS BIGINT) FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_totalprice > 250000)""")
def _(spark, sf):
    new = table(spark, sf, "orders").where("o_totalprice > 250000").groupBy(F.col("o_custkey").alias("pheno_id")).agg(F.lit("new").alias("run"), F.count(F.lit(1)).alias("n"))
    old = table(spark, sf, "customer").select(F.col("c_custkey").alias("pheno_id"), F.lit("old").alias("run"), F.lit(0).cast("long").alias("n"))
    return ledger.merge_manifest(new, old, new)


@query("U4_ledger", """WITH n AS (SELECT o_custkey AS pheno_id, o_orderkey AS place, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS k FROM orders WHERE o_totalprice > 250000)
 SELECT pheno_id, place, CASE WHEN k = 1 THEN 'new' ELSE 'skipped' END AS state, CASE WHEN k > 1 THEN 'duplicate_pheno_id' END AS skip_reason, CAST(1 AS BIGINT) AS version FROM n
 UNION ALL SELECT c_custkey, NULL, 'old', NULL, 1 FROM customer WHERE c_custkey NOT IN (SELECT pheno_id FROM n)""")
def _(spark, sf):
    """A run's rows settled against its own repeats, merged with the prior manifest and published; the same run again adds no version."""
    rows = table(spark, sf, "orders").where("o_totalprice > 250000").select(F.col("o_custkey").alias("pheno_id"), F.col("o_orderkey").alias("place"))
    alone = rows.groupBy("pheno_id").agg(F.count(F.lit(1)).alias("n")).where("n = 1").select("pheno_id")
    kept, skipped = ledger.settle(rows, alone)
    old = table(spark, sf, "customer").select(F.col("c_custkey").alias("pheno_id"), F.lit("old").alias("state"))
    merged = ledger.merge_manifest(kept.withColumn("state", F.lit("new")), old, rows)
    folder = scratch_path(spark, "ledger")
    ledger.publish(merged, folder)
    version = ledger.publish(merged, folder)
    both = ledger.current(spark, folder).unionByName(skipped.withColumn("state", F.lit("skipped")), allowMissingColumns=True)
    return both.select("pheno_id", "place", "state", "skip_reason", F.lit(version).cast("long").alias("version"))
