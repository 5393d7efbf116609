"""Reads, writes and bookkeeping over the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import responses as R
from ..session import scratch_path
from ..sources import ledger, sinks, tables
from . import roles
from .registry import query, r, rs, table
from .roles import sql


@query("S1_delimited_scan", f"""SELECT o_orderkey, o_custkey, {rs('o_totalprice', 2)} AS o_totalprice, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS o_orderdate,
 TRY_CAST(o_orderstatus AS DOUBLE) AS status_number FROM orders""")
def _(spark, sf):
    path = scratch_path(spark, "orders-tsv")
    o = table(spark, sf, "orders").withColumn("o_orderdate", F.col("o_orderdate").cast("date"))
    o.write.option("compression", "gzip").csv(path, sep="\t", header=True)
    df = tables.read_table(spark, path, "\t", ["o_orderkey", "o_custkey"], {"o_orderkey": "long", "o_custkey": "long", "o_totalprice": "double", "o_orderstatus": "double"})
    return df.select("o_orderkey", "o_custkey", r("o_totalprice", 2).alias("o_totalprice"), "o_orderdate", F.col("o_orderstatus").alias("status_number"))


@query("S1_whitespace_scan", "SELECT s_suppkey, s_nationkey, (round(s_acctbal, 2) + 0.0) AS s_acctbal FROM supplier")
def _(spark, sf):
    path = scratch_path(spark, "supplier-ws")
    s = table(spark, sf, "supplier")
    head = spark.range(1).select(F.lit("#s_suppkey  s_nationkey   s_acctbal").alias("value"))
    head.unionByName(s.select(F.format_string("%d   %d  %s", "s_suppkey", "s_nationkey", F.col("s_acctbal").cast("string")).alias("value"))).write.text(path)
    df = tables.read_table(spark, path, "ws", ["s_suppkey"], {"s_suppkey": "long", "s_nationkey": "int", "s_acctbal": "double"}, ["s_suppkey", "s_nationkey", "s_acctbal"])
    return df.select("s_suppkey", "s_nationkey", r("s_acctbal", 2).alias("s_acctbal"))


@query("S2_semi_scan", "SELECT l_orderkey, l_partkey, l_linenumber, l_quantity FROM lineitem WHERE l_partkey IN (SELECT p_partkey FROM part WHERE p_size > 45)")
def _(spark, sf):
    wanted = table(spark, sf, "part").where("p_size > 45").select(F.col("p_partkey").alias("l_partkey"))
    return tables.semi_scan(table(spark, sf, "lineitem"), wanted, "l_partkey").select("l_orderkey", "l_partkey", "l_linenumber", "l_quantity")


@query("S3_multi_source_responses", sql("responses", """SELECT pid, qid, answer, survey, count(*) AS n FROM responses
 WHERE qid IN ('click', 'view') AND pid IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0) GROUP BY ALL"""))
def _(spark, sf):
    rows = roles.responses(spark, sf).select(
        F.col("pid").alias("person_id"), F.col("qid").alias("question_concept_id"), F.col("qid").alias("question"), "answer", "survey", F.col("ts").alias("survey_datetime")
    )
    base = scratch_path(spark, "responses")
    for s in ("S0", "S1"):
        rows.where(F.col("survey") == s).write.csv(f"{base}/{s}", header=True)
    keep = table(spark, sf, "customer").where("c_acctbal > 0").select(F.col("c_custkey").cast("string").alias("person_id"))
    df = tables.read_responses(spark, [f"{base}/S0", f"{base}/S1", f"{base}/absent"], keep, qids=["click", "view"])
    return df.groupBy(F.col("person_id").cast("long").alias("pid"), F.col("question_concept_id").alias("qid"), "answer", "survey").agg(F.count(F.lit(1)).alias("n"))


@query("S4_extract_with_age", f"""SELECT o_orderkey, c_custkey, {rs("date_diff('day', DATE '1950-01-01' + CAST(c_custkey % 9000 AS INTEGER), CAST(o_orderdate AS DATE)) / 365.25")} AS age
 FROM orders JOIN customer ON o_custkey = c_custkey""")
def _(spark, sf):
    p = table(spark, sf, "customer").select("c_custkey", F.date_add(F.lit("1950-01-01").cast("date"), (F.col("c_custkey") % 9000).cast("int")).alias("birth"))
    o = table(spark, sf, "orders").select("o_orderkey", F.col("o_custkey").alias("c_custkey"), "o_orderdate")
    return tables.extract_with_age(o, p, "c_custkey", "o_orderdate", "birth").select("o_orderkey", "c_custkey", r("age").alias("age"))


@query("S5_compact_sink", sql("variants", f"""SELECT s.pheno_id, rsid, chrom, CAST(pos AS INTEGER) AS pos, alt AS allele1, ref AS allele2, {rs('CAST(CASE WHEN obs_ct > 0 THEN alt_ct / CAST(obs_ct AS DOUBLE) END AS FLOAT)')} AS a1freq,
 {rs('CAST(beta AS FLOAT)')} AS beta, {rs('CAST(se AS FLOAT)')} AS se, CAST(n AS INTEGER) AS n FROM variants JOIN (SELECT l_returnflag AS pheno_id, l_partkey AS variant_id, avg(l_discount) AS beta, stddev_samp(l_discount) AS se, count(*) AS n FROM lineitem GROUP BY ALL) s USING (variant_id)"""))
def _(spark, sf):
    path = scratch_path(spark, "compact")
    v = roles.variants(spark, sf)
    ref = v.select("rsid", "chrom", "pos", F.col("alt").alias("allele1"), F.col("ref").alias("allele2"), F.when(F.col("obs_ct") > 0, F.col("alt_ct") / F.col("obs_ct")).alias("a1freq"))
    li = table(spark, sf, "lineitem")
    stats = li.groupBy(F.col("l_returnflag").alias("pheno_id"), F.concat(F.lit("rs"), F.col("l_partkey").cast("string")).alias("rsid")).agg(
        F.avg("l_discount").alias("beta"), F.stddev("l_discount").alias("se"), F.count(F.lit(1)).alias("n")
    )
    sinks.write_compact(stats, ref, path)
    back = spark.read.parquet(f"{path}/traits").join(spark.read.parquet(f"{path}/reference"), "rsid")
    return back.select("pheno_id", "rsid", "chrom", "pos", "allele1", "allele2", r("a1freq").alias("a1freq"), r("beta").alias("beta"), r("se").alias("se"), "n")


@query("S6_partitioned_sink", "SELECT p_type AS chrom, count(*) AS n_in, count(*) AS n_out, true AS ok FROM part GROUP BY p_type")
def _(spark, sf):
    return sinks.write_partitioned(roles.variants(spark, sf).select("chrom", "pos", "rsid", "ref", "alt"), scratch_path(spark, "by-chrom"), "chrom")


@query("S7_variant_id_maps", sql("variants", "SELECT chrom, chrom || ':' || pos || ':' || ref || ':' || alt AS variant_key, rsid FROM variants"))
def _(spark, sf):
    return sinks.variant_id_maps(roles.variants(spark, sf))


@query("S8_metric_table", f"""SELECT 'n_rows' AS metric, CAST(count(*) AS DOUBLE) AS value FROM lineitem UNION ALL SELECT 'mean_quantity', {rs('avg(l_quantity)')} FROM lineitem
 UNION ALL SELECT 'max_price', {rs('max(l_extendedprice)', 2)} FROM lineitem UNION ALL SELECT 'n_returned', CAST(count(*) FILTER (l_returnflag = 'R') AS DOUBLE) FROM lineitem""")
def _(spark, sf):
    t = sinks.metric_table(table(spark, sf, "lineitem"), {
        "n_rows": "count(1)", "mean_quantity": "avg(l_quantity)", "max_price": "max(l_extendedprice)", "n_returned": "count_if(l_returnflag = 'R')"})
    return t.select("metric", r("value").alias("value"))


@query("S9_pending_work", """SELECT o_orderkey, o_orderpriority FROM orders o WHERE NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey
 AND (CASE WHEN l.l_returnflag = 'A' THEN '1-URGENT' WHEN l.l_returnflag = 'N' THEN '5-LOW' END) IS NOT DISTINCT FROM (CASE WHEN o.o_orderpriority <> '3-MEDIUM' THEN o.o_orderpriority END))""")
def _(spark, sf):
    m = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority", F.when(F.col("o_orderpriority") != "3-MEDIUM", F.col("o_orderpriority")).alias("setting"))
    d = table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("o_orderkey"), F.when(F.col("l_returnflag") == "A", "1-URGENT").when(F.col("l_returnflag") == "N", "5-LOW").alias("setting")
    ).distinct()
    return sinks.pending(m, d, ["o_orderkey"], ["setting"]).select("o_orderkey", "o_orderpriority")


_PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


@query("S10_batch_wide", sql("traits", "SELECT iid, " + ", ".join(f"{rs(f'''max(CASE WHEN pheno_id = '{p}' THEN y END)''')} AS t{i}" for i, p in enumerate(_PRIORITIES)) + " FROM traits GROUP BY iid"))
def _(spark, sf):
    w = sinks.batch_wide(roles.traits(spark, sf), _PRIORITIES)
    return w.select("iid", *[r(F.col(f"`{p}`")).alias(f"t{i}") for i, p in enumerate(_PRIORITIES)])


@query("S11_split_duplicates", "SELECT p_name, count(*) FILTER (k) AS n_kept, count(*) FILTER (NOT k) AS n_repeats FROM (SELECT p_name, p_partkey = min(p_partkey) OVER (PARTITION BY p_name) AS k FROM part) GROUP BY p_name")
def _(spark, sf):
    s = sinks.split_duplicates(table(spark, sf, "part").select("p_name", "p_partkey"), "p_name", "p_partkey")
    return s.groupBy("p_name").agg(F.count_if("kept").alias("n_kept"), F.count_if(~F.col("kept")).alias("n_repeats"))


@query("S12_fingerprint")
def _(spark, sf):
    return R.union_all([sinks.fingerprint(table(spark, sf, t)).withColumn("table", F.lit(t)) for t in ("orders", "lineitem", "customer")])


def _tree(rows: str, by: str) -> str:
    """n_leaves and digest per group, from rows with `leaf`."""
    return f"""(SELECT {by}, CAST(sum(n) AS BIGINT) AS n_leaves, md5(string_agg(node || ':' || n || ':' || a || ':' || b, ',' ORDER BY node)) AS digest FROM (SELECT {by}, substr(leaf, 1, 2) AS node, count(*) AS n,
 sum(CAST('0x' || substr(leaf, 1, 15) AS BIGINT)) AS a, sum(CAST('0x' || substr(leaf, 16, 15) AS BIGINT)) AS b FROM ({rows}) GROUP BY ALL) GROUP BY {by})"""


_LEAF = lambda *cols: "md5(" + " || ".join(f"length({t}) || ':' || {t}" for t in (f"coalesce(CAST({c} AS VARCHAR), chr(0))" for c in cols)) + ")"


@query("S12_row_tree", f"SELECT o_orderpriority AS grp, n_leaves, digest FROM {_tree('SELECT o_orderpriority, ' + _LEAF('o_custkey', 'o_orderkey', 'o_orderstatus') + ' AS leaf FROM orders', 'o_orderpriority')}")
def _(spark, sf):
    """Signature of the orders of each priority, the same however rows are split."""
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", F.col("o_orderpriority").alias("grp"))
    return ledger.row_tree(o, ["grp"])


_LINE = "variant_id || '|' || chrom || '|' || pos || '|' || ref || '|' || alt"


@query("S12_file_fingerprint", sql("variants", f"SELECT 'chrom=' || chrom AS grp, n_leaves, n_bytes, digest FROM {_tree(f'SELECT chrom, md5({_LINE}) AS leaf FROM variants', 'chrom')} JOIN (SELECT chrom, CAST(sum(length({_LINE}) + 1) AS BIGINT) AS n_bytes FROM variants GROUP BY chrom) USING (chrom)"))
def _(spark, sf):
    """Signature of the files of each chromosome, from the files."""
    path = scratch_path(spark, "hash-input")
    line = F.concat_ws("|", *[F.col(c).cast("string") for c in ("variant_id", "chrom", "pos", "ref", "alt")])
    roles.variants(spark, sf).select("chrom", line.alias("line")).write.partitionBy("chrom").text(path)
    return ledger.file_tree(spark, path, F.element_at(F.split("file", "/"), -2)).drop("n_files")


@query("S13_id_list", "SELECT p_partkey FROM part")
def _(spark, sf):
    return tables.read_id_list(table(spark, sf, "part").select("p_partkey"), "p_partkey")


@query("S13_duplicate_ids", "SELECT p_name, count(*) AS n FROM part GROUP BY p_name HAVING count(*) > 1")
def _(spark, sf):
    return tables.duplicate_ids(table(spark, sf, "part"), "p_name")
