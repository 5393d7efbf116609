"""Domain roles laid over the given tables: each DataFrame has a SQL twin used by the counterpart queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import responses as R
from .registry import table

SQL: dict[str, tuple[str, list[str]]] = {}


def sql(needs: str, body: str) -> str:
    """Body with the named roles, and whatever they need, in front as common table expressions."""
    seen: list[str] = []

    def add(name: str) -> None:
        if name in seen:
            return
        for dep in SQL[name][1]:
            add(dep)
        seen.append(name)

    for name in needs.split():
        add(name)
    ctes = ", ".join(f"{n} AS ({SQL[n][0]})" for n in seen)
    body = body.strip()
    if body[:5].upper() == "WITH ":
        return f"WITH {ctes}, {body[5:]}"
    return f"WITH {ctes} {body}"


def role(name: str, text: str, needs: str = "") -> None:
    SQL[name] = (text, needs.split())


# survey responses ---------------------------------------------------------------------------------------------------------
def responses(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "events")
    k = F.regexp_extract("props", '"k": *([0-9]+)', 1).cast("int")
    e = e.select("event_id", F.col("user_id").alias("pid"), F.col("event_type").alias("qid"), F.to_date("ts").alias("ts"), k.alias("k"), F.round("value", 2).alias("num"))
    return e.select(
        "event_id", "pid", "qid", "ts", "k", "num",
        F.when(F.col("k") % 10 == 0, "PMI: Skip").otherwise(F.concat(F.lit("Level: "), (F.col("k") % 5).cast("string"))).alias("answer"),
        (1000 + F.col("k") % 5).cast("string").alias("concept"),
        F.concat(F.lit("S"), (F.col("k") % 2).cast("string")).alias("survey"),
        (20 + F.col("pid") % 60 + F.datediff("ts", F.lit("2024-01-01").cast("date")) / 365.25).alias("age"),
    )


role("responses", """SELECT event_id, user_id AS pid, event_type AS qid, CAST(ts AS DATE) AS ts,
 CAST(regexp_extract(props, '"k": *([0-9]+)', 1) AS INTEGER) AS k, round(value, 2) AS num,
 CASE WHEN CAST(regexp_extract(props, '"k": *([0-9]+)', 1) AS INTEGER) % 10 = 0 THEN 'PMI: Skip'
      ELSE 'Level: ' || CAST(CAST(regexp_extract(props, '"k": *([0-9]+)', 1) AS INTEGER) % 5 AS VARCHAR) END AS answer,
 CAST(1000 + CAST(regexp_extract(props, '"k": *([0-9]+)', 1) AS INTEGER) % 5 AS VARCHAR) AS concept,
 'S' || CAST(CAST(regexp_extract(props, '"k": *([0-9]+)', 1) AS INTEGER) % 2 AS VARCHAR) AS survey,
 20 + user_id % 60 + date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) / CAST(365.25 AS DOUBLE) AS age FROM events""")


def selected(spark, sf):
    return R.latest_valid(responses(spark, sf))


role("latest", """SELECT * FROM (SELECT *, rank() OVER (PARTITION BY pid, qid ORDER BY ts DESC) AS rk FROM responses
 WHERE answer <> 'PMI: Skip') WHERE rk = 1""", "responses")
role("selected", "SELECT pid, qid, ts, min(age) AS age, list_sort(list(DISTINCT answer)) AS answers FROM latest GROUP BY ALL", "latest")


def single(spark, sf):
    """Single answers with their level as y."""
    return R.single_answer(selected(spark, sf)).withColumn("y", F.substring_index("answer", ": ", -1).cast("double"))


role("single", "SELECT pid, qid, ts, age, answers[1] AS answer, CAST(right(answers[1], 1) AS DOUBLE) AS y FROM selected WHERE len(answers) = 1", "selected")


# people --------------------------------------------------------------------------------------------------------------------
def people(spark, sf):
    c = table(spark, sf, "customer")
    return c.select(
        F.col("c_custkey").alias("iid"),
        F.when(F.col("c_custkey") % 23 != 0, (F.col("c_custkey") % 2).cast("int")).alias("sex_01"),
        (20 + F.col("c_custkey") % 60).cast("double").alias("age"),
        (F.col("c_acctbal") / 1000.0).alias("pc1"),
        (F.col("c_nationkey") - 12).cast("double").alias("pc2"),
        ((F.col("c_custkey") * 7919) % 1000 / 1000.0 - 0.5).alias("pc3"),
        F.col("c_mktsegment").alias("segment"),
        F.col("c_nationkey").alias("nation"),
    )


role("people", """SELECT c_custkey AS iid, CASE WHEN c_custkey % 23 <> 0 THEN CAST(c_custkey % 2 AS INTEGER) END AS sex_01,
 CAST(20 + c_custkey % 60 AS DOUBLE) AS age, c_acctbal / 1000.0 AS pc1, CAST(c_nationkey - 12 AS DOUBLE) AS pc2,
 CAST((c_custkey * 7919) % 1000 AS DOUBLE) / CAST(1000.0 AS DOUBLE) - CAST(0.5 AS DOUBLE) AS pc3, c_mktsegment AS segment, c_nationkey AS nation FROM customer""")


def traits(spark, sf):
    """Long trait values: mean order price (thousands) per customer, one trait per order priority."""
    o = table(spark, sf, "orders")
    y = o.groupBy(F.col("o_orderpriority").alias("pheno_id"), F.col("o_custkey").alias("iid")).agg(F.round(F.avg("o_totalprice") / 1000.0, 2).alias("y"))
    return y.withColumn("age", (20 + F.col("iid") % 60).cast("double"))


role("traits", """SELECT o_orderpriority AS pheno_id, o_custkey AS iid, round(avg(o_totalprice) / 1000.0, 2) AS y,
 CAST(20 + o_custkey % 60 AS DOUBLE) AS age FROM orders GROUP BY o_orderpriority, o_custkey""")


def exact_traits(spark, sf):
    """As `traits`, by whole cents: halves are rounded away from zero, in whatever order the prices are added."""
    o = table(spark, sf, "orders").groupBy(F.col("o_orderpriority").alias("pheno_id"), F.col("o_custkey").alias("iid"))
    s = o.agg(F.sum(F.round(F.col("o_totalprice") * 100).cast("long")).alias("s"), F.nullif(F.count("o_totalprice"), F.lit(0)).alias("n"))
    return s.select("pheno_id", "iid", F.expr("sign(s) * ((2 * abs(s) + 1000 * n) div (2000 * n)) / 100.0D").alias("y"))


role("exact_traits", """SELECT pheno_id, iid, sign(s) * ((2 * abs(s) + 1000 * n) // (2000 * n)) / CAST(100.0 AS DOUBLE) AS y FROM (SELECT o_orderpriority AS pheno_id, o_custkey AS iid,
 CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) AS s, nullif(count(o_totalprice), 0) AS n FROM orders GROUP BY o_orderpriority, o_custkey)""")


# measurements and wearables ------------------------------------------------------------------------------------------------
def measures(spark, sf):
    x = table(spark, sf, "lineitem")
    return x.select(
        F.col("l_suppkey").alias("pid"), F.col("l_returnflag").alias("measure"), F.to_date("l_shipdate").alias("dt"),
        F.col("l_orderkey").alias("oid"), F.col("l_linenumber").alias("line"),
        F.col("l_quantity").alias("value"), (F.col("l_extendedprice") / 1000.0).alias("value2"), (20 + F.col("l_suppkey") % 60).cast("double").alias("age"),
    )


role("measures", """SELECT l_suppkey AS pid, l_returnflag AS measure, CAST(l_shipdate AS DATE) AS dt, l_orderkey AS oid, l_linenumber AS line,
 l_quantity AS value, l_extendedprice / 1000.0 AS value2, CAST(20 + l_suppkey % 60 AS DOUBLE) AS age FROM lineitem""")


def wear(spark, sf):
    d = responses(spark, sf).groupBy("pid", F.col("ts").alias("day")).agg(
        F.round(F.sum("num"), 2).alias("steps"), F.max(F.when(F.col("k") % 4 != 0, F.col("k").cast("double"))).alias("sleep"), F.min("age").alias("age")
    )
    return d


role("wear", """SELECT pid, ts AS day, round(sum(num), 2) AS steps, max(CASE WHEN k % 4 <> 0 THEN CAST(k AS DOUBLE) END) AS sleep, min(age) AS age
 FROM responses GROUP BY pid, ts""", "responses")


def sittings(spark, sf):
    """Turns of a conversation as nested trials of a sitting."""
    c = table(spark, sf, "conversations")
    trial = F.struct(F.col("turn"), F.col("role").alias("emotion"), (F.length("text") % 2 == 0).alias("correct"), (F.length("text") * 1.0).alias("reaction_time"))
    return c.select(
        (F.col("conv_id") % 40).alias("pid"), F.col("conv_id").alias("sitting_id"), (F.length("text") > 400).cast("int").alias("restarted"),
        F.array(trial).alias("trial_data"),
    )


role("trials", """SELECT conv_id % 40 AS pid, conv_id AS sitting_id, CAST(length(text) > 400 AS INTEGER) AS restarted, role AS emotion,
 length(text) % 2 = 0 AS correct, CAST(length(text) AS DOUBLE) AS reaction_time FROM conversations""")


# variants, genotypes, pairs ------------------------------------------------------------------------------------------------
def variants(spark, sf):
    p = table(spark, sf, "part")
    b = F.substring_index("p_brand", "#", -1).cast("int")
    p = p.select("p_partkey", "p_type", "p_size", b.alias("b"), "p_retailprice")
    return p.select(
        F.col("p_partkey").alias("variant_id"), F.col("p_type").alias("chrom"), (F.col("p_partkey") * 50 + F.col("p_size")).alias("pos"),
        F.expr("substring('ACGT', b % 4 + 1, 1)").alias("ref"), F.expr("substring('ACGT', (b + 1 + p_size % 3) % 4 + 1, 1)").alias("alt"),
        F.concat(F.lit("rs"), F.col("p_partkey").cast("string")).alias("rsid"),
        F.when(F.col("p_partkey") % 97 == 0, F.lit(0)).otherwise(F.lit(400)).cast("long").alias("obs_ct"),
        F.when(F.col("p_partkey") % 97 == 0, F.lit(0)).otherwise((F.col("p_retailprice") * 10).cast("long") % 400).cast("long").alias("alt_ct"),
        F.when(F.col("p_partkey") % 89 != 0, F.col("p_size") / 500.0).alias("f_miss"),
    )


role("variants", """SELECT p_partkey AS variant_id, p_type AS chrom, p_partkey * 50 + p_size AS pos,
 substr('ACGT', CAST(split_part(p_brand, '#', 2) AS INTEGER) % 4 + 1, 1) AS ref,
 substr('ACGT', (CAST(split_part(p_brand, '#', 2) AS INTEGER) + 1 + p_size % 3) % 4 + 1, 1) AS alt, 'rs' || CAST(p_partkey AS VARCHAR) AS rsid,
 CAST(CASE WHEN p_partkey % 97 = 0 THEN 0 ELSE 400 END AS BIGINT) AS obs_ct,
 CASE WHEN p_partkey % 97 = 0 THEN CAST(0 AS BIGINT) ELSE CAST(floor(p_retailprice * 10) AS BIGINT) % 400 END AS alt_ct,
 CASE WHEN p_partkey % 89 <> 0 THEN p_size / CAST(500.0 AS DOUBLE) END AS f_miss FROM part""")


def reference_freq(spark, sf):
    """A second source of the same variants: some swapped, some on the other strand, some wrong, some absent."""
    v = variants(spark, sf).where("alt_ct not between 30 and 39")
    m = F.col("variant_id") % 5
    swap, flip = m.isin(1, 3), m.isin(2, 3)
    strand = lambda c: F.when(flip, F.translate(c, "ACGT", "TGCA")).otherwise(F.col(c))
    wrong = F.col("variant_id") % 53 == 0
    f = F.least(F.lit(0.99), F.greatest(F.lit(0.01), F.col("alt_ct") / 400.0 + (F.col("variant_id") % 9 - 4) / 100.0))
    return v.select(
        "variant_id", "chrom", "pos", "rsid",
        F.when(wrong, "N").when(swap, strand("ref")).otherwise(strand("alt")).alias("a1"),
        F.when(swap, strand("alt")).otherwise(strand("ref")).alias("a2"),
        F.when(swap, F.lit(1.0) - f).otherwise(f).alias("a1_freq"),
    )


role("reference_freq", """SELECT variant_id, chrom, pos, rsid,
 CASE WHEN variant_id % 53 = 0 THEN 'N' WHEN s THEN (CASE WHEN f THEN translate(ref, 'ACGT', 'TGCA') ELSE ref END)
      ELSE (CASE WHEN f THEN translate(alt, 'ACGT', 'TGCA') ELSE alt END) END AS a1,
 CASE WHEN s THEN (CASE WHEN f THEN translate(alt, 'ACGT', 'TGCA') ELSE alt END) ELSE (CASE WHEN f THEN translate(ref, 'ACGT', 'TGCA') ELSE ref END) END AS a2,
 CASE WHEN s THEN 1.0 - fr ELSE fr END AS a1_freq
 FROM (SELECT *, variant_id % 5 IN (1, 3) AS s, variant_id % 5 IN (2, 3) AS f,
  least(CAST(0.99 AS DOUBLE), greatest(CAST(0.01 AS DOUBLE), alt_ct / CAST(400.0 AS DOUBLE) + (variant_id % 9 - 4) / CAST(100.0 AS DOUBLE))) AS fr FROM variants WHERE alt_ct NOT BETWEEN 30 AND 39)""", "variants")


def genotypes(spark, sf):
    """Dosage per variant and sample; a dosage can be missing."""
    g = table(spark, sf, "lineitem").groupBy(F.col("l_partkey").alias("variant_id"), F.col("l_suppkey").alias("sample_id")).agg(F.sum("l_quantity").cast("long").alias("q"))
    return g.select("variant_id", "sample_id", F.when(F.col("q") % 11 != 0, (F.col("q") % 3).cast("int")).alias("dosage"))


role("genotypes", """SELECT variant_id, sample_id, CASE WHEN q % 11 <> 0 THEN CAST(q % 3 AS INTEGER) END AS dosage FROM
 (SELECT l_partkey AS variant_id, l_suppkey AS sample_id, CAST(sum(l_quantity) AS BIGINT) AS q FROM lineitem GROUP BY l_partkey, l_suppkey)""")


def edges(spark, sf):
    """Relatedness pairs, unordered and unique."""
    o = table(spark, sf, "orders").select(
        F.col("o_custkey").alias("iid1"), (F.col("o_custkey") + 1 + F.col("o_orderkey") % 3).alias("iid2"),
        ((F.col("o_orderkey") * 13) % 1000 / 2000.0).alias("kinship"), (F.col("o_orderkey") % 29 / 10000.0).alias("ibs0"),
    )
    return o.groupBy("iid1", "iid2").agg(F.max("kinship").alias("kinship"), F.min("ibs0").alias("ibs0"))


role("edges", """SELECT iid1, iid2, max(kinship) AS kinship, min(ibs0) AS ibs0 FROM
 (SELECT o_custkey AS iid1, o_custkey + 1 + o_orderkey % 3 AS iid2, (o_orderkey * 13) % 1000 / CAST(2000.0 AS DOUBLE) AS kinship,
  o_orderkey % 29 / CAST(10000.0 AS DOUBLE) AS ibs0 FROM orders) GROUP BY iid1, iid2""")


# scores --------------------------------------------------------------------------------------------------------------------
def scores(spark, sf):
    """Person features, target, fold and role."""
    o = table(spark, sf, "orders").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"), F.avg("o_totalprice").alias("m"), F.max("o_totalprice").alias("mx"))
    c = table(spark, sf, "customer").join(o, F.col("c_custkey") == F.col("o_custkey"))
    return c.select(
        F.col("c_custkey").alias("iid"), (F.col("c_acctbal") / 1000.0).alias("x1"), F.col("n").cast("double").alias("x2"),
        F.round(F.col("mx") / 100000.0, 4).alias("x3"), F.round(F.col("m") / 100000.0, 4).alias("target"),
        (F.col("c_custkey") % 5).cast("int").alias("fold"), F.when(F.col("c_custkey") % 6 == 5, "applied").otherwise("oof").alias("role"),
        F.col("c_mktsegment").alias("segment"),
    )


role("scores", """SELECT c_custkey AS iid, c_acctbal / 1000.0 AS x1, CAST(n AS DOUBLE) AS x2, round(mx / 100000.0, 4) AS x3, round(m / 100000.0, 4) AS target,
 CAST(c_custkey % 5 AS INTEGER) AS fold, CASE WHEN c_custkey % 6 = 5 THEN 'applied' ELSE 'oof' END AS role, c_mktsegment AS segment
 FROM customer JOIN (SELECT o_custkey, count(*) AS n, avg(o_totalprice) AS m, max(o_totalprice) AS mx FROM orders GROUP BY o_custkey) ON c_custkey = o_custkey""")


def items(spark, sf):
    """Scale items: every single answer is an item, named by its question."""
    return single(spark, sf).select("pid", F.col("qid").alias("item"), "y", "age")


role("items", "SELECT pid, qid AS item, y, age FROM single", "single")
