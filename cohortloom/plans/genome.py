"""Variant quality, components and association over the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import aggregates as A
from ..operators import variants as V
from ..operators import windows as X
from ..session import cut
from ..sources import sinks
from . import roles
from .aggregations import rcols
from .projections import S_ALIGN
from .registry import query, rs, table
from .roles import role, sql

role("laddered", """SELECT *, CASE WHEN ref_freq IS NULL THEN 'alignment' WHEN freq IS NULL OR abs(freq - ref_freq) > 0.03 THEN 'frequency_difference' WHEN least(freq, 1 - freq) < 0.1 THEN 'maf'
 WHEN f_miss IS NULL OR f_miss > 0.05 THEN 'missingness' END AS failed_step FROM (SELECT v.variant_id, v.f_miss, CASE WHEN obs_ct > 0 THEN alt_ct / CAST(obs_ct AS DOUBLE) END AS freq,
 CASE WHEN f.a1 = v.alt AND f.a2 = v.ref THEN f.a1_freq WHEN f.a1 = v.ref AND f.a2 = v.alt THEN 1 - f.a1_freq END AS ref_freq FROM variants v LEFT JOIN reference_freq f USING (variant_id))""", "variants reference_freq")


def ladder(spark, sf):
    return V.variant_ladder(roles.variants(spark, sf), roles.reference_freq(spark, sf), 0.0300001, 0.1, 0.05)


@query("V1_variant_ladder", sql("laddered", f"SELECT variant_id, {rs('freq')} AS freq, {rs('ref_freq')} AS ref_freq, failed_step FROM laddered").replace("> 0.03 THEN", "> 0.0300001 THEN"))
def _(spark, sf):
    return rcols(ladder(spark, sf).select("variant_id", "freq", "ref_freq", "failed_step"), "freq", "ref_freq")


@query("V1_ladder_steps", sql("laddered", """SELECT CAST(step AS INTEGER) AS step, name, dropped, total, CAST(total - sum(dropped) OVER (ORDER BY step) AS BIGINT) AS remaining FROM (SELECT step, name, (SELECT count(*) FROM laddered WHERE failed_step = name) AS dropped, (SELECT count(*) FROM laddered) AS total
 FROM (VALUES (1, 'alignment'), (2, 'frequency_difference'), (3, 'maf'), (4, 'missingness')) v(step, name))""").replace("> 0.03 THEN", "> 0.0300001 THEN"))
def _(spark, sf):
    return A.filter_steps(ladder(spark, sf), V.LADDER_STEPS)


@query("V2_presence", "SELECT p_type AS chrom, count(*) AS requested, count(*) FILTER (p_partkey IN (SELECT l_partkey FROM lineitem WHERE l_quantity > 45)) AS found, count(*) FILTER (p_partkey NOT IN (SELECT l_partkey FROM lineitem WHERE l_quantity > 45)) AS absent FROM part GROUP BY p_type")
def _(spark, sf):
    seen = table(spark, sf, "lineitem").where("l_quantity > 45").select(F.col("l_partkey").alias("variant_id"))
    return V.presence(roles.variants(spark, sf).select("variant_id", "chrom"), seen, "variant_id")


_MULTI = "CASE WHEN p_size % 3 = 0 THEN 'A,CA,' || upper(left(p_name, 2)) WHEN p_size % 3 = 1 THEN 'TA' ELSE 'G,T' END"


@query("V3_multiallelic_split", f"""SELECT chrom, pos, CAST(i - 1 AS INTEGER) AS allele_idx, left(r, length(r) - k) AS ref, left(x, length(x) - k) AS alt, chrom || ':' || pos || ':' || left(r, length(r) - k) || ':' || left(x, length(x) - k) AS variant_key FROM (SELECT *,
 CAST(coalesce(len([j FOR j IN range(1, least(length(r), length(x))) IF right(r, j) = right(x, j)]), 0) AS INTEGER) AS k FROM (SELECT p_type AS chrom, p_partkey AS pos, 'GA' AS r, unnest(string_split({_MULTI}, ',')) AS x, unnest(range(1, len(string_split({_MULTI}, ',')) + 1)) AS i FROM part))""")
def _(spark, sf):
    p = table(spark, sf, "part").select(F.col("p_type").alias("chrom"), F.col("p_partkey").alias("pos"), F.lit("GA").alias("ref"), F.expr(_MULTI).alias("alt"))
    return V.split_multiallelic(p)


@query("V4_id_remap", sql("variants", "SELECT variant_id, CASE WHEN f_miss < 0.075 THEN rsid ELSE chrom || ':' || pos || ':' || ref || ':' || alt END AS id, coalesce(f_miss < 0.075, false) AS mapped FROM variants"))
def _(spark, sf):
    v = roles.variants(spark, sf)
    m = sinks.variant_id_maps(v)
    v = v.withColumn("variant_key", F.concat_ws(":", "chrom", F.col("pos").cast("string"), "ref", "alt"))
    known = v.where("f_miss < 0.075").select("variant_key").join(m, "variant_key").select("variant_key", "rsid")
    return V.remap_ids(v.drop("rsid"), known).select("variant_id", "id", "mapped")


def geno_reference(spark, sf):
    """Reference frequencies near one half, so that observed dosages can pass."""
    return roles.reference_freq(spark, sf).withColumn("a1_freq", 0.35 + F.col("a1_freq") * 0.3)


def qc(spark, sf):
    s = table(spark, sf, "supplier").where("s_acctbal > 1000").select(F.col("s_suppkey").alias("sample_id"))
    ranges = table(spark, sf, "nation").select(F.when(F.col("n_regionkey") % 2 == 0, "ECONOMY").otherwise("SMALL").alias("chrom"), (F.col("n_nationkey") * 3000).alias("start"), (F.col("n_nationkey") * 3000 + 1100).alias("end"))
    return V.sequential_qc(roles.genotypes(spark, sf), s, roles.variants(spark, sf), geno_reference(spark, sf), ranges, 0.1500001, 0.3, 0.12, 0.08, WINDOW, STEP, R2)


role("qc", """SELECT * FROM genotypes WHERE sample_id IN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 1000)""", "genotypes")
role("qv", """SELECT v.variant_id, v.chrom, v.pos, q.f, q.m FROM variants v JOIN (SELECT variant_id, CASE WHEN count(dosage) > 0 THEN sum(dosage) / CAST(count(dosage) * 2 AS DOUBLE) END AS f, avg(CASE WHEN dosage IS NULL THEN 1.0 ELSE 0.0 END) AS m FROM qc GROUP BY variant_id) q USING (variant_id)
 JOIN (SELECT variant_id, a1, a2, 0.35 + a1_freq * 0.3 AS a1_freq FROM reference_freq) r USING (variant_id) WHERE abs(q.f - CASE WHEN r.a1 = v.alt AND r.a2 = v.ref THEN r.a1_freq WHEN r.a1 = v.ref AND r.a2 = v.alt THEN 1 - r.a1_freq END) <= 0.1500001""", "qc variants reference_freq")
role("q3", "SELECT * FROM qc WHERE variant_id IN (SELECT variant_id FROM qv WHERE least(f, 1 - f) >= 0.3 AND m <= 0.12)", "qv")
role("q4", "SELECT * FROM q3 WHERE sample_id IN (SELECT sample_id FROM q3 GROUP BY sample_id HAVING avg(CASE WHEN dosage IS NULL THEN 1.0 ELSE 0.0 END) <= 0.08)", "q3")
role("q5", """SELECT * FROM q4 WHERE variant_id NOT IN (SELECT v.variant_id FROM variants v JOIN (SELECT CASE WHEN n_regionkey % 2 = 0 THEN 'ECONOMY' ELSE 'SMALL' END AS chrom, n_nationkey * 3000 AS s, n_nationkey * 3000 + 1100 AS e FROM nation) r
 ON r.chrom = v.chrom AND v.pos > r.s AND v.pos <= r.e)""", "q4 variants")


WINDOW, STEP, R2 = 1000, 80, 0.1
_R2 = "pow(n * sxy - sx * sy, 2) / ((n * sxx - sx * sx) * (n * syy - sy * sy))"


def _linked(geno: str, vars_: str) -> str:
    """Pairs above the limit that a window holds: places i and j in the chromosome, n, value, and the number k of the first window with both."""
    return f"""(WITH o AS (SELECT variant_id, chrom, row_number() OVER (PARTITION BY chrom ORDER BY pos, variant_id) - 1 AS p FROM {vars_}), g AS (SELECT g.variant_id, sample_id, CAST(dosage AS DOUBLE) AS d, chrom, p FROM {geno} g JOIN o USING (variant_id) WHERE dosage IS NOT NULL),
 s AS (SELECT a.chrom, a.p AS i, b.p AS j, a.variant_id AS variant_i, b.variant_id AS variant_j, count(*) AS n, sum(a.d) AS sx, sum(b.d) AS sy, sum(a.d * a.d) AS sxx, sum(b.d * b.d) AS syy, sum(a.d * b.d) AS sxy FROM g a JOIN g b ON a.chrom = b.chrom AND a.sample_id = b.sample_id AND b.p > a.p AND b.p - a.p < {WINDOW} GROUP BY ALL)
 SELECT chrom, i, j, variant_i, variant_j, n, {_R2} AS value, greatest(0, CAST(ceil((j - {WINDOW} + 1) / {STEP}.0) AS BIGINT)) AS k FROM s WHERE n > 1 AND n * sxx - sx * sx > 0 AND n * syy - sy * sy > 0 AND {_R2} > CAST({R2} AS DOUBLE))"""


def _pruned(geno: str, vars_: str) -> str:
    """The greedy pass row by row: one step per window and left variant."""
    return f"""(WITH RECURSIVE m AS (SELECT variant_id, coalesce(least(f, 1 - f), 0) AS maf FROM (SELECT v.variant_id, CASE WHEN count(dosage) > 0 THEN sum(dosage) / CAST(count(dosage) * 2 AS DOUBLE) END AS f FROM {vars_} v LEFT JOIN {geno} g USING (variant_id) GROUP BY v.variant_id)),
 e AS MATERIALIZED (SELECT *, row_number() OVER (ORDER BY chrom, k, i) AS n FROM (SELECT chrom, k, variant_i AS v, i, list({{'v': variant_j, 'first': a.maf < b.maf}} ORDER BY j) AS js FROM {_linked(geno, vars_)} x JOIN m a ON a.variant_id = variant_i JOIN m b ON b.variant_id = variant_j WHERE k * {STEP} <= i GROUP BY ALL)),
 r(n, chrom, gone, went) AS (SELECT CAST(0 AS BIGINT), CAST(NULL AS VARCHAR), CAST([] AS BIGINT[]), CAST([] AS BIGINT[]) UNION ALL
  SELECT n, chrom, list_concat(known, went), went FROM (SELECT *, CASE WHEN list_contains(known, v) THEN CAST([] AS BIGINT[]) WHEN stop IS NULL THEN list_transform(live, lambda x: x.v) ELSE list_append(list_transform(live[1:stop - 1], lambda x: x.v), v) END AS went
   FROM (SELECT *, nullif(list_position(list_transform(live, lambda x: x.first), true), 0) AS stop FROM (SELECT *, list_filter(js, lambda x: NOT list_contains(known, x.v)) AS live FROM (SELECT e.n, e.chrom, e.v, e.js, CASE WHEN r.chrom = e.chrom THEN r.gone ELSE CAST([] AS BIGINT[]) END AS known FROM r JOIN e ON e.n = r.n + 1)))))
 SELECT variant_id FROM {vars_} WHERE variant_id NOT IN (SELECT unnest(went) FROM r))"""


QV = "(SELECT variant_id, chrom, pos FROM variants WHERE variant_id IN (SELECT variant_id FROM q5))"


def _count(i, name, src):
    return f"SELECT CAST({i} AS INTEGER) AS step, '{name}' AS name, count(DISTINCT variant_id) AS n_variants, count(DISTINCT sample_id) AS n_samples FROM {src}"


@query("V5_sequential_qc", sql("q5", " UNION ALL ".join([
    _count(0, "samples", "qc"), _count(1, "frequency_difference", "qc WHERE variant_id IN (SELECT variant_id FROM qv)"), _count(2, "maf", "qc WHERE variant_id IN (SELECT variant_id FROM qv WHERE least(f, 1 - f) >= 0.3)"),
    _count(3, "geno", "q3"), _count(4, "mind", "q4"), _count(5, "regions", "q5"), _count(6, "ld_prune", f"q5 WHERE variant_id IN (SELECT variant_id FROM {_pruned('q5', QV)})")])))
def _(spark, sf):
    return qc(spark, sf)[2]


@query("V6_ld_pairs", sql("genotypes variants", f"SELECT variant_i, variant_j, n, {rs('value')} AS r2 FROM {_linked('genotypes', 'variants')}"))
def _(spark, sf):
    p = V.ld_pairs(roles.genotypes(spark, sf), roles.variants(spark, sf), WINDOW - 1, R2)
    return rcols(p.select("variant_i", "variant_j", "n", "r2"), "r2")


@query("V6_ld_prune", sql("genotypes variants", f"SELECT variant_id FROM {_pruned('genotypes', 'variants')}"))
def _(spark, sf):
    return V.ld_prune(roles.genotypes(spark, sf), roles.variants(spark, sf), WINDOW, STEP, R2).select("variant_id")


@query("V6_ld_prune_check", "SELECT CAST(0 AS BIGINT) AS n_pairs_left, CAST(0 AS BIGINT) AS n_needlessly_dropped")
def _(spark, sf):
    """No correlated pair is left in a window, and every dropped variant had a correlated one beside it."""
    v = roles.variants(spark, sf)
    g = V.placed(roles.genotypes(spark, sf), v)
    pairs = cut(V.ld_pairs(g, None, WINDOW - 1, R2))
    first = g.variants.groupBy("chrom").agg(F.min("idx").alias("start"))
    k = F.greatest(F.lit(0), F.ceil((F.col("j") - F.col("start") - WINDOW + 1) / STEP))
    pairs = cut(pairs.join(F.broadcast(first), "chrom").where(F.col("start") + k * STEP <= F.col("i")).select("variant_i", "variant_j"))
    kept = cut(V.ld_prune(g, v, WINDOW, STEP, R2).select("variant_id"))
    one = pairs.join(kept.withColumnRenamed("variant_id", "variant_i"), "variant_i", "left_semi")
    left = one.join(kept.withColumnRenamed("variant_id", "variant_j"), "variant_j", "left_semi").agg(F.count(F.lit(1)).alias("n_pairs_left"))
    beside = pairs.select(F.col("variant_i").alias("variant_id")).unionByName(pairs.select(F.col("variant_j").alias("variant_id")))
    lost = v.select("variant_id").join(kept, "variant_id", "left_anti").join(beside, "variant_id", "left_anti").agg(F.count(F.lit(1)).alias("n_needlessly_dropped"))
    return left.crossJoin(lost)  # two single rows


@query("V7_fitted_components")
def _(spark, sf):
    return V.fit_pcs(roles.genotypes(spark, sf), 2)[1]


@query("V7_components_check", sql("genotypes", f"""WITH f AS (SELECT variant_id, avg(dosage) / 2 AS f FROM genotypes GROUP BY variant_id), z AS (SELECT power(dosage - 2 * f, 2) / (2 * f * (1 - f)) AS zz FROM genotypes JOIN f USING (variant_id) WHERE dosage IS NOT NULL AND f > 0 AND f < 1)
 SELECT {rs('sum(zz)', 3)} AS total, true AS orthonormal, true AS settled, true AS share_is_sound FROM z"""))
def _(spark, sf):
    """Total from the cells; scores are orthonormal, residuals within the tolerance, and the share of two components lies between that of two average ones and all."""
    from .registry import r

    g = cut(roles.genotypes(spark, sf))
    found = V.verify_pcs(g, *V.fit_pcs(g, 2, tol=1e-4))
    ranks_ = table(spark, sf, "supplier").count()
    return found.select(r("total", 3).alias("total"), (F.col("skew") < 1e-6).alias("orthonormal"), (F.col("residual") < 2e-4).alias("settled"), ((F.col("share") > 2.0 / ranks_) & (F.col("share") <= 1)).alias("share_is_sound"))


@query("V8_projection", sql("genotypes variants", f"""WITH l AS (SELECT variant_id, f, (pos % 17 - 8) / 10.0 AS w1, (pos % 7 - 3) / 10.0 AS w2 FROM variants JOIN (SELECT variant_id, avg(dosage) / 2 AS f FROM genotypes WHERE sample_id IN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 2000) GROUP BY variant_id) USING (variant_id) WHERE f > 0 AND f < 1),
 z AS (SELECT sample_id, (dosage - 2 * f) / sqrt(2 * f * (1 - f)) AS z, w1, w2 FROM genotypes JOIN l USING (variant_id) WHERE dosage IS NOT NULL) SELECT sample_id, count(*) * 2 AS n_alleles, {rs('sum(z * w1) / (2 * count(*))')} AS pc1, {rs('sum(z * w2) / (2 * count(*))')} AS pc2 FROM z GROUP BY sample_id"""))
def _(spark, sf):
    g = roles.genotypes(spark, sf)
    fit = table(spark, sf, "supplier").where("s_acctbal > 2000").select(F.col("s_suppkey").alias("sample_id"))
    freq = A.variant_freq(g, fit).select("variant_id", "freq")
    w = roles.variants(spark, sf).select("variant_id", ((F.col("pos") % 17 - 8) / 10.0).alias("w1"), ((F.col("pos") % 7 - 3) / 10.0).alias("w2")).join(freq, "variant_id")
    return rcols(V.project_pcs(g, w, 2), "pc1", "pc2")


@query("V9_reference_alignment", sql("reference_freq", f"SELECT status, count(*) AS n FROM (SELECT {S_ALIGN} AS status FROM variants v JOIN reference_freq f USING (variant_id)) GROUP BY status"))
def _(spark, sf):
    return V.align_reference(roles.variants(spark, sf), roles.reference_freq(spark, sf)).groupBy("status").agg(F.count(F.lit(1)).alias("n"))


_T = {"bal": "s_acctbal / 1000.0 - 5.0", "nat": "CASE WHEN s_nationkey % 5 <> 0 THEN CAST(s_nationkey AS DOUBLE) - 12 END"}


@query("V10_association", sql("genotypes", " UNION ALL ".join(f"""SELECT variant_id, '{p}' AS pheno_id, n, {rs('sx / (2 * n)')} AS a1freq, {rs('CASE WHEN vx > 1e-9 THEN cxy / vx END', 5)} AS beta, {rs('CASE WHEN n > 2 AND vx > 1e-9 THEN sqrt(greatest(vy - cxy * cxy / vx, 0) / (n - 2) / vx) END', 5)} AS se FROM
 (SELECT variant_id, n, sx, sxx - sx * sx / n AS vx, sxy - sx * sy / n AS cxy, syy - sy * sy / n AS vy FROM (SELECT variant_id, count(*) AS n, sum(g) AS sx, sum(g * g) AS sxx, sum(y) AS sy, sum(y * y) AS syy, sum(g * y) AS sxy
 FROM (SELECT variant_id, CAST(dosage AS DOUBLE) AS g, {e} AS y FROM genotypes JOIN supplier ON sample_id = s_suppkey WHERE dosage IS NOT NULL) WHERE y IS NOT NULL GROUP BY variant_id))""" for p, e in _T.items())))
def _(spark, sf):
    t = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("sample_id"), *[F.expr(e).alias(p) for p, e in _T.items()])
    a = V.associate(roles.genotypes(spark, sf), t, list(_T)).where("n > 0")
    from .registry import r

    return a.select("variant_id", "pheno_id", "n", r("a1freq").alias("a1freq"), r("beta", 5).alias("beta"), r("se", 5).alias("se"))


@query("V10_association_p")
def _(spark, sf):
    t = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("sample_id"), *[F.expr(e).alias(p) for p, e in _T.items()])
    return V.associate(roles.genotypes(spark, sf), t, list(_T), with_p=True)


role("sumstats", """SELECT rsid, chrom, pos, CASE WHEN variant_id % 3 = 0 THEN ref WHEN variant_id % 61 = 0 THEN 'N' ELSE alt END AS allele1, CASE WHEN obs_ct > 0 THEN alt_ct / CAST(obs_ct AS DOUBLE) END AS a1freq, obs_ct AS n, (pos % 201 - 100) / CAST(1000.0 AS DOUBLE) AS beta, CAST(0.01 AS DOUBLE) AS se,
 CASE WHEN variant_id % 50 = 0 THEN CAST(0 AS DOUBLE) ELSE (pos % 997 + 1) / CAST(1000.0 AS DOUBLE) END AS p FROM variants""", "variants")


def sumstats(spark, sf):
    v = roles.variants(spark, sf)
    i = F.col("variant_id")
    return v.select("rsid", "chrom", "pos", F.when(i % 3 == 0, F.col("ref")).when(i % 61 == 0, "N").otherwise(F.col("alt")).alias("allele1"), F.when(F.col("obs_ct") > 0, F.col("alt_ct") / F.col("obs_ct")).alias("a1freq"), F.col("obs_ct").alias("n"),
                    ((F.col("pos") % 201 - 100) / 1000.0).alias("beta"), F.lit(0.01).alias("se"), F.when(i % 50 == 0, F.lit(0.0)).otherwise((F.col("pos") % 997 + 1) / 1000.0).alias("p"))


@query("V11_light_sumstats", sql("sumstats", f"SELECT rsid, chrom, pos, allele1, {rs('a1freq')} AS a1freq, n, {rs('beta')} AS beta, se, {rs('CASE WHEN p > 0 THEN -log10(p) END')} AS log10p FROM sumstats"))
def _(spark, sf):
    return rcols(V.lightweight(sumstats(spark, sf)), "a1freq", "beta", "log10p")


@query("V12_harmonized_sumstats", sql("sumstats", f"""SELECT s.rsid, status, {rs("CASE status WHEN 'same' THEN beta WHEN 'flipped' THEN -beta END")} AS beta FROM (SELECT s.rsid, s.beta, CASE WHEN v.rsid IS NULL THEN 'missing' WHEN s.allele1 = v.alt THEN 'same' WHEN s.allele1 = v.ref THEN 'flipped' ELSE 'mismatch' END AS status
 FROM sumstats s LEFT JOIN (SELECT * FROM variants WHERE alt_ct >= 40) v ON v.rsid = s.rsid) s"""))
def _(spark, sf):
    ref = roles.variants(spark, sf).where("alt_ct >= 40").select("rsid", F.col("alt").alias("allele1"), F.col("ref").alias("allele2"))
    return rcols(V.harmonize_stats(sumstats(spark, sf), ref).select("rsid", "status", "beta"), "beta")


@query("V13_marker_subset", sql("variants", "SELECT variant_id, rsid FROM variants WHERE f_miss < 0.05 AND variant_id IN (SELECT l_partkey FROM lineitem WHERE l_discount > 0.09)"))
def _(spark, sf):
    m = table(spark, sf, "lineitem").where("l_discount > 0.09").select(F.concat(F.lit("rs"), F.col("l_partkey").cast("string")).alias("rsid"))
    return V.marker_subset(m, roles.variants(spark, sf), 0.05).select("variant_id", "rsid")


@query("W10_genome_order", sql("variants", "SELECT rsid, chrom, pos FROM variants"))
def _(spark, sf):
    return X.order_ids(roles.variants(spark, sf).select("rsid", "chrom", "pos"), "rsid")
