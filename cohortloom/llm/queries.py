"""Registered queries of the corpus operators. Each takes the whole table and derives the columns asked for from the operator's result."""

from __future__ import annotations

from pyspark.sql import functions as F

from . import centroids, decontaminate, fingerprints, licenses, lm, mixing, ngram_join, pii, quality, records, repair, sharding, suffix_dedup
from .common import LOWER, ORACLES, QUERIES, UPPER, query, table  # noqa: F401


@query("op1_sharding")
def op1(spark, sf_dir):
    placed = sharding.assign(table(spark, sf_dir, "documents"), shards=8)
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


@query("op2_suffix_dedup")
def op2(spark, sf_dir):
    clean = suffix_dedup.deduplicate(table(spark, sf_dir, "documents"), size=400)
    return clean.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@query("op3_token_records")
def op3(spark, sf_dir):
    import public_tokenizers  # here only: its path is a parameter of the operator

    return records.round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), end_id=2).select("doc_id", "start", "n_tokens", "ids_crc32")


@query("op4_pii")
def op4(spark, sf_dir):
    found = pii.report(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_email", "n_ip", "n_card", "n_phone", F.sha2(F.col("base").cast("binary"), 256).alias("base_sha256"), "spans")


@query("op6_ngram_join")
def op6(spark, sf_dir):
    return ngram_join.classes(table(spark, sf_dir, "documents"))


def _values(rows) -> str:
    return ", ".join("({})".format(", ".join("'{}'".format(x.replace("'", "''")) for x in r)) for r in rows)


FULL_TEXTS = [(k, v) for k, v in licenses.TEXTS.items() if k != "AGPL-3.0"]
LICENSE_SQL = rf"""
WITH f AS (SELECT doc_id, coalesce(text, '') AS text, coalesce(source, '') || '/' || coalesce(lang, '') AS dir FROM documents),
t AS (SELECT text, translate(text, '{UPPER}', '{LOWER}') AS low, len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS words FROM (SELECT DISTINCT text FROM f) WHERE regexp_matches(translate(text, '{UPPER}', '{LOWER}'), '{licenses.SPEAKS}')),
a AS (SELECT text, words, unnest(string_split(text, chr(10))) AS line FROM t),
l AS (SELECT DISTINCT * FROM a WHERE regexp_matches(translate(line, '{UPPER}', '{LOWER}'), '{licenses.SPEAKS}')),
tf AS (SELECT text, term, count(*) AS tf FROM (SELECT text, unnest(regexp_extract_all(translate(line, '{UPPER}', '{LOWER}'), '{licenses.TERM}')) AS term FROM l) GROUP BY ALL),
n AS (SELECT count(DISTINCT text) AS n FROM tf),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
x0 AS (SELECT * FROM (VALUES {_values(FULL_TEXTS)}) v(license, body)),
x AS (SELECT license, translate(body, '{UPPER}', '{LOWER}') AS body FROM (
  FROM x0 UNION ALL SELECT 'AGPL-3.0', replace(replace(body, 'GNU General Public', 'GNU Affero General Public'), 'GNU GENERAL PUBLIC', 'GNU AFFERO GENERAL PUBLIC') FROM x0 WHERE license = 'GPL-3.0')),
forms AS (SELECT row_number() OVER () AS form, * FROM (
  SELECT license, line, NULL::VARCHAR[] AS needs FROM (VALUES {_values(licenses.TEMPLATES.items())}) v(license, line)
  UNION ALL SELECT license, string_agg(line, chr(10)), NULL FROM (SELECT license, unnest(string_split(body, chr(10))) AS line FROM x) WHERE regexp_matches(line, '{licenses.SPEAKS}') GROUP BY license
  UNION ALL SELECT license, replace(phrase, '{{}}', name), list_filter(list_distinct(regexp_extract_all(lower(name), '{licenses.TERM}')), lambda c: c NOT IN ('license', 'version', 'international', 'the'))
    FROM (VALUES {_values([(k, n) for k, ns in licenses.NAMES.items() for n in ns])}) v(license, name), (VALUES {_values([(p,) for p in licenses.PHRASES])}) w(phrase))),
m AS (SELECT form, m0.term, tf * (ln((1.0 + n) / (1 + coalesce(df, 0))) + 1) AS w FROM (
  SELECT form, term, count(*) AS tf FROM (SELECT form, unnest(regexp_extract_all(translate(line, '{UPPER}', '{LOWER}'), '{licenses.TERM}')) AS term FROM forms) GROUP BY ALL) m0 LEFT JOIN df ON m0.term = df.term, n),
asked AS (SELECT form, unnest(needs) AS term FROM forms WHERE needs IS NOT NULL),
ma AS (SELECT m.form, m.term, m.w, CASE WHEN asked.term IS NULL THEN 0 ELSE 1 END AS asked FROM m LEFT JOIN asked ON m.form = asked.form AND m.term = asked.term),
about AS (SELECT form, license, len(needs) AS needed, needs IS NOT NULL AS short, norm AS other FROM forms JOIN (SELECT form, sqrt(sum(w * w)) AS norm FROM m GROUP BY form) USING (form)),
single AS (SELECT line, term, count(*) AS tf FROM (SELECT line, unnest(regexp_extract_all(translate(line, '{UPPER}', '{LOWER}'), '{licenses.TERM}')) AS term FROM (SELECT DISTINCT line FROM l)) GROUP BY ALL),
w AS (SELECT k, whole, u.term, tf * (ln((1.0 + n) / (1 + coalesce(df, 0))) + 1) AS w FROM (SELECT text AS k, true AS whole, term, tf FROM tf UNION ALL SELECT line, false, term, tf FROM single) u LEFT JOIN df ON u.term = df.term, n),
dots AS (SELECT k, whole, form, sum(w.w * ma.w) AS dot, sum(asked) AS there FROM w JOIN ma ON w.term = ma.term GROUP BY ALL),
fits AS (SELECT k, d.whole, license, round(dot / norm / other, 6) AS score FROM dots d JOIN about USING (form) JOIN (SELECT k, whole, sqrt(sum(w * w)) AS norm FROM w GROUP BY ALL) z USING (k, whole)
  WHERE (whole OR short) AND (NOT short OR there = needed)),
runs AS (SELECT k, r, count(*) AS n FROM (
  SELECT k, unnest(list_transform(range(1, greatest(len(t) - 1, 1)), lambda i: t[i] || ' ' || t[i + 1] || ' ' || t[i + 2])) AS r FROM (
    SELECT text AS k, regexp_extract_all(low, '{licenses.TERM}') AS t FROM t UNION ALL SELECT chr(1) || license, regexp_extract_all(body, '{licenses.TERM}') FROM x)) GROUP BY ALL),
lengths AS (SELECT k, sqrt(sum(n * n)) AS norm FROM runs GROUP BY k),
complete AS (SELECT b.k AS text, substr(a.k, 2) AS license, round(sum(a.n * b.n) / any_value(x.norm) / any_value(y.norm), 6) AS score
  FROM runs a JOIN runs b ON a.r = b.r AND starts_with(a.k, chr(1)) AND NOT starts_with(b.k, chr(1)) JOIN lengths x ON x.k = b.k JOIN lengths y ON y.k = a.k GROUP BY b.k, a.k),
every AS (SELECT k AS text, license, score FROM fits WHERE whole UNION ALL SELECT l.text, license, score FROM fits JOIN l ON fits.k = l.line WHERE NOT whole UNION ALL FROM complete),
b AS (SELECT text, license, score FROM every WHERE score >= 0.5 QUALIFY row_number() OVER (PARTITION BY text ORDER BY score DESC, license) = 1),
h AS (SELECT text, 2 * sum(len(regexp_extract_all(line, '[^\x20\x09-\x0D]+'))) >= max(words) OR text IN (SELECT text FROM complete WHERE score >= 0.5) AS whole_file FROM l GROUP BY text),
p AS (SELECT f.doc_id, f.dir, b.license, b.score, h.whole_file FROM f LEFT JOIN b ON f.text = b.text LEFT JOIN h ON b.text = h.text),
g AS (SELECT dir, license, score FROM p WHERE whole_file AND license IS NOT NULL QUALIFY row_number() OVER (PARTITION BY dir ORDER BY score DESC, license) = 1),
i AS (SELECT p.dir, g.dir AS above, g.license, g.score FROM (SELECT DISTINCT dir FROM p) p JOIN g ON g.dir = p.dir OR g.dir = split_part(p.dir, '/', 1) OR g.dir = ''
      QUALIFY row_number() OVER (PARTITION BY p.dir ORDER BY length(g.dir) DESC) = 1)
SELECT p.doc_id, coalesce(p.license, i.license) AS license, coalesce(p.score, i.score) AS score,
       CASE WHEN p.license IS NOT NULL AND p.whole_file THEN 'file' WHEN p.license IS NOT NULL THEN 'header' WHEN i.above IS NOT NULL THEN 'inherited' END AS origin,
       CASE WHEN p.license IS NULL THEN i.above END AS inherited_from
FROM p LEFT JOIN i ON p.dir = i.dir
"""


@query("op5_license_scan", LICENSE_SQL)
def op5(spark, sf_dir):
    """Documents as files: the directory is source/language, the name the id."""
    d = table(spark, sf_dir, "documents")
    none = F.lit("")
    files = d.select(F.concat_ws("/", F.coalesce("source", none), F.coalesce("lang", none), F.coalesce(F.col("doc_id").cast("string"), none)).alias("path"), "text")
    found = licenses.scan(files)
    return found.select(F.regexp_extract("path", "([^/]*)$", 1).try_cast("long").alias("doc_id"), "license", "score", "origin", "inherited_from")


@query("op7_lm_scoring")
def op7(spark, sf_dir):
    held = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 5 == 1
    return lm.score(table(spark, sf_dir, "documents"), held)


@query("op8_quality_rules")
def op8(spark, sf_dir):
    return quality.judge(table(spark, sf_dir, "documents")).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


MIX_SQL = r"""
WITH d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
         md5('9:' || coalesce(CAST(doc_id AS VARCHAR), '') || ':' || md5(coalesce(text, ''))) AS k FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, [3.0, 1.0, 2.0][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3]::DOUBLE AS w FROM d GROUP BY source),
r AS (SELECT *, 2.0 * source_size AS cap, row_number() OVER (ORDER BY 2.0 * source_size / w, source NULLS LAST) AS o FROM s),
l AS (SELECT *, (1.5 * sum(source_size) OVER () - coalesce(sum(cap) OVER (ORDER BY o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
             / sum(w) OVER (ORDER BY o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM r),
v AS (SELECT arg_min(level, o) FILTER (WHERE level * w <= cap) AS level FROM l),
t AS (SELECT source, source_size, least(cap, w * level) AS target FROM r, v),
q AS (SELECT d.*, t.source_size, t.target, CASE WHEN t.source_size > 0 THEN floor(t.target / t.source_size) ELSE 0 END AS times,
             sum(size) OVER (PARTITION BY d.source ORDER BY k ROWS UNBOUNDED PRECEDING) - size AS before FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, round(target, 6) AS target,
       CAST(size * (times + CASE WHEN target - times * source_size > 0 AND 2 * before + size <= 2 * (target - times * source_size) THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM q
"""


@query("op9_mixing", MIX_SQL)
def op9(spark, sf_dir):
    mixed = mixing.mix(table(spark, sf_dir, "documents"), share=1.5, epochs=2.0)
    return mixed.select("doc_id", "size", "source_size", F.round("target", 6).alias("target"), "taken")


@query("op10_decontamination")
def op10(spark, sf_dir):
    return decontaminate.hits(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("text_key")


def centroid_sql(k: int = 8, rounds: int = 10) -> str:
    """The rounds written out: a (vectors with their cluster and distance) and c (centroids) in turn."""
    steps = [r"""
WITH v AS MATERIALIZED (
  SELECT row_number() OVER () AS row_id, vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64),
s AS (SELECT v, row_number() OVER (ORDER BY sha256('3:' || coalesce(CAST(vec_id AS VARCHAR), ''))) - 1 AS k FROM v)""",
             f"c0 AS MATERIALIZED (SELECT CAST(k AS INTEGER) AS k, v FROM s WHERE k < {k})"]
    for n in range(rounds + 1):
        steps.append(f"""a{n} AS MATERIALIZED (
  SELECT row_id, any_value(vec_id) AS vec_id, any_value(v) AS v, min({{'d': d, 'k': k}}) AS b FROM (
    SELECT row_id, vec_id, v.v, c.k, CAST(list_sum(list_transform(list_zip(v.v, c.v), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS BIGINT) AS d FROM v, c{n} c) GROUP BY row_id)""")
        if n < rounds:
            steps.append(f"""c{n + 1} AS MATERIALIZED (
  SELECT c.k, coalesce(m.v, c.v) AS v FROM c{n} c LEFT JOIN (
    SELECT k, list(CAST((t - ((t % n) + n) % n) // n AS BIGINT) ORDER BY i) AS v FROM (
      SELECT k, i, CAST(sum(x) AS BIGINT) AS t, count(*) AS n FROM (SELECT b.k AS k, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM a{n}) GROUP BY k, i) GROUP BY k) m ON c.k = m.k)""")
    return ",\n".join(steps) + f"""
SELECT vec_id, b.k AS cluster, b.d AS distance, CAST(sum(b.d) OVER (PARTITION BY b.k) AS BIGINT) AS cluster_inertia, CAST(sum(b.d) OVER () AS BIGINT) AS inertia,
       sha256(array_to_string(c.v, ',')) AS centroid_sha256
FROM a{rounds} a JOIN c{rounds} c ON a.b.k = c.k
"""


@query("op11_centroid_clustering", centroid_sql())
def op11(spark, sf_dir):
    return centroids.cluster(table(spark, sf_dir, "embeddings"), "embedding", k=8, rounds=10)


@query("op12_document_fingerprints")
def op12(spark, sf_dir):
    return fingerprints.beside_next(table(spark, sf_dir, "documents"))


@query("op13_conversation_repair")
def op13(spark, sf_dir):
    rows = table(spark, sf_dir, "conversations")
    found = repair.report(repair.damage(rows)).withColumnRenamed("conv_id", "c")
    every = rows.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n")).join(found, F.col("conv_id").eqNullSafe(F.col("c")), "left")
    zero = F.lit(0).cast("long")
    return every.select(
        "conv_id", *(F.coalesce(c, zero).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")),
        F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(repair.SHA_EMPTY)).alias("repaired_sha256"))
