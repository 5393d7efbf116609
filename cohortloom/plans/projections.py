"""Scalar columns over the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import alleles as A
from ..functions import fixed
from ..functions import numeric as N
from ..functions import text as T
from ..operators import joins as J
from . import roles
from .registry import query, r, rs, table
from .roles import sql

SP = T.SPACE


def q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def in_list(values) -> str:
    return "(" + ", ".join(q(v) for v in values) + ")"


def s_squeeze(e):
    return f"trim(regexp_replace(coalesce({e}, ''), '{SP}+', ' ', 'g'))"


def s_untag(e):
    return f"regexp_replace(coalesce({e}, ''), '<[^>]+>', ' ', 'g')"


def s_norm_question(e):
    bare = f"""regexp_replace({s_untag(e)}, '["''‘’“”]', '', 'g')"""
    return f"trim(lower({s_squeeze(bare)}), ' ?.')"


def s_compact(e):
    return f"regexp_replace(lower(coalesce({e}, '')), '[^a-z0-9]+', '', 'g')"


def s_tokens(e):
    words = f"string_split(regexp_replace({s_norm_question(e)}, '[^a-z0-9]+', ' ', 'g'), ' ')"
    return (
        f"list_sort(list_distinct([CASE WHEN right(w, 1) = 's' AND length(w) > 4 THEN left(w, length(w) - 1) ELSE w END FOR w IN {words} "
        f"IF length(w) > 2 AND w NOT IN {in_list(fixed.STOPWORDS)}]))"
    )


def s_norm_answer(e):
    tail = f"trim(list_last(string_split({s_squeeze(s_untag(e))}, ':')))"
    low = f"trim(regexp_replace(lower({tail}), '[.]+\\z', ''))"
    return f"replace(replace({low}, 'dont ', 'don''t '), 'don t ', 'don''t ')"


def s_strip(e):
    return f"regexp_replace(coalesce({e}, ''), '\\A{SP}+|{SP}+\\z', '', 'g')"


def s_tail(e):
    w = s_strip(e)
    t = s_strip(f"substr({w}, strpos({w}, ':') + 1)")
    return f"CASE WHEN strpos({w}, ':') > 0 AND {t} <> '' THEN {t} ELSE {w} END"


def s_identifier(e, n, d):
    return f"coalesce(nullif(left(trim(regexp_replace(lower(coalesce({e}, '')), '[^a-z0-9]+', '_', 'g'), '_'), {n}), ''), '{d}')"


def s_missing(e):
    m = in_list(fixed.MISSING_ANSWERS)
    return f"({s_norm_answer(e)} IN {m} OR {s_norm_answer(s_tail(e))} IN {m})"


def s_number(e, pattern):
    t = s_strip(e)
    return f"CASE WHEN regexp_matches({t}, '{pattern}') THEN CAST({t} AS DOUBLE) END"


@query("P1_norm_question", f"SELECT doc_id, md5(n) AS norm_md5, length(n) AS n_chars_norm FROM (SELECT doc_id, {s_norm_question('text')} AS n FROM documents)")
def _(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", T.norm_question("text").alias("n"))
    return d.select("doc_id", F.md5("n").alias("norm_md5"), F.length("n").alias("n_chars_norm"))


@query("P2_compact_key", f"SELECT doc_id, md5({s_compact('text')}) AS key_md5 FROM documents")
def _(spark, sf):
    return table(spark, sf, "documents").select("doc_id", F.md5(T.compact_key("text")).alias("key_md5"))


@query("P3_content_tokens", f"SELECT doc_id, len(t) AS n_tokens, md5(array_to_string(t, ' ')) AS tokens_md5 FROM (SELECT doc_id, {s_tokens('text')} AS t FROM documents)")
def _(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", T.content_tokens("text").alias("t"))
    return d.select("doc_id", F.size("t").cast("long").alias("n_tokens"), F.md5(F.array_join("t", " ")).alias("tokens_md5"))


@query("P4_norm_answer", f"SELECT page_id, md5({s_norm_answer('html')}) AS answer_md5 FROM pages")
def _(spark, sf):
    return table(spark, sf, "pages").select("page_id", F.md5(T.norm_answer("html")).alias("answer_md5"))


@query("P5_answer_tail", f"SELECT page_id, md5({s_tail('html')}) AS tail_md5, {s_tail('url')} AS url_tail, md5({s_norm_answer(s_tail('html'))}) AS norm_md5 FROM pages")
def _(spark, sf):
    return table(spark, sf, "pages").select(
        "page_id", F.md5(T.answer_tail("html")).alias("tail_md5"), T.answer_tail("url").alias("url_tail"), F.md5(T.answer_norm("html")).alias("norm_md5")
    )


@query("P6_identifiers", f"SELECT doc_id, {s_identifier('text', 40, 'x')} AS slug, {s_identifier('text', 80, 'feature')} AS feature FROM documents")
def _(spark, sf):
    return table(spark, sf, "documents").select("doc_id", T.slug("text").alias("slug"), T.sanitize("text").alias("feature"))


_ANSWERS = """SELECT event_id, CASE k % 8 WHEN 0 THEN 'PMI: Skip' WHEN 1 THEN 'Frequency: Dont know' WHEN 2 THEN ' Prefer Not To Answer. ' WHEN 3 THEN 'A: b: Unknown'
 WHEN 4 THEN 'Yes: ' WHEN 5 THEN '<b>No</b> answer' WHEN 6 THEN 'Level: ' || k ELSE NULL END AS raw FROM responses"""


def _answers(spark, sf):
    k = F.col("k")
    return roles.responses(spark, sf).select("event_id", "k", "num", (
        F.when(k % 8 == 0, "PMI: Skip").when(k % 8 == 1, "Frequency: Dont know").when(k % 8 == 2, " Prefer Not To Answer. ").when(k % 8 == 3, "A: b: Unknown")
        .when(k % 8 == 4, "Yes: ").when(k % 8 == 5, "<b>No</b> answer").when(k % 8 == 6, F.concat(F.lit("Level: "), k.cast("string")))
    ).alias("raw"))


@query("P7_is_missing", sql("responses", f"SELECT event_id, {s_missing('raw')} AS missing FROM ({_ANSWERS})"))
def _(spark, sf):
    return _answers(spark, sf).select("event_id", T.is_missing_answer("raw").alias("missing"))


_REL = "CASE p_size % 5 WHEN 0 THEN 'Mother: ' || p_name WHEN 1 THEN p_name || ' - Self' WHEN 2 THEN 'Who had ' || p_name || ': Who - Half-Sibling' WHEN 3 THEN p_name || ': Brother.' ELSE 'Sister smith: x - None' END"


@query("P8_relation_label", f"""SELECT p_partkey, CASE WHEN strpos(a, ':') > 0 AND lower(string_split(trim(string_split(a, ':')[1]), ' ')[1]) IN {in_list(fixed.RELATION_WEIGHTS)}
 THEN lower(string_split(trim(string_split(a, ':')[1]), ' ')[1]) ELSE {s_norm_answer(f"list_last(string_split({s_tail('a')}, ' - '))")} END AS relation
 FROM (SELECT p_partkey, {_REL} AS a FROM part)""")
def _(spark, sf):
    return table(spark, sf, "part").select("p_partkey", F.expr(_REL).alias("a")).select("p_partkey", T.relation_norm("a").alias("relation"))


_NUM = "CASE k % 6 WHEN 0 THEN ' 12 ' WHEN 1 THEN '1e2' WHEN 2 THEN 'PMI: Skip' WHEN 3 THEN CAST(k AS VARCHAR) || '.5' WHEN 4 THEN '-' || CAST(k AS VARCHAR) ELSE '.5' END"


@query("P9_parse_number", sql("responses", f"""SELECT event_id, {s_number('a', T.NUMBER)} AS strict, {s_number('a', T.FLOAT)} AS loose,
 CASE WHEN {s_number('a', T.FLOAT)} BETWEEN 0 AND 50 AND {s_number('a', T.FLOAT)} = floor({s_number('a', T.FLOAT)}) THEN {s_number('a', T.FLOAT)} END AS bounded FROM (SELECT event_id, {_NUM} AS a FROM responses)"""))
def _(spark, sf):
    a = roles.responses(spark, sf).select("event_id", F.expr(_NUM.replace("VARCHAR", "STRING")).alias("a"))
    return a.select(
        "event_id", T.parse_number("a").alias("strict"), T.parse_number("a", strict=False).alias("loose"),
        T.parse_number("a", 0, 50, integer=True, strict=False).alias("bounded"),
    )


_NOTE = "CASE p_size % 3 WHEN 0 THEN 'entry; range [' || CAST(p_size AS VARCHAR) || ', ' || CAST(p_size + 10 AS VARCHAR) || '] years' WHEN 1 THEN 'range [low, 5]' ELSE p_name END"


@query("P10_parse_range", f"""SELECT p_partkey, CASE WHEN p_size % 3 = 0 THEN CAST(regexp_extract(n, 'range \\[([^,]+),[ ]*([^\\]]+)\\]', 1) AS DOUBLE) END AS lo,
 CASE WHEN p_size % 3 = 0 THEN CAST(regexp_extract(n, 'range \\[([^,]+),[ ]*([^\\]]+)\\]', 2) AS DOUBLE) END AS hi FROM (SELECT p_partkey, p_size, {_NOTE} AS n FROM part)""")
def _(spark, sf):
    p = table(spark, sf, "part").select("p_partkey", F.expr(_NOTE.replace("VARCHAR", "STRING")).alias("n"))
    return p.select("p_partkey", T.parse_range("n").alias("b")).select("p_partkey", "b.lo", "b.hi")


def _case(e, values):
    return f"CASE {e} " + " ".join(f"WHEN {i} THEN {v}" for i, v in enumerate(values)) + " END"


@query("P11_code_values", f"SELECT c_custkey, CAST({_case('c_nationkey % 9', fixed.EDUCATION_YEARS)} AS DOUBLE) AS years, CAST({_case('c_nationkey % 10', fixed.INCOME_MIDPOINTS)} AS DOUBLE) AS income FROM customer")
def _(spark, sf):
    c = table(spark, sf, "customer").select("c_custkey", (F.col("c_nationkey") % 9).alias("edu"), (F.col("c_nationkey") % 10).alias("inc"))
    years = J.code_table(spark, dict(enumerate(fixed.EDUCATION_YEARS)), "edu", "years")
    income = J.code_table(spark, dict(enumerate(fixed.INCOME_MIDPOINTS)), "inc", "income")
    return J.map_codes(J.map_codes(c, years, "edu"), income, "inc").select("c_custkey", "years", "income")


_ORD = "CASE k % 7 WHEN 0 THEN 'Freq: Never.' WHEN 1 THEN 'Often' WHEN 2 THEN 'Monthly: sometimes' WHEN 3 THEN 'Less than weekly' WHEN 4 THEN 'Daily or more' WHEN 5 THEN 'Excellent' ELSE 'purple' END"


@query("P13_text_ordinal", sql("responses", """SELECT event_id, CAST(CASE k % 7 WHEN 0 THEN 0 WHEN 1 THEN 3 WHEN 2 THEN 2 WHEN 3 THEN 1 WHEN 4 THEN 4 WHEN 5 THEN 5 END AS DOUBLE) AS y FROM responses"""))
def _(spark, sf):
    return roles.responses(spark, sf).select("event_id", F.expr(_ORD).alias("a")).select("event_id", T.text_ordinal("a").alias("y"))


@query("P14_age_at_event", f"SELECT o_orderkey, {rs('''date_diff('day', DATE '1960-02-29' + CAST(o_custkey % 8000 AS INTEGER), CAST(o_orderdate AS DATE)) / 365.25''')} AS age FROM orders")
def _(spark, sf):
    birth = F.date_add(F.lit("1960-02-29").cast("date"), (F.col("o_custkey") % 8000).cast("int"))
    return table(spark, sf, "orders").select("o_orderkey", r(N.age_at("o_orderdate", birth)).alias("age"))


@query("P15_fractional_year", f"""SELECT o_orderkey, {rs('''year(d) + date_diff('day', make_date(year(d), 1, 1), d) / CAST(date_diff('day', make_date(year(d), 1, 1), make_date(year(d) + 1, 1, 1)) AS DOUBLE)''')} AS yob
 FROM (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d FROM orders)""")
def _(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", r(N.fractional_year("o_orderdate")).alias("yob"))


@query("P16_wrap_hour", "SELECT event_id, CAST(CASE WHEN hour(ts) < 12 THEN hour(ts) + 24 ELSE hour(ts) END AS BIGINT) AS hour_wrapped FROM events")
def _(spark, sf):
    return table(spark, sf, "events").select("event_id", N.wrap_hour(F.hour("ts")).cast("long").alias("hour_wrapped"))


@query("P17_months", f"""SELECT l_orderkey, l_linenumber, u AS unit, {rs('''CASE WHEN u = 'years' AND v BETWEEN 1 AND 99 THEN v * 12 WHEN u = 'months' AND v BETWEEN 1 AND 11 THEN v
 WHEN u = 'weeks' AND v BETWEEN 1 AND 51 THEN v / CAST(4.345 AS DOUBLE) END''')} AS months FROM (SELECT l_orderkey, l_linenumber, l_quantity AS v,
 CASE l_returnflag WHEN 'A' THEN 'years' WHEN 'N' THEN 'months' ELSE 'weeks' END AS u FROM lineitem)""")
def _(spark, sf):
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_quantity").alias("v"), F.expr("CASE l_returnflag WHEN 'A' THEN 'years' WHEN 'N' THEN 'months' ELSE 'weeks' END").alias("unit"))
    return li.select("l_orderkey", "l_linenumber", "unit", r(N.to_months("v", "unit")).alias("months"))


def _btw(e, w):
    return f"CASE WHEN {e} BETWEEN {w[0]} AND {w[1]} THEN {e} END"


_W = fixed.WINDOWS


@query("P18_body_measures", f"""SELECT l_orderkey, l_linenumber, {rs(_btw("pp", _W['pulse_pressure']))} AS pulse_pressure, {rs(_btw("mp", _W['mean_pressure']))} AS mean_pressure,
 {rs(_btw("bmi", _W['bmi']))} AS bmi FROM (SELECT l_orderkey, l_linenumber, s - d AS pp, d + (s - d) / 3.0 AS mp, CASE WHEN w BETWEEN 20 AND 400 AND h BETWEEN 100 AND 250 THEN w / ((h / 100.0) * (h / 100.0)) END AS bmi
 FROM (SELECT l_orderkey, l_linenumber, 90 + l_quantity AS s, 40 + l_discount * 500 AS d, 15 + l_extendedprice / 1000.0 AS w, 95 + l_quantity * 3 AS h FROM lineitem))""")
def _(spark, sf):
    li = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", (90 + F.col("l_quantity")).alias("s"), (40 + F.col("l_discount") * 500).alias("d"),
        (15 + F.col("l_extendedprice") / 1000.0).alias("w"), (95 + F.col("l_quantity") * 3).alias("h"),
    )
    return li.select("l_orderkey", "l_linenumber", r(N.pulse_pressure("s", "d")).alias("pulse_pressure"), r(N.mean_pressure("s", "d")).alias("mean_pressure"), r(N.body_mass_index("w", "h")).alias("bmi"))


@query("P19_indicator_transforms", f"""SELECT l_orderkey, l_linenumber, {rs('-v')} AS neg, {rs('CASE WHEN v > 0 THEN -ln(v) END')} AS neg_log, {rs('ln(v + 0.001)')} AS log_eps,
 {rs('ln(least(greatest(v, 0.001), 0.999) / (1.0 - least(greatest(v, 0.001), 0.999)))')} AS logit, {rs('ln(1 + v)')} AS log1p, {rs('v / 100.0')} AS percent
 FROM (SELECT l_orderkey, l_linenumber, l_discount AS v FROM lineitem)""")
def _(spark, sf):
    li = table(spark, sf, "lineitem")
    return li.select("l_orderkey", "l_linenumber", *[r(N.transform_indicator("l_discount", k)).alias(k) for k in ("neg", "neg_log", "log_eps", "logit", "log1p", "percent")])


@query("P20_right_trim", """SELECT p_partkey, left(a, length(a) - k) AS ref, left(b, length(b) - k) AS alt, CAST(k AS BIGINT) AS trimmed FROM (SELECT *,
 CAST(coalesce(len([i FOR i IN range(1, least(length(a), length(b))) IF right(a, i) = right(b, i)]), 0) AS INTEGER) AS k
 FROM (SELECT p_partkey, upper(p_name) AS a, upper(CASE WHEN p_size % 3 = 0 THEN substr(p_name, 3) WHEN p_size % 3 = 1 THEN p_name || 'g' ELSE p_name END) AS b FROM part))""")
def _(spark, sf):
    p = table(spark, sf, "part").select("p_partkey", F.upper("p_name").alias("a"), F.expr("upper(CASE WHEN p_size % 3 = 0 THEN substr(p_name, 3) WHEN p_size % 3 = 1 THEN p_name || 'g' ELSE p_name END)").alias("b"))
    return p.select("p_partkey", A.right_trim("a", "b").alias("t")).select("p_partkey", "t.ref", "t.alt", F.col("t.trimmed").cast("long").alias("trimmed"))


S_ALIGN = """CASE WHEN v.alt = translate(v.ref, 'ACGT', 'TGCA') THEN 'strand_ambiguous' WHEN v.alt = f.a1 AND v.ref = f.a2 THEN 'same' WHEN v.alt = f.a2 AND v.ref = f.a1 THEN 'swapped'
 WHEN v.alt = translate(f.a1, 'ACGT', 'TGCA') AND v.ref = translate(f.a2, 'ACGT', 'TGCA') THEN 'strand_flip'
 WHEN v.alt = translate(f.a2, 'ACGT', 'TGCA') AND v.ref = translate(f.a1, 'ACGT', 'TGCA') THEN 'swapped_strand_flip' ELSE 'allele_mismatch' END"""


@query("P21_allele_alignment", sql("reference_freq", f"""SELECT variant_id, status, {rs("CASE WHEN status IN ('same', 'strand_flip') THEN f WHEN status IN ('swapped', 'swapped_strand_flip') THEN 1 - f END")} AS freq
 FROM (SELECT v.variant_id, f.a1_freq AS f, {S_ALIGN} AS status FROM variants v JOIN reference_freq f USING (variant_id))"""))
def _(spark, sf):
    v = roles.variants(spark, sf).join(roles.reference_freq(spark, sf).select("variant_id", "a1", "a2", "a1_freq"), "variant_id")
    v = v.withColumn("status", A.align_alleles("alt", "ref", "a1", "a2"))
    return v.select("variant_id", "status", r(A.aligned_freqs("status", F.array("a1_freq"))[0]).alias("freq"))


@query("P22_alt_frequency", sql("reference_freq", f"SELECT variant_id, {rs('CASE WHEN f.a1 = v.alt AND f.a2 = v.ref THEN f.a1_freq WHEN f.a1 = v.ref AND f.a2 = v.alt THEN 1 - f.a1_freq END')} AS alt_freq FROM variants v LEFT JOIN reference_freq f USING (variant_id)"))
def _(spark, sf):
    v = roles.variants(spark, sf).join(roles.reference_freq(spark, sf).select("variant_id", "a1", "a2", "a1_freq"), "variant_id", "left")
    return v.select("variant_id", r(A.alt_freq("a1", "a2", "ref", "alt", "a1_freq")).alias("alt_freq"))


@query("P23_allele_stats", sql("variants", f"""SELECT variant_id, {rs('CASE WHEN obs_ct > 0 THEN alt_ct / CAST(obs_ct AS DOUBLE) END')} AS alt_freq, {rs('CASE WHEN obs_ct > 0 THEN least(alt_ct / CAST(obs_ct AS DOUBLE), 1 - alt_ct / CAST(obs_ct AS DOUBLE)) END')} AS maf,
 CASE WHEN obs_ct > 0 THEN least(alt_ct, obs_ct - alt_ct) END AS mac FROM variants"""))
def _(spark, sf):
    v = roles.variants(spark, sf).withColumn("f", A.frequency("alt_ct", "obs_ct"))
    return v.select("variant_id", r("f").alias("alt_freq"), r(A.minor_frequency("f")).alias("maf"), A.minor_count("alt_ct", "obs_ct").alias("mac"))


@query("P24_class_predicate", "SELECT l_orderkey, l_linenumber, (l_discount >= 0.05 AND l_tax <= 0.04 AND l_quantity / 100.0 <= 0.3) AS in_class FROM lineitem")
def _(spark, sf):
    li = table(spark, sf, "lineitem").withColumn("q", F.col("l_quantity") / 100.0)
    return li.select("l_orderkey", "l_linenumber", J.in_class({"l_discount": (0.05, None), "l_tax": (None, 0.04), "q": (None, 0.3)}).alias("in_class"))


@query("P25_suppression", "SELECT o_custkey, CASE WHEN n BETWEEN 1 AND 20 THEN '<=20' ELSE CAST(n AS VARCHAR) END AS shown FROM (SELECT o_custkey, count(*) * 2 AS n FROM orders GROUP BY o_custkey)")
def _(spark, sf):
    n = table(spark, sf, "orders").groupBy("o_custkey").agg((F.count(F.lit(1)) * 2).alias("n"))
    return n.select("o_custkey", T.suppress("n").alias("shown"))


_TAGS = "list_filter([" + ", ".join(f"CASE WHEN regexp_matches(lower(text), {q(p)}) THEN '{t}' END" for p, t in fixed.TOPIC_PATTERNS) + "], lambda x: x IS NOT NULL)"


@query("P26_topic_tags", f"SELECT doc_id, array_to_string({_TAGS}, ';') AS topics FROM documents")
def _(spark, sf):
    return table(spark, sf, "documents").select("doc_id", F.array_join(T.tag_topics("text"), ";").alias("topics"))


@query("P27_leakage_report", "SELECT p_partkey, p_name, regexp_matches(p_name, '(?i)red|ring') AS denied, p_size > 40 AS allowed, (regexp_matches(p_name, '(?i)red|ring') AND NOT p_size > 40) AS violation FROM part")
def _(spark, sf):
    p = table(spark, sf, "part")
    allow = p.where("p_size > 40").select("p_partkey")
    return J.leakage_report(p.select("p_partkey", "p_name"), "p_partkey", "p_name", "red|ring", allow)


@query("P28_neg_log10", f"SELECT l_orderkey, l_linenumber, {rs('CASE WHEN l_discount > 0 THEN -log10(l_discount) END')} AS log10p FROM lineitem")
def _(spark, sf):
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", r(N.neg_log10("l_discount")).alias("log10p"))


@query("P29_presence_pattern", """SELECT l_orderkey, l_linenumber, coalesce(nullif(array_to_string(list_filter([CASE WHEN l_discount > 0.02 THEN 'a' END, CASE WHEN l_tax > 0.02 THEN 'b' END,
 CASE WHEN l_quantity > 10 THEN 'c' END], lambda x: x IS NOT NULL), '+'), ''), 'none') AS pattern FROM lineitem""")
def _(spark, sf):
    a, b, c = F.when(F.col("l_discount") > 0.02, 1), F.when(F.col("l_tax") > 0.02, 1), F.when(F.col("l_quantity") > 10, 1)
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", T.presence_pattern([a, b, c], ["a", "b", "c"]).alias("pattern"))


@query("P30_id_sort_key", "SELECT url, NOT regexp_matches(tail, '\\A[0-9]+\\z') AS text_id, coalesce(TRY_CAST(CASE WHEN regexp_matches(tail, '\\A[0-9]+\\z') THEN tail END AS BIGINT), 0) AS number FROM (SELECT url, list_last(string_split(url, '/')) AS tail FROM pages)")
def _(spark, sf):
    p = table(spark, sf, "pages").select("url", F.element_at(F.split("url", "/"), -1).alias("tail"))
    return p.select("url", T.id_sort_key("tail").alias("k")).select("url", "k.text_id", "k.number")
