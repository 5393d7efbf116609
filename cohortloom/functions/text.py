"""Text columns: question and answer normalization, identifiers, numeric answers, topics."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import fixed

# White space as in Unicode, spelled so that every regex dialect reads it alike.
SPACE = r"[\t-\r\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
NUMBER = r"\A[-+]?[0-9]+([.][0-9]+)?\z"
FLOAT = r"\A[-+]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][-+]?[0-9]+)?\z"


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


WIDE_SPACES = "\u0085\u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
QUOTES = "\"'‘’“”"


def squeeze(c) -> Column:
    """Collapse white space and trim. Rare wide spaces become plain ones first, so the expression walks an ASCII class only."""
    c = F.coalesce(col(c), F.lit(""))
    plain = F.translate(c, WIDE_SPACES, " " * len(WIDE_SPACES))
    return F.trim(F.regexp_replace(plain, r"[\t-\r\x{1c}-\x{20}]+", " "))


def untag(c) -> Column:
    return F.regexp_replace(F.coalesce(col(c), F.lit("")), "<[^>]+>", " ")


def norm_question(c) -> Column:
    return F.trim(F.lower(squeeze(F.translate(untag(c), QUOTES, ""))), F.lit(" ?."))


def compact_key(c) -> Column:
    return F.regexp_replace(F.lower(F.coalesce(col(c), F.lit(""))), "[^a-z0-9]+", "")


def content_tokens(c, stopwords=fixed.STOPWORDS) -> Column:
    """Distinct content words of a prompt, sorted: short words and stopwords out, a final plural s off."""
    plain = F.lower(F.translate(untag(c), QUOTES, ""))
    words = F.split(F.regexp_replace(plain, "[^a-z0-9]+", " "), " ")
    kept = F.filter(F.array_except(words, F.array(*[F.lit(w) for w in stopwords])), lambda w: F.length(w) > 2)
    single = F.transform(kept, lambda w: F.when(w.endswith("s") & (F.length(w) > 4), F.substring(w, 1, F.length(w) - 1)).otherwise(w))
    return F.array_sort(F.array_distinct(single))


def norm_answer(c) -> Column:
    tail = F.trim(F.element_at(F.split(squeeze(untag(c)), ":"), -1))
    low = F.trim(F.regexp_replace(F.lower(tail), r"[.]+\z", ""))
    return F.replace(F.replace(low, F.lit("dont "), F.lit("don't ")), F.lit("don t "), F.lit("don't "))


def answer_tail(c) -> Column:
    whole = F.regexp_replace(F.coalesce(col(c), F.lit("")), r"\A" + SPACE + r"+|" + SPACE + r"+\z", "")
    at = F.instr(whole, ":")
    tail = F.regexp_replace(F.substring(whole, at + 1, F.length(whole)), r"\A" + SPACE + r"+|" + SPACE + r"+\z", "")
    return F.when((at > 0) & (tail != ""), tail).otherwise(whole)


def answer_norm(c) -> Column:
    return norm_answer(answer_tail(c))


def identifier(c, limit: int, default: str) -> Column:
    """Lower-case identifier of at most `limit` characters, or the default when nothing is left."""
    parts = F.regexp_replace(F.lower(F.coalesce(col(c), F.lit(""))), "[^a-z0-9]+", "_")
    return F.coalesce(F.nullif(F.left(F.trim(parts, F.lit("_")), F.lit(limit)), F.lit("")), F.lit(default))


def slug(c) -> Column:
    return identifier(c, 40, "x")


def sanitize(c) -> Column:
    return identifier(c, 80, "feature")


def is_missing_answer(c, missing=fixed.MISSING_ANSWERS) -> Column:
    """Carries no information, raw or by its tail: both have the same text after the last colon, so one test decides."""
    return norm_answer(c).isin(missing)


def relation_norm(c, relations=tuple(fixed.RELATION_WEIGHTS)) -> Column:
    """Relation named by an answer: its first word before a colon, else what follows the last ' - '."""
    raw = squeeze(c)
    first = F.lower(F.split(F.trim(F.split(raw, ":")[0]), " ")[0])
    tail = answer_tail(c)
    last = F.element_at(F.split(tail, " - "), -1)
    return F.when(raw.contains(":") & first.isin(list(relations)), first).otherwise(norm_answer(last))


def parse_number(c, lo=None, hi=None, integer=False, strict=True) -> Column:
    """A numeric answer or null; strict takes plain decimals only, otherwise any float literal. Bounds are inclusive."""
    text = F.regexp_replace(F.coalesce(col(c), F.lit("")), r"\A" + SPACE + r"+|" + SPACE + r"+\z", "")
    value = F.when(text.rlike(NUMBER if strict else FLOAT), text.cast("double"))
    keep = F.lit(True)
    if lo is not None:
        keep = keep & (value >= F.lit(float(lo)))
    if hi is not None:
        keep = keep & (value <= F.lit(float(hi)))
    if integer:
        keep = keep & (value == F.floor(value))
    return F.when(keep, value)


def parse_range(c) -> Column:
    """Bounds out of a note that says `range [lo, hi]`; both or neither."""
    lo = parse_number(F.regexp_extract(F.coalesce(col(c), F.lit("")), r"range \[([^,]+),[ ]*([^\]]+)\]", 1), strict=False)
    hi = parse_number(F.regexp_extract(F.coalesce(col(c), F.lit("")), r"range \[([^,]+),[ ]*([^\]]+)\]", 2), strict=False)
    both = lo.isNotNull() & hi.isNotNull()
    return F.struct(F.when(both, lo).alias("lo"), F.when(both, hi).alias("hi"))


def text_ordinal(c, exact=None, prefixes=fixed.TEXT_ORDINAL_PREFIXES) -> Column:
    """Ordinal value of a text answer: exact table first, then prefixes in order."""
    exact = fixed.TEXT_ORDINAL if exact is None else exact
    key = answer_norm(c)
    table = F.create_map(*[F.lit(x) for pair in exact.items() for x in pair])
    by_prefix = reduce(lambda acc, p: acc.when(key.startswith(p[0]), F.lit(p[1])), prefixes[1:], F.when(key.startswith(prefixes[0][0]), F.lit(prefixes[0][1])))
    return F.coalesce(F.try_element_at(table, key), by_prefix)


def control_like(c) -> Column:
    key = answer_norm(c)
    return reduce(lambda a, p: a | key.startswith(p), fixed.CONTROL_PREFIXES, key.isin(fixed.CONTROL_ANSWERS))


def tag_topics(c, patterns=fixed.TOPIC_PATTERNS) -> Column:
    """Sorted topic tags whose pattern occurs in the text."""
    low = F.lower(F.coalesce(col(c), F.lit("")))
    return F.array_compact(F.array(*[F.when(low.rlike(p), F.lit(tag)) for p, tag in patterns]))


def suppress(n, largest: int = fixed.SUPPRESS_MAX) -> Column:
    n = col(n)
    return F.when(n.between(1, largest), F.lit(f"<={largest}")).otherwise(n.cast("string"))


def parse_options(c) -> Column:
    """`code=label | code=label` to an array of structs; parts without '=' are dropped."""
    parts = F.filter(F.split(F.coalesce(col(c), F.lit("")), r" \| "), lambda p: F.contains(p, F.lit("=")))
    return F.transform(
        parts,
        lambda p: F.struct(
            F.trim(F.substring_index(p, "=", 1)).alias("code"), F.trim(F.substring(p, F.instr(p, "=") + 1, F.length(p))).alias("label")
        ),
    )


def id_sort_key(c) -> Column:
    """Numeric ids first by value, other ids after them by text."""
    c = col(c).cast("string")
    number = F.when(c.rlike(r"\A[0-9]+\z"), c.try_cast("long"))
    return F.struct(number.isNull().alias("text_id"), F.coalesce(number, F.lit(0)).alias("number"), c.alias("id"))


def presence_pattern(cols, labels) -> Column:
    """Names of the columns that hold a value, joined by '+', or 'none'."""
    seen = F.array_compact(F.array(*[F.when(col(c).isNotNull(), F.lit(name)) for c, name in zip(cols, labels)]))
    return F.when(F.size(seen) > 0, F.array_join(seen, "+")).otherwise(F.lit("none"))
