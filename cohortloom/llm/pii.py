"""Personal data: fixed patterns seed a bootstrapped extraction by context, in DataFrame operations only.

Seeds are the e-mail addresses, IP addresses, card and phone numbers that the fixed patterns find. The two words before an identifier
are its lexical pattern. Patterns and instances form a graph of counted edges: a pattern's confidence in a kind is the smoothed share of its
edges that lead to instances believed to be of that kind, an instance is believed as far as its confident patterns agree (noisy or), and
the two are computed in turn until no further instance is accepted. Identifier-like tokens that no fixed pattern knows become spans
once they are accepted, and at once if they are a seed written otherwise. Fixed spans always stay.

Only documents with a digit or an @ go on; they are written once, with a row number, and only gaps and matches leave them: start and end
come from running sums of lengths, so that a text with many matches costs in proportion. Matches never cross lines.

Defined cases: a null text is empty; documents without spans get zero counts and the digest of the empty string; repeated and null ids
are told apart by row number; contexts reach back at most 80 characters, over earlier matches too, and may be empty (then they are no pattern); an empty table gives
an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut
from .common import LOWER, UPPER, whole

KINDS = ("email", "ip", "card", "phone")
#: The fixed patterns. An address may start at the head of a run of its characters or right after the previous address, nowhere else
#: can it match; possessive repeats keep long runs linear. Cards are found as runs of digits and separators that are then cut at doubled ones.
_LOCAL = r"[A-Za-z0-9._%+-]"
PATTERNS = {
    "email": rf"(?:(?<!{_LOCAL})|\G){_LOCAL}++@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+",
    "card": r"[0-9][0-9\x20-]*[0-9]",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: Tokens that may be identifiers without matching a fixed pattern: five digits or more, or an @.
CANDIDATE = r"[A-Za-z0-9._%+()@/:-]*[0-9@][A-Za-z0-9._%+()@/:-]*"


def find(rows: DataFrame, keys: list[str], text: str, pattern: str, pieces: bool = False) -> DataFrame:
    """keys, start, end, match, left (up to 80 characters before): leftmost non-overlapping matches, or the pieces between them."""
    zipped = F.arrays_zip(F.split(text, pattern, -1).alias("gap"), F.regexp_extract_all(F.col(text), F.lit(pattern), F.lit(0)).alias("match"))
    last = lambda c: F.substring(c, -80, 80)

    def left(z, i):
        # a gap and a match have two characters or more together (only the first gap and addresses, themselves longer, have none before): 41 of them reach back 80
        own = F.lit("") if pieces else z["gap"]
        earlier = F.transform(F.slice("z", F.greatest(i - 40, F.lit(1)), F.least(i, F.lit(41))), lambda y: last(F.concat(y["gap"], F.coalesce(y["match"], F.lit("")))))
        return F.when((F.length(own) >= 80) | (i == 0), last(own)).otherwise(last(F.concat(F.array_join(earlier, ""), own)))

    # outer: an inner one would add a filter that searches the text again
    each = rows.select(*keys, zipped.alias("z")).select(*keys, "z", F.transform("z", left).alias("lefts"))
    each = each.select(*keys, F.posexplode_outer(F.arrays_zip("z", "lefts")).alias("i", "y"))
    gap, match = F.col("y.z.gap"), F.coalesce("y.z.match", F.lit(""))
    each = each.select(*keys, "i", F.length(gap).alias("gap_len"), F.length(match).alias("match_len"), (gap if pieces else F.col("y.z.match")).alias("match"), F.col("y.lefts").alias("left"))
    done = F.sum(F.col("gap_len") + F.col("match_len")).over(Window.partitionBy(*keys).orderBy("i").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    end = done - (F.col("match_len") if pieces else F.lit(0))
    size = F.col("gap_len" if pieces else "match_len")
    return each.select(*keys, (end - size).cast("long").alias("start"), end.cast("long").alias("end"), "match", "left").where("match IS NOT NULL AND match <> ''")


def _digits(c) -> Column:
    return F.regexp_replace(c, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Every second digit from the right doubled, its digits summed."""
    def add(total, i):
        d = F.substr(digits, F.length(digits) - i, F.lit(1)).cast("int")
        twice = F.when(d > 4, 2 * d - 9).otherwise(2 * d)
        return total + F.when(i % 2 == 1, twice).otherwise(d)

    return F.aggregate(F.sequence(F.lit(0), F.length(digits) - 1), F.lit(0), add) % 10 == 0


def _small(part: Column) -> Column:
    bare = F.regexp_replace(part, "^0+", "")
    return (F.length(bare) <= 3) & (F.coalesce(F.substring(bare, 1, 3).try_cast("int"), F.lit(0)) <= 255)


def base_spans(texts: DataFrame) -> DataFrame:
    """row_id, kind, start, end, match, left of the fixed patterns; matches that fail their check are dropped."""
    has = lambda kind, test: find(texts.where(test), ["row_id"], "text", PATTERNS[kind]).withColumn("kind", F.lit(kind))
    out = ["row_id", "kind", "start", "end", "match", "left"]
    email = has("email", F.col("text").contains("@"))
    part = F.split("match", r"\.")
    ip = has("ip", F.regexp_like("text", F.lit(r"[0-9]\.[0-9]+\.[0-9]"))).where(_small(part[0]) & _small(part[1]) & _small(part[2]) & _small(part[3]))
    runs = has("card", F.regexp_like("text", F.lit(r"[0-9]"))).where(F.length(_digits("match")) >= 12)
    runs = runs.select("row_id", F.col("start").alias("from"), "match", F.col("left").alias("before"))
    card = find(runs, ["row_id", "from", "before"], "match", r"[\x20-]{2,}", pieces=True)
    digits = _digits("match")
    card = card.withColumn("d", digits).where(F.length("d").between(12, 19)).where(_luhn(F.col("d")))
    card = card.select("row_id", F.lit("card").alias("kind"), (F.col("from") + F.col("start")).alias("start"), (F.col("from") + F.col("end")).alias("end"), "match", F.substring(F.concat("before", "left"), -80, 80).alias("left"))
    phone = has("phone", F.regexp_like("text", F.lit(r"\+[0-9]"))).where(F.length(digits).between(9, 15))
    return email.select(out).unionByName(ip.select(out)).unionByName(card.select(out)).unionByName(phone.select(out))


def _context(left: Column) -> Column:
    """The two words before, lower-cased, null where there are fewer."""
    low = F.translate(left, UPPER, LOWER)
    return F.when(F.regexp_like(low, F.lit(r"[^\s]+\s+[^\s]+[\s(\"']*$")), F.regexp_extract(low, r"([^\s]+\s+[^\s]+?)[\s(\"']*$", 1))


def _value(match: Column, kind: Column | None = None) -> Column:
    """What is equal in all spellings of an identifier; signs within addresses of both kinds belong to them."""
    low = F.translate(match, UPPER, LOWER)
    signs = match.contains("@") if kind is None else kind.isin("email", "ip")
    return F.when(signs, low).otherwise(F.regexp_replace(low, r"[\s().+-]", ""))


def candidates(texts: DataFrame, base: DataFrame) -> DataFrame:
    """Identifier-like tokens that touch no fixed span: row_id, start, end, match, left."""
    tokens = find(texts, ["row_id"], "text", CANDIDATE)
    keep = (F.length(_digits("match")) >= 5) | F.col("match").contains("@")
    tokens = tokens.where(keep).select("row_id", "start", "end", "match", "left", F.lit(False).alias("fixed"))
    both = tokens.unionByName(base.select("row_id", "start", "end", F.lit("").alias("match"), F.lit("").alias("left"), F.lit(True).alias("fixed")))
    w = Window.partitionBy("row_id").orderBy("start", F.desc("fixed"))
    reached = F.max(F.when(F.col("fixed"), F.col("end"))).over(w.rowsBetween(Window.unboundedPreceding, -1))
    coming = F.min(F.when(F.col("fixed"), F.col("start"))).over(w.rowsBetween(1, Window.unboundedFollowing))
    free = both.withColumn("reached", reached).withColumn("coming", coming).where("not fixed and coalesce(reached <= start, true) and coalesce(coming >= end, true)")
    return free.select("row_id", "start", "end", "match", "left")


def bootstrap(edges: DataFrame, min_support: int, confident: float, accept: float) -> DataFrame:
    """Accepted unseen instances: value, kind.

    edges: pattern, value, kind (null where unknown), n. A round scores patterns by the instances believed so far, then instances by their
    patterns; it ends when no instance is newly accepted, and accepted ones stay, so the rounds are finite.
    """
    believed = cut(edges.where("kind is not null").select("value", "kind").distinct())
    unknown = cut(edges.where("kind is null").select("pattern", "value").distinct().join(believed.select("value").distinct(), "value", "left_anti"))
    total = cut(edges.groupBy("pattern").agg(F.sum("n").alias("all"), F.countDistinct("value").alias("values")).where(F.col("values") > 1))
    flat = cut(edges.groupBy("pattern", "value").agg(F.sum("n").alias("n")).join(total.select("pattern"), "pattern", "left_semi"))
    found = None
    while True:
        votes = flat.join(believed, "value").groupBy("pattern", "kind").agg(F.sum("n").alias("yes"), F.count(F.lit(1)).alias("support"))
        scored = votes.join(total, "pattern").withColumn("conf", F.col("yes") / (F.col("all") + 1)).where((F.col("support") >= min_support) & (F.col("conf") >= confident))
        belief = unknown.join(scored, "pattern").groupBy("value", "kind").agg((1 - F.exp(F.sum(F.log(1 - F.col("conf"))))).alias("belief"))
        best = belief.where(F.col("belief") >= accept).groupBy("value").agg(F.max(F.struct("belief", "kind")).alias("b")).select("value", "b.kind")
        new = cut(best.join(believed.select("value").distinct(), "value", "left_anti"))
        if new.isEmpty():
            break
        found = new if found is None else found.unionByName(new)
        believed = believed.unionByName(new)
    return found if found is not None else believed.limit(0)


def extract(docs: DataFrame, min_support: int = 3, confident: float = 0.5, accept: float = 0.5) -> tuple[DataFrame, DataFrame]:
    """The documents' rows (row_id, doc_id) and all spans: row_id, kind, start, end, fixed."""
    rows = docs.select("doc_id", F.monotonically_increasing_id().alias("row_id"), F.when(F.regexp_like(whole(), F.lit("[0-9@]")), F.col("text")).alias("text"))
    rows = cut(rows)
    texts = rows.where("text is not null").select("row_id", "text")
    base = cut(base_spans(texts))
    free = cut(candidates(texts, base))
    seeds = base.select(_context(F.col("left")).alias("pattern"), _value(F.col("match"), F.col("kind")).alias("value"), "kind")
    seen = seeds.unionByName(
        free.select(_context(F.col("left")).alias("pattern"), _value(F.col("match")).alias("value"), F.lit(None).cast("string").alias("kind")))
    edges = cut(seen.where("pattern is not null").groupBy("pattern", "value", "kind").agg(F.count(F.lit(1)).alias("n")))
    found = bootstrap(edges, min_support, confident, accept)
    # seeds that also occur in other spellings, under the kind that they have most often
    votes = seeds.groupBy("value", "kind").agg(F.count(F.lit(1)).alias("n"))
    known = votes.groupBy("value").agg(F.max(F.struct("n", "kind")).alias("b")).select("value", "b.kind")
    found = known.unionByName(found.join(known.select("value"), "value", "left_anti").select("value", "kind"))
    more = free.withColumn("value", _value(F.col("match"))).join(found, "value").select("row_id", "kind", "start", "end", F.lit(False).alias("fixed"))
    return rows.select("row_id", "doc_id"), base.select("row_id", "kind", "start", "end", F.lit(True).alias("fixed")).unionByName(more)


def _joined(test: Column | None = None) -> Column:
    """kind:start:end by start, then kind as listed, comma-joined."""
    place = F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind"))
    item = F.struct("start", place.alias("place"), "end", "kind")
    items = F.array_sort(F.collect_list(item if test is None else F.when(test, item)))
    return F.array_join(F.transform(items, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")


def report(docs: DataFrame, **options) -> DataFrame:
    """One row per document: doc_id, n_email, n_ip, n_card, n_phone (fixed spans), base (their list), spans (the list of all)."""
    rows, spans = extract(docs, **options)
    counts = [F.count(F.when(F.col("fixed") & (F.col("kind") == k), 1)).alias(f"n_{k}") for k in KINDS]
    per = spans.groupBy("row_id").agg(*counts, _joined(F.col("fixed")).alias("base"), _joined().alias("spans"))
    out = rows.join(per, "row_id", "left")
    zero = [F.coalesce(f"n_{k}", F.lit(0)).cast("long").alias(f"n_{k}") for k in KINDS]
    return out.select("doc_id", *zero, F.coalesce("base", F.lit("")).alias("base"), F.coalesce("spans", F.lit("")).alias("spans"))
