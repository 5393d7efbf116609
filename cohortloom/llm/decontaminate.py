"""Benchmark decontamination by spaced seeds, in DataFrame operations only.

Seven fixed masks of five words within at most eight are hashed from every word of a document on, and of the benchmark likewise. Every
pattern of up to two substituted words in eight and of up to three in twelve leaves some mask whole, wherever they stand. With that, no stretch
that the comparison accepts is missed at `agree` of 3/4 or more and `stretch` of eight or more: a quarter of any longer stretch
leaves eight of its words in a row with two at most, or twelve with three. Equal hashes give a diagonal (document position minus benchmark position). Along the diagonal the two texts are compared word by
word, and the document is contaminated if some stretch of `stretch` words (or the whole passage if it is shorter) agrees in at
least `agree` of its words: substituted words are tolerated, inside and outside of the masks.

The masks' words are generated inside generated code and looked up in the benchmark's hashes: the hashes are broadcast only while their
counted number stays under `broadcast_rows`, else the same join shuffles. Matches travel with the few aligned words, so that texts are
neither shuffled nor read again.

Defined cases: null texts and texts or passages under eight words have no runs and match nothing; words are lower-cased runs of
letters and digits, so that case and punctuation do not hide a passage; passages equal in words count once, under the least item_id;
documents are told apart by id and text, so that null or repeated ids do no harm; empty tables give empty results; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut, spent
from .common import having, text_key, whole

#: Words that count, from the first on.
MASKS = ((0, 1, 3, 4, 5), (0, 1, 2, 3, 6), (0, 1, 5, 6, 7), (0, 1, 2, 3, 5), (0, 3, 4, 6, 7), (0, 2, 4, 5, 6), (0, 1, 2, 4, 7))
SPAN = 8


def words(text):
    return F.regexp_extract_all(F.lower(text), F.lit(r"[\p{L}\p{N}]+"), 0)


def runs(df: DataFrame, keep: list[str]) -> DataFrame:
    """keep, words, pos, h: one row per word and mask that ends within the text; h is null where it does not."""
    starts = F.when(F.size("words") >= SPAN, F.sequence(F.lit(0), F.size("words") - min(m[-1] + 1 for m in MASKS)))
    at = df.select(*keep, "words", F.explode_outer(starts).alias("pos"))  # outer: an inner one would add a filter that cuts the words again
    hashed = F.array(*[F.when(F.col("pos") + mask[-1] < F.size("words"), F.xxhash64(F.lit(k), *[F.get("words", F.col("pos") + i) for i in mask])) for k, mask in enumerate(MASKS)])
    return at.select(*keep, "words", "pos", F.explode_outer(hashed).alias("h"))


def passages(benchmark: DataFrame) -> DataFrame:
    items = benchmark.select("item_id", words(whole()).alias("words")).where(F.size("words") >= SPAN)
    return items.groupBy("words").agg(F.min("item_id").alias("item_id"))


def hits(docs: DataFrame, benchmark: DataFrame, stretch: int = 13, agree: float = 0.75, broadcast_rows: int = 2_000_000) -> DataFrame:
    """Contaminated documents: doc_id, text_key, item_id, position of the first aligned word, words aligned, words equal, most equal words in a stretch."""
    items = cut(passages(benchmark))
    seeds = cut(runs(items, ["item_id"]).where("h is not null").select("h", "item_id", F.col("pos").alias("item_pos"), F.size("words").alias("item_len")))
    if seeds.count() <= broadcast_rows:
        seeds = F.broadcast(seeds)
    d = docs.select("doc_id", text_key().alias("text_key"), words(whole()).alias("words"))
    found = runs(d, ["doc_id", "text_key"]).join(seeds, "h")
    diagonal = F.col("pos") - F.col("item_pos")
    # the document's words from the diagonal's first to last; skip: words of the passage before the document begins
    near = found.select("doc_id", "text_key", "item_id", diagonal.alias("diagonal"), F.slice("words", F.greatest(diagonal, F.lit(0)) + 1, F.col("item_len") + F.least(diagonal, F.lit(0))).alias("part"))
    near = near.distinct().join(items.withColumnRenamed("words", "item_words"), "item_id")
    skip = F.greatest(-F.col("diagonal"), F.lit(0))
    same = F.transform("part", lambda w, i: (w == F.get("item_words", i + skip)).cast("int"))
    near = near.select("doc_id", "text_key", "item_id", F.greatest("diagonal", F.lit(0)).alias("start"), same.alias("same"), F.least(F.lit(stretch), F.size("item_words")).alias("need"))
    sums = F.transform(F.sequence(F.lit(0), F.size("same") - F.col("need")), lambda i: F.aggregate(F.slice("same", i + 1, F.col("need")), F.lit(0), lambda a, x: a + x))
    best = F.when(F.size("same") >= F.col("need"), F.array_max(sums))
    near = near.withColumn("best", best).where(F.col("best") >= agree * F.col("need"))
    equal = F.aggregate("same", F.lit(0), lambda a, x: a + x)
    top = F.max(F.struct("best", equal.alias("equal"), (-F.col("start")).alias("s"), F.size("same").alias("aligned")))
    out = near.groupBy("doc_id", "text_key", "item_id").agg(top.alias("t"))
    return out.select("doc_id", "text_key", "item_id", (-F.col("t.s")).cast("long").alias("start"), F.col("t.aligned").cast("long").alias("n_aligned"), F.col("t.equal").cast("long").alias("n_equal"), F.col("t.best").cast("long").alias("best_stretch"))


def clean(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The documents without the contaminated ones, all columns kept."""
    with spent(keep=(keep := [])):
        keep.append(cut(hits(docs, benchmark, **options).select("doc_id", "text_key").distinct()))
    return having(docs, keep[0], "left_anti")
