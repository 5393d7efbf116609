"""Mixing sources to target weights by capped water-filling, in DataFrame operations only.

Every source's target is its weight's share of the words wanted, clamped at `epochs` times its size; what a clamp frees is shared by
weight among the rest until none is above its clamp. A source's documents are repeated floor(target / size) times, and in the order
of a seeded hash a leading part of them once more, up to the document whose middle passes the target. Only counts per source and
per 1/4096 of the hash range are shuffled; the rows of the one slice in which the order stops are sorted exactly.

Defined cases: a null text has no words; a null source is a source of its own, last in order; documents without words are never
taken; rows equal in id and text share one fate; a source of size 0 has target 0; empty tables give empty results; other columns are
kept by `repeat` and ignored by `plan`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut
from .common import whole, word_count

#: Fixed values of the contract.
WEIGHTS = (3.0, 1.0, 2.0)


def order_key(seed: int):
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.md5(whole())))


def cyclic_weights(sources: DataFrame, weights=WEIGHTS) -> DataFrame:
    """Weights dealt to the sources in code point order, null last; one row per source."""
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    return sources.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (place % len(weights) + 1).cast("int")))


def water_fill(sources: DataFrame, share: float, epochs: float) -> DataFrame:
    """Adds target to (source, source_size, weight). Each round clamps what is above and raises the level for the rest; two sums per round come back."""
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    cap = F.col("source_size") * F.lit(float(epochs))
    level, wanted = 0.0, share * total
    while True:
        full = cap <= F.col("weight") * F.lit(level)
        held, open_weight = sources.agg(F.coalesce(F.sum(F.when(full, cap)), F.lit(0.0)), F.coalesce(F.sum(F.when(~full, F.col("weight"))), F.lit(0.0))).first()
        higher = (wanted - held) / open_weight if open_weight > 0 else level
        if higher <= level:
            break
        level = higher
    return sources.withColumn("target", F.least(cap, F.col("weight") * F.lit(level)))


def plan(docs: DataFrame, share: float = 1.5, epochs: float = 2.0, seed: int = 9, weights=WEIGHTS, weight_table: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """The documents' sizes with their order keys, and per source: size, weight, target, whole repetitions and the last key taken once more."""
    sized = cut(docs.select("doc_id", "source", word_count(whole()).alias("size"), order_key(seed).alias("mix_key")))
    slices = cut(sized.groupBy("source", F.substring("mix_key", 1, 3).alias("slice")).agg(F.sum("size").alias("words")))
    sources = slices.groupBy("source").agg(F.sum("words").alias("source_size"))
    sources = sources.join(weight_table, sources["source"].eqNullSafe(weight_table["source"]), "left").select(sources["*"], F.coalesce("weight", F.lit(0.0)).alias("weight")) if weight_table is not None else cyclic_weights(sources, weights)
    sources = water_fill(cut(sources), share, epochs)
    whole_times = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    sources = sources.withColumn("times", whole_times).withColumn("rest", F.col("target") - F.col("times") * F.col("source_size"))
    sources = cut(sources)
    upto = Window.partitionBy("source").orderBy("slice").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    s = sources.select(F.col("source").alias("s"), "rest")
    edge = slices.withColumn("upto", F.sum("words").over(upto)).withColumn("before", F.col("upto") - F.col("words"))
    edge = edge.join(s, edge["source"].eqNullSafe(s["s"])).where("rest > before and rest <= upto")
    edge = edge.groupBy(F.col("source").alias("s")).agg(F.min(F.struct("slice", "before", "rest")).alias("e")).select("s", "e.*")
    edge = cut(edge)
    rows = sized.join(edge, sized["source"].eqNullSafe(edge["s"]) & (F.substring("mix_key", 1, 3) == edge["slice"]))
    rows = rows.groupBy("s", "slice", "before", "rest", "mix_key").agg(F.sum("size").alias("w"))
    cum = F.col("before") + F.sum("w").over(Window.partitionBy("s").orderBy("mix_key").rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("w")
    last = rows.withColumn("cum", cum).where("2 * cum + w <= 2 * rest").groupBy("s").agg(F.max("mix_key").alias("key"))
    # where no row of the slice is taken, the order stops just before it
    last = last.withColumnRenamed("s", "t")
    last = edge.join(last, edge["s"].eqNullSafe(last["t"]), "left").select("s", F.coalesce("key", "slice").alias("last_key"))
    sources = sources.join(last, sources["source"].eqNullSafe(last["s"]), "left").drop("s", "rest")
    return sized, cut(sources)


def mix(docs: DataFrame, **options) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, times (repetitions), taken words."""
    sized, sources = plan(docs, **options)
    t = sources.withColumnRenamed("source", "s")
    times = F.col("times") + F.coalesce(F.col("mix_key") <= F.col("last_key"), F.lit(False)).cast("long")
    joined = sized.join(t, sized["source"].eqNullSafe(t["s"]), "left")
    return joined.select("doc_id", "source", "size", "source_size", "target", F.when(F.col("size") > 0, times).otherwise(0).alias("times"), (F.col("size") * times).alias("taken"))


def repeat(docs: DataFrame, **options) -> DataFrame:
    """The documents with all their columns, each as many times as the mix takes it. Texts are not shuffled: the plan joins by source."""
    _, sources = plan(docs, **{"seed": 9, **options})
    names = docs.columns
    t = sources.select(F.col("source").alias("__s"), F.col("times").alias("__t"), F.col("last_key").alias("__k"))
    key = order_key(options.get("seed", 9))
    times = F.when(F.regexp_like(whole(), F.lit(r"[^\x20\x09-\x0D]")), F.col("__t") + F.coalesce(key <= F.col("__k"), F.lit(False)).cast("long")).otherwise(0)
    joined = docs.join(t, docs["source"].eqNullSafe(t["__s"]))
    out = joined.select(*[docs[c] for c in names], times.alias("__n")).where("__n > 0")
    return out.select(*[out[c] for c in names], F.explode(F.sequence(F.lit(1), F.col("__n").cast("int"))).alias("__i")).drop("__i")
