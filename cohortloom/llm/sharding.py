"""Sharding on a consistent-hash ring with virtual nodes and bounded loads, in DataFrame operations only.

Keys and nodes hash onto a ring of 2^bits positions. A key goes to the next node clockwise; a shard takes keys up to its bound and
the rest travel on to the next node whose shard has room. Only counts per ring position travel through the rounds: at most 2^bits
rows plus one per `unit_rows` documents of a crowded position. Every round with travellers fills at least one shard, so there are at
most as many rounds as shards. Documents are then numbered inside their position and looked up in the runs that the rounds made.

Defined cases: a null text has size 1 and checksum 0; a null key hashes like any other value and a position that holds more than
`unit_rows` documents is cut into units by row, so that equal keys never meet in one task; repeated rows are rows of their own; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut
from .common import whole


def ring(spark, shards: int, vnodes: int, bits: int) -> DataFrame:
    """Nodes of the ring: idx clockwise from 0, position, shard. shards x vnodes rows; a shard's nodes do not depend on how many shards there are."""
    nodes = spark.range(shards * vnodes).select((F.col("id") % shards).cast("int").alias("shard"), F.floor(F.col("id") / shards).cast("int").alias("copy"))
    nodes = nodes.withColumn("pos", F.shiftrightunsigned(F.xxhash64(F.lit("node"), "shard", "copy"), 64 - bits))
    return nodes.select((F.row_number().over(Window.orderBy("pos", "shard", "copy")) - 1).cast("long").alias("idx"), "pos", "shard")


def bounds(spark, total: int, shards: int, slack: float) -> DataFrame:
    """Room of each shard. Without slack the bounds add up to the documents, so that counts differ by one at most."""
    if slack:
        room = F.ceil(F.lit(total) * (1 + slack) / shards).cast("long")
    else:
        room = (F.floor(F.lit(total) / shards) + (F.col("id") < total % shards).cast("long")).cast("long")
    return spark.range(shards).select(F.col("id").cast("int").alias("shard"), room.alias("room"))


def fill(cells: DataFrame, nodes: DataFrame, room: DataFrame) -> DataFrame:
    """Runs of each cell's documents: cell, first number, count n, shard and the shard's slot of the first one.

    cells: cell, pos, n. Nothing here grows with the documents but the number of cells. These tables are small by construction, so
    each is one partition and no step of the rounds shuffles.
    """
    cells, nodes, room = cells.coalesce(1), cut(nodes).coalesce(1), room.coalesce(1)
    size = nodes.count()
    # ordered backwards: a running last value costs a step per row, a first value over what follows would cost the rest of the table
    behind = Window.orderBy(F.desc("at"), F.desc("kind"), F.desc("idx")).rowsBetween(Window.unboundedPreceding, 0)
    first = F.last(F.when(F.col("kind") == 1, F.col("idx")), ignorenulls=True).over(behind)
    marks = cells.select(F.col("pos").alias("at"), F.lit(0).alias("kind"), F.lit(None).cast("long").alias("idx"), "cell", "n").unionByName(
        nodes.select(F.col("pos").alias("at"), F.lit(1).alias("kind"), "idx", F.lit(None).cast("long").alias("cell"), F.lit(None).cast("long").alias("n")))
    todo = marks.withColumn("home", F.coalesce(first, F.lit(0).cast("long"))).where("kind = 0").select("cell", F.lit(0).cast("long").alias("first"), "n", F.col("home").alias("node"))
    placed = None
    turn = 0
    while True:
        open_nodes = nodes.join(room.where("room > 0"), "shard")
        twice = open_nodes.select("idx", F.col("idx").alias("to"), "shard", "room").unionByName(open_nodes.select((F.col("idx") + size).alias("idx"), F.col("idx").alias("to"), "shard", "room"))
        ahead = Window.orderBy(F.desc("idx")).rowsBetween(Window.unboundedPreceding, 0)
        grid = nodes.select("idx").unionByName(nodes.select((F.col("idx") + size).alias("idx"))).join(twice, "idx", "left")
        route = grid.select(F.col("idx").alias("node"), F.last(F.when(F.col("to").isNotNull(), F.struct("to", "shard", "room")), ignorenulls=True).over(ahead).alias("go")).where(F.col("node") < size)
        before = F.sum("n").over(Window.partitionBy("shard").orderBy("cell", "first").rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("n")
        moved = todo.join(route, "node").select("cell", "first", "n", "go.*").withColumn("take", F.greatest(F.lit(0).cast("long"), F.least("n", F.col("room") - before)))
        moved = cut(moved).coalesce(1)
        taken = moved.where("take > 0").select("cell", "first", F.col("take").alias("n"), "shard", F.lit(turn).alias("turn"))
        placed = taken if placed is None else placed.unionByName(taken)
        todo = moved.where("n > take").select("cell", (F.col("first") + F.col("take")).alias("first"), (F.col("n") - F.col("take")).alias("n"), ((F.col("to") + 1) % size).alias("node"))
        if todo.isEmpty():
            break
        room = cut(room.join(moved.groupBy("shard").agg(F.sum("take").alias("took")), "shard", "left").select("shard", (F.col("room") - F.coalesce("took", F.lit(0))).alias("room"))).coalesce(1)
        turn += 1
    earlier = F.sum("n").over(Window.partitionBy("shard").orderBy("turn", "cell", "first").rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("n")
    return placed.coalesce(1).select("cell", "first", "n", "shard", earlier.alias("slot_from"))


def assign(docs: DataFrame, shards: int = 8, vnodes: int = 128, bits: int = 16, slack: float = 0.0, unit_rows: int = 1_000_000, seed: int = 1) -> DataFrame:
    """One row per document: doc_id, size, text_crc32, shard, slot (gapless from 0 in each shard)."""
    spark = docs.sparkSession
    keys = docs.select(
        "doc_id", (F.octet_length(whole()) + 1).cast("long").alias("size"), F.crc32(whole().cast("binary")).alias("text_crc32"),
        F.xxhash64(F.lit(seed), "doc_id").alias("key"), F.monotonically_increasing_id().alias("row_id"),
    ).withColumn("pos", F.shiftrightunsigned("key", 64 - bits))
    keys = cut(keys)  # numbers rows once and for all, and leaves the texts behind
    per_pos = cut(keys.groupBy("pos").agg(F.count(F.lit(1)).alias("n")))
    total = per_pos.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    crowded = F.broadcast(per_pos.where(F.col("n") > unit_rows).select("pos", F.ceil(F.col("n") / unit_rows).alias("units")))  # at most documents / unit_rows rows
    units = F.coalesce(F.pmod(F.xxhash64("row_id"), "units"), F.lit(0).cast("long"))
    keys = keys.join(crowded, "pos", "left").withColumn("cell", F.shiftleft("pos", 63 - bits - 1) + units).drop("units")
    cells = cut(keys.groupBy("cell", "pos").agg(F.count(F.lit(1)).alias("n")))
    runs = cut(fill(cells, ring(spark, shards, vnodes, bits), bounds(spark, total, shards, slack)))
    numbered = keys.withColumn("at", F.row_number().over(Window.partitionBy("cell").orderBy("key", "doc_id", "row_id")) - 1)
    hit = (F.col("at") >= F.col("first")) & (F.col("at") < F.col("first") + F.col("n"))
    return numbered.join(runs, "cell").where(hit).select("doc_id", "size", "text_crc32", "shard", (F.col("slot_from") + F.col("at") - F.col("first")).alias("slot"))
