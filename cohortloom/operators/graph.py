"""Relatedness graphs: classes, components, unrelated subsets, kinship from genotypes."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import fixed
from ..session import cut, uncut
from . import tiles as T
from .joins import expand_neighbours


def classify_pairs(edges: DataFrame, low: float = fixed.KIN_FIRST, high: float = fixed.KIN_IDENTICAL, ibs0: float = fixed.IBS0_CUT) -> DataFrame:
    """identical, sibling or parent_child by kinship and shared-nothing rate; null for all others."""
    k, z = F.col("kinship"), F.col("ibs0")
    rel = F.when((k >= high) & (z < ibs0), "identical").when((k >= low) & (k < high), F.when(z >= ibs0, "sibling").otherwise("parent_child"))
    return edges.withColumn("relationship", rel)


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select(F.col("u"), F.col("v")).unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))


def component_labels(edges: DataFrame, a: str = "iid1", b: str = "iid2") -> DataFrame:
    """Least member of the component for every node with an edge.

    Alternating large-star and small-star steps: neighbours above a node move to the least neighbour, then those below, until
    the edges are stars and a round changes nothing. Rounds grow with the logarithm of the size; each ends in a written table that replaces
    the one before; hubs are split by the adaptive skew join because a hub's minimum is a single row.
    """
    e = cut(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct())
    seen = None
    while True:
        near = _both_ways(e)
        least = near.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = cut(near.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct())
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        j = large.join(low, "u")
        small = j.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(low.select("u", F.col("m").alias("v"))).distinct()
        before, e = e, cut(small)
        uncut(before)
        uncut(large)
        mark = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if mark == seen:
            break
        seen = mark
    return e.select(F.col("u").alias("iid"), F.col("v").alias("component")).unionByName(e.select(F.col("v").alias("iid"), F.col("v").alias("component")).distinct())


def components(edges: DataFrame, min_size: int = 3) -> tuple[DataFrame, DataFrame]:
    """Members with their component, and per component size, edges, clique flag and whether it is excluded for its size."""
    labels = component_labels(edges)
    size = labels.groupBy("component").agg(F.count(F.lit(1)).alias("size"))
    n_edges = edges.select(F.least("iid1", "iid2").alias("iid"), F.greatest("iid1", "iid2").alias("o")).where("iid <> o").distinct().join(labels, "iid").groupBy("component").agg(F.count(F.lit(1)).alias("n_edges"))
    table = size.join(n_edges, "component").select(
        "component", "size", "n_edges", (F.col("n_edges") == F.col("size") * (F.col("size") - 1) / 2).alias("is_clique"), (F.col("size") >= min_size).alias("excluded")
    )
    return labels, table


def independent_set(nodes: DataFrame, pairs: DataFrame, priority: DataFrame | None = None) -> DataFrame:
    """Maximal set of nodes without a pair inside.

    Every round keeps the nodes that come before all their remaining neighbours and removes those neighbours, until no pair is left.
    The order is the power of two of the node's number of pairs (or of the given positive priority), then a hash, then the id: numbers that
    run smoothly along a chain would settle it a few nodes a round, hashes settle all but a few in a number of rounds that grows with the
    logarithm of the size. The order depends on the node and its pairs alone, never on how rows lie in partitions. Only the removed ids are carried, so the
    result is nodes minus removed.
    """
    key = nodes.columns[0]
    both = _both_ways(pairs.select(F.col(pairs.columns[0]).alias("u"), F.col(pairs.columns[1]).alias("v")).where("u <> v")).distinct()
    ids = nodes.select(F.col(key).alias("u"))
    both = both.join(ids, "u", "left_semi").join(ids.withColumnRenamed("u", "v"), "v", "left_semi").select("u", "v")
    if priority is None:
        rank = both.groupBy("u").agg(F.count(F.lit(1)).cast("double").alias("p"))
    else:
        rank = priority.select(F.col(priority.columns[0]).alias("u"), F.col(priority.columns[1]).cast("double").alias("p"))
    band = F.when(F.col("p") > 0, F.floor(F.log2("p"))).otherwise(-1100).cast("int")
    rank = cut(rank.select("u", F.struct(band.alias("p"), F.xxhash64("u").alias("h"), F.col("u").alias("id")).alias("pu")))
    live = both.join(rank, "u").join(rank.select(F.col("u").alias("v"), F.col("pu").alias("pv")), "v")
    live = cut(live.select("u", "v", "pu", "pv"))
    removed = None
    while True:
        if live.isEmpty():
            break
        first = live.groupBy("u", "pu").agg(F.min("pv").alias("best")).where("pu < best").select("u")
        gone = cut(live.join(first, "u", "left_semi").select(F.col("v").alias("u")).distinct())
        removed = gone if removed is None else removed.unionByName(gone)
        before, live = live, cut(live.join(gone, "u", "left_anti").join(gone.withColumnRenamed("u", "v"), "v", "left_anti").select("u", "v", "pu", "pv"))
        uncut(before)
    return nodes if removed is None else nodes.join(removed.withColumnRenamed("u", key), key, "left_anti")


def unrelated(nodes: DataFrame, edges: DataFrame, seeds: DataFrame, t: float = fixed.UNRELATED_CUT) -> DataFrame:
    """Nodes off the seeds and their relatives, thinned until no pair at or above the threshold is left."""
    candidates = nodes.join(expand_neighbours(seeds, edges, t), "iid", "left_anti")
    return independent_set(candidates.select("iid"), edges.where(F.col("kinship") >= t).select("iid1", "iid2"))


def verify_unrelated(kept: DataFrame, nodes: DataFrame, edges: DataFrame, seeds: DataFrame, t: float = fixed.UNRELATED_CUT) -> DataFrame:
    """Counts that must be zero: kept ids unknown to the start set, related pairs inside the kept set, and ids off the seeds and their
    relatives that could still be added."""
    strong = edges.where(F.col("kinship") >= t)
    inside = strong.join(kept.withColumnRenamed("iid", "iid1"), "iid1", "left_semi").join(kept.withColumnRenamed("iid", "iid2"), "iid2", "left_semi")
    stray = kept.join(nodes, "iid", "left_anti")
    free = nodes.select("iid").join(expand_neighbours(seeds, edges, t), "iid", "left_anti").join(expand_neighbours(kept.select("iid"), edges, t), "iid", "left_anti")
    one = lambda df, name: df.agg(F.count(F.lit(1)).alias(name))
    return one(stray, "n_unknown").crossJoin(one(inside, "n_related_pairs")).crossJoin(one(free, "n_addable"))  # single rows


def kin_holdout(train: DataFrame, applied: DataFrame, edges: DataFrame, t: float = fixed.UNRELATED_CUT) -> tuple[DataFrame, DataFrame]:
    """Training ids without relatives of applied ids, and the edges that caused the exclusions."""
    near = expand_neighbours(applied.select("iid"), edges, t)
    kept = train.select("iid").join(near, "iid", "left_anti")
    lost = train.select("iid").join(near, "iid", "left_semi")
    strong = edges.where(F.col("kinship") >= t)
    ends = strong.select(F.col("iid1").alias("iid"), F.col("iid2").alias("relative"), "kinship").unionByName(strong.select(F.col("iid2").alias("iid"), F.col("iid1").alias("relative"), "kinship"))
    report = ends.join(lost, "iid", "left_semi").join(applied.select(F.col("iid").alias("relative")), "relative", "left_semi")
    return kept, report.select("iid", "relative", "kinship")


def _kin_products(lhs: np.ndarray, rhs: np.ndarray) -> np.ndarray:
    f = lambda m: m.astype(np.float32)
    het_l, het_r, ok_l, ok_r = f(lhs == 1), f(rhs == 1), f(lhs >= 0), f(rhs >= 0)
    ibs0 = f(lhs == 0) @ f(rhs == 2).T + f(lhs == 2) @ f(rhs == 0).T
    return np.stack([ok_l @ ok_r.T, het_l @ het_r.T, ibs0, het_l @ ok_r.T, ok_l @ het_r.T])


def _sparse_kinship(cells: DataFrame, t: float) -> DataFrame:
    """Kinship from pairs of observed cells of one variant: work grows with these pairs, not with all pairs of samples."""
    cells = cells.where(F.col("dosage").isNotNull()).select("variant_id", "sample_id", F.col("dosage").cast("tinyint").alias("d"))
    pairs = cells.alias("a").join(cells.alias("b"), F.expr("a.variant_id = b.variant_id AND a.sample_id < b.sample_id"))
    both = pairs.select(F.col("a.sample_id").alias("iid1"), F.col("b.sample_id").alias("iid2"), F.col("a.d").alias("x"), F.col("b.d").alias("y"))
    terms = {"n_variants": F.lit(1), "h": F.expr("x = 1 AND y = 1").cast("int"), "z": F.expr("abs(x - y) = 2").cast("int"), "hi": F.expr("x = 1").cast("int"), "hj": F.expr("y = 1").cast("int")}
    sums = T.added(both, ["iid1", "iid2"], terms, T.most_cells(cells, "sample_id"))
    m = F.least("hi", "hj")
    sums = sums.where(m > 0).withColumn("kinship", (F.col("h") - 2 * F.col("z")) / (2 * m) + 0.5 - (F.col("hi") + F.col("hj")) / (4 * m))
    return sums.where(F.col("kinship") >= t).select("n_variants", (F.col("h") / F.col("n_variants")).alias("hethet"), (F.col("z") / F.col("n_variants")).alias("ibs0"), "kinship", "iid1", "iid2")


def kinship(genotypes: DataFrame | T.Tiles, t: float = fixed.KIN_TABLE_MIN, wide: int = 4, chunks: int | None = None) -> DataFrame:
    """Robust between-family kinship of all sample pairs at or above the table limit.

    phi = (hethet - 2 ibs0) / (2 m) + 1/2 - (het_i + het_j) / (4 m), m the smaller het count, over variants seen in both samples. Every super-block of
    samples meets every other one in a cell of the grid; see `tiles.pair_sums`. Where few cells are observed, samples meet in the variants that both have.
    """
    if not isinstance(genotypes, T.Tiles):
        genotypes = cut(genotypes.select("variant_id", "sample_id", "dosage"))
        if T.sparse(genotypes):
            return _sparse_kinship(genotypes, t)
    packed = genotypes if isinstance(genotypes, T.Tiles) else T.pack(genotypes)
    grid = T.grid_of(packed.n_samples, wide)

    def finish(i: np.ndarray, j: np.ndarray, sums: np.ndarray) -> dict:
        n, hethet, ibs0, het_i, het_j = sums
        m = np.minimum(het_i, het_j)
        with np.errstate(all="ignore"):
            phi = (hethet - 2 * ibs0) / (2 * m) + 0.5 - (het_i + het_j) / (4 * m)
        ok = (m > 0) & (phi >= t) & (j > i)
        return {"i": i[ok], "j": j[ok], "n_variants": n[ok].astype(np.int64), "hethet": hethet[ok] / n[ok], "ibs0": ibs0[ok] / n[ok], "kinship": phi[ok]}

    pairs = T.pair_sums(packed, "samples", grid, grid.side, 5, _kin_products, finish, "i long, j long, n_variants long, hethet double, ibs0 double, kinship double", chunks)
    return T.named(pairs, packed.samples, "sample_id", "iid1", "iid2")
