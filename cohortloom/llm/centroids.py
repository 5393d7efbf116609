"""Exact integer k-means whose nearest-centroid search runs over Walsh-Hadamard coefficients, coarse to fine.

The unnormalised transform of integers is an exact integer transform that multiplies every squared distance by the number of
components. Vectors are transformed once and kept so; centroids once a round. In a task all vectors of a batch add up the squared
coefficient differences level by level (coefficients 0, 1, 2-3, 4-7, ... 32-63 of 64). After each level the sum so far is a lower bound,
and the sum plus twice the energies still open an upper one, as (a - b)^2 <= 2 (a^2 + b^2); a centroid whose lower bound is above the least upper bound is
strictly worse and drops out for that vector. Whoever is left after the last level has its exact distance, ties included.

Every batch also adds up its vectors by cluster, so a round shuffles one row of sums per task and cluster and the driver gets one row per
cluster. The transform is linear, so the sums of the transformed vectors give the exact sums of the components. Vectors stay in one written table.

Defined cases: a vector that is null, has another length, or holds a null or non-finite component is left out; extra columns are ignored;
a repeated row is a vector of its own; a null id is hashed as an empty one; equal seed hashes are ordered by the transformed vectors. With fewer vectors than
clusters, each starts a centroid. An empty table gives an empty result. Large components are searched with Python's integers instead of
64-bit ones; those beyond 2^28 raise, as their distances do not fit a long, and so does an inertia that does not.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut, uncut

#: Transformed values below this have squares whose sums (twice, over 64 coefficients, of differences) fit 64 bits.
NARROW = 1 << 26
#: No squared distance of larger components is sure to fit a long.
LARGEST = 1 << 28
#: Vectors that a task searches at a time.
ROWS = 1 << 14


def transform(v: np.ndarray) -> np.ndarray:
    """Unnormalised Walsh-Hadamard transform of the rows; applied twice it multiplies by their length."""
    n, width = v.shape
    step = 1
    while step < width:
        pairs = v.reshape(n, width // (2 * step), 2, step)
        v = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], axis=2).reshape(n, width)
        step *= 2
    return v


def levels(width: int) -> list[tuple[int, int]]:
    """Coefficients from the coarsest on: the first one, then as many again as came before."""
    out, at = [(0, 1)], 1
    while at < width:
        out.append((at, 2 * at))
        at *= 2
    return out


def nearest(x: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each transformed vector the number of its nearest transformed centroid, the first of equals, and the squared distance of the originals."""
    n, width = x.shape
    k = len(c)
    bounds = levels(width)
    energy = lambda m: np.stack([(m[:, a:b] * m[:, a:b]).sum(axis=1) for a, b in bounds], axis=1)
    open_x, open_c = (e.sum(axis=1, keepdims=True) - np.cumsum(e, axis=1) for e in (energy(x), energy(c)))
    total = np.zeros((n, k), x.dtype)
    alive = np.ones((n, k), bool)
    for level, (a, b) in enumerate(bounds):
        for j in range(k):
            rows = np.flatnonzero(alive[:, j])
            if len(rows):
                d = x[rows, a:b] - c[j, a:b]
                total[rows, j] += (d * d).sum(axis=1)
        if level + 1 < len(bounds):
            upper = total + 2 * (open_x[:, level, None] + open_c[None, :, level])
            upper[~alive] = upper.max(initial=0)
            least = upper.min(axis=1, keepdims=True)
            alive &= total <= least
    total[~alive] = total.max(initial=0) + 1
    best = np.argmin(total, axis=1)
    return best, total[np.arange(n), best] // width


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def _searched(it: Iterator[pa.RecordBatch], centers: np.ndarray) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]]:
    """Ids, transformed vectors, clusters and distances, some rows at a time; Python's integers where 64 bits might not hold the squares."""
    width = centers.shape[1]
    for batch in it:
        for at in range(0, batch.num_rows, ROWS):
            part = batch.slice(at, ROWS)
            x = _matrix(part.column("wht"), width)
            narrow = max(np.abs(x).max(), np.abs(centers).max()) < NARROW
            cluster, distance = nearest(x, centers) if narrow else nearest(x.astype(object), centers.astype(object))
            yield part.column("vec_id"), x, cluster, distance


def vectors(table: DataFrame, column: str, width: int, scale: int) -> DataFrame:
    """vec_id and the transformed integer vector of every row that has `width` finite components, written."""
    v = F.col(column)
    finite = F.forall(v, lambda x: x.isNotNull() & (F.abs(x.cast("double")) < float("inf")) & ~F.isnan(x.cast("double")))
    scaled = F.transform(v, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")))
    sound = table.select(F.col("vec_id").cast("long").alias("vec_id"), F.when(F.coalesce((F.size(v) == width) & finite, F.lit(False)), scaled).alias("v")).where("v is not null")

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            x = _matrix(batch.column("v"), width)
            if len(x) and np.abs(x).max() > LARGEST:
                raise ValueError(f"a component is beyond {LARGEST}: squared distances would not fit a long")
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * width, pa.int32()), pa.array(transform(x).reshape(-1), pa.int64()))
            yield pa.record_batch([batch.column("vec_id"), lists], ["vec_id", "wht"])

    return cut(sound.mapInArrow(run, "vec_id long, wht array<long>"))


def seeds(points: DataFrame, k: int, width: int, seed: int) -> np.ndarray:
    """The transformed vectors with the k least hashes of seed:id, in that order."""
    name = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))).cast("binary"), 256)
    least = points.select(name.alias("h"), "wht").orderBy("h", "wht").limit(k).collect()  # k rows
    return np.array([r.wht for r in least], np.int64).reshape(-1, width)


def moved(points: DataFrame, centers: np.ndarray) -> np.ndarray:
    """One round: assigns all vectors and returns the transformed new centroids; those without vectors stay."""
    k, width = centers.shape

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts = np.zeros((k, width), object), np.zeros(k, np.int64)
        for _, x, cluster, _ in _searched(it, centers):
            for j in np.unique(cluster):
                mine = x[cluster == j]
                sums[j] += mine.sum(axis=0)  # at most ROWS x 2^36
                counts[j] += len(mine)
        some = np.flatnonzero(counts)
        lists = [[str(v) for v in sums[j]] for j in some]
        yield pa.record_batch([pa.array(some, pa.int32()), pa.array(counts[some], pa.int64()), pa.array(lists, pa.list_(pa.string()))], ["cluster", "n", "sums"])

    parts = points.mapInArrow(run, "cluster int, n long, sums array<string>")
    whole = parts.select("cluster", "n", F.posexplode("sums").alias("i", "s")).groupBy("cluster", "i").agg(F.sum("n").alias("n"), F.sum(F.col("s").cast("decimal(38,0)")).alias("s"))
    sums, counts = np.zeros((k, width), object), np.zeros(k, object)
    for r in whole.collect():  # k x width rows
        sums[r.cluster, r.i], counts[r.cluster] = int(r.s), r.n
    some = np.flatnonzero(counts)
    out = centers.copy()
    out[some] = transform((transform(sums[some]) // width) // counts[some, None]).astype(np.int64)
    return out


def cluster(table: DataFrame, column: str = "embedding", k: int = 8, rounds: int = 10, width: int = 64, scale: int = 1024, seed: int = 3) -> DataFrame:
    """One row per vector: vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256.

    `width` is a power of two. Rounds stop when no centroid moves, as further ones would not change anything.
    """
    spark = table.sparkSession
    if width & (width - 1) or width < 1:
        raise ValueError("width must be a power of two")
    points = vectors(table, column, width, scale)
    centers = seeds(points, k, width, seed)
    for _ in range(rounds if len(centers) else 0):
        new = moved(points, centers)
        if np.array_equal(new, centers):
            break
        centers = new

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, _, best, distance in _searched(it, centers):
            yield pa.record_batch([ids, pa.array(best, pa.int32()), pa.array(distance, pa.int64())], ["vec_id", "cluster", "distance"])

    placed = cut(points.mapInArrow(run, "vec_id long, cluster int, distance long"))
    uncut(points)
    per = placed.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia")).collect()  # k rows
    names = [hashlib.sha256(",".join(map(str, transform(c[None])[0] // width)).encode()).hexdigest() for c in centers]
    total = sum(r.cluster_inertia for r in per)
    facts = spark.createDataFrame([(r.cluster, r.cluster_inertia, total, names[r.cluster]) for r in per], "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return placed.join(F.broadcast(facts), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
