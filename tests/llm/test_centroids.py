"""Exact k-means over Walsh-Hadamard coefficients against plain integers."""

import hashlib
import math
import random

import numpy as np
import pytest

from cohortloom.llm import centroids as ct

SCHEMA = "vec_id long, embedding array<float>, label int, wht array<long>, cluster string, distance long"


def plain(rows, k=8, rounds=10):
    kept = [(i, tuple(math.floor(1024 * float(np.float32(x))) for x in v)) for i, v in rows if v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v)]
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    start = sorted(kept, key=lambda r: sha(f"3:{'' if r[0] is None else r[0]}"))[:k]
    centers = [list(v) for _, v in start]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(centers))

    for _ in range(rounds):
        best = [nearest(v)[1] for _, v in kept]
        for j in range(len(centers)):
            mine = [v for (_, v), b in zip(kept, best) if b == j]
            if mine:
                centers[j] = [sum(col) // len(mine) for col in zip(*mine)]
    found = [nearest(v) for _, v in kept]
    per = {j: sum(d for d, b in found if b == j) for j in range(len(centers))}
    return sorted(str((i, j, d, per[j], sum(per.values()), sha(",".join(map(str, centers[j]))))) for (i, _), (d, j) in zip(kept, found))


def rows_of(n, seed=1, spread=3.0):
    r = random.Random(seed)
    base = [[r.uniform(-1, 1) for _ in range(64)] for _ in range(5)]
    return [(i, [x + r.uniform(-spread, spread) for x in base[i % 5]]) for i in range(n)]


def answer(spark, rows, **more):
    got = ct.cluster(spark.createDataFrame([(i, v, 0, [1], "x", 5) for i, v in rows], SCHEMA), **more)
    assert got.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    return sorted(str(tuple(r)) for r in got.collect())


def test_clusters_equal_plain_integers(spark):
    rows = rows_of(90)
    rows += [(7, rows[7][1])] * 20 + [(None, rows[3][1]), (200, None), (201, [1.0] * 63), (202, [1.0] * 63 + [None]), (203, [float("nan")] + [0.0] * 63), (204, [float("inf")] * 64), (205, [])]
    assert answer(spark, rows) == plain(rows)


def test_ties_and_large_components(spark):
    rows = [(i, [float(i % 2)] * 64) for i in range(12)]
    assert answer(spark, rows, rounds=2) == plain(rows, rounds=2)
    wide = [(i, [x * 2000 for x in v]) for i, v in rows_of(20, seed=3)]
    assert answer(spark, wide, rounds=2) == plain(wide, rounds=2)


def test_fewer_vectors_than_clusters_and_none(spark):
    rows = rows_of(3)
    assert answer(spark, rows) == plain(rows)
    assert answer(spark, []) == []
    with pytest.raises(Exception, match="beyond"):
        answer(spark, [(1, [1e9] * 64)])


def test_progressive_search_finishes_the_nearest(spark):
    r = np.random.default_rng(4)
    x, c = r.integers(-4000, 4000, (500, 64)), r.integers(-4000, 4000, (8, 64))
    c[6] = c[1]
    x[:50] = c[1]
    best, distance = ct.nearest(ct.transform(x), ct.transform(c))
    every = ((x[:, None] - c[None]) ** 2).sum(axis=2)
    assert (best == every.argmin(axis=1)).all() and (distance == every.min(axis=1)).all()
    assert (ct.transform(ct.transform(x)) == 64 * x).all()
