"""Graphs, kinship, pruning, components and association against brute force."""

import itertools

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from cohortloom.operators import graph as G
from cohortloom.operators import variants as V


def edges(spark, pairs):
    return spark.createDataFrame([(int(a), int(b), 0.4, 0.0) for a, b in pairs], "iid1 long, iid2 long, kinship double, ibs0 double")


def test_components_path_triangle_hub(spark):
    pairs = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 102), (100, 102)] + [(200, 200 + i) for i in range(1, 60)]
    labels, table = G.components(edges(spark, pairs))
    got = {r["iid"]: r["component"] for r in labels.collect()}
    assert {got[i] for i in range(41)} == {0} and got[102] == 100 and {got[200 + i] for i in range(60)} == {200}
    t = {r["component"]: r for r in table.collect()}
    assert t[0]["size"] == 41 and not t[0]["is_clique"] and t[100]["is_clique"] and t[200]["n_edges"] == 59


def test_independent_set_is_independent_and_maximal(spark):
    g = np.random.default_rng(1)
    pairs = {tuple(sorted(p)) for p in g.integers(0, 80, size=(150, 2)).tolist() if p[0] != p[1]} | {(0, i) for i in range(1, 60)}
    nodes = spark.range(80).select(F.col("id").alias("iid"))
    kept = {r["iid"] for r in G.independent_set(nodes, edges(spark, pairs).select("iid1", "iid2")).collect()}
    assert not any(a in kept and b in kept for a, b in pairs)
    near = {v: {b if a == v else a for a, b in pairs if v in (a, b)} for v in range(80)}
    assert all(v in kept or near[v] & kept for v in range(80))


def test_independent_set_settles_on_a_long_chain(spark):
    """Priorities that rise along a chain: the worst order for rounds of local minima."""
    nodes = spark.range(1000).select(F.col("id").alias("iid"))
    chain = spark.range(999).select(F.col("id").alias("iid1"), (F.col("id") + 1).alias("iid2"))
    kept = {r["iid"] for r in G.independent_set(nodes, chain, nodes.select("iid", F.col("iid").cast("double").alias("p"))).collect()}
    assert not any(i + 1 in kept for i in kept) and all(i in kept or i - 1 in kept or i + 1 in kept for i in range(1000))


@pytest.mark.parametrize("k, z, want", [(0.36, 0.0, "identical"), (0.3535, 0.0011, "identical"), (0.3535, 0.0012, None), (0.1767, 0.0012, "sibling"), (0.3, 0.0, "parent_child"), (0.17, 0.0, None)])
def test_pair_classes(spark, k, z, want):
    df = spark.createDataFrame([(k, z)], "kinship double, ibs0 double")
    assert G.classify_pairs(df).first()["relationship"] == want


def test_holdout(spark):
    ids = lambda xs: spark.createDataFrame([(x,) for x in xs], "iid long")
    kept, report = G.kin_holdout(ids([1, 2, 3]), ids([9]), edges(spark, [(9, 2), (3, 1)]), 0.1)
    assert sorted(r[0] for r in kept.collect()) == [1, 3] and [tuple(r)[:2] for r in report.collect()] == [(2, 9)]


def panel(spark, n=23, m=60, seed=5):
    g = np.random.default_rng(seed)
    d = g.binomial(2, 0.4, size=(n, m)).astype(float)
    d[1] = d[0]
    d[:, 1] = d[:, 0]
    d[g.random((n, m)) < 0.05] = np.nan
    cells = [(j, i, None if np.isnan(d[i, j]) else int(d[i, j])) for i in range(n) for j in range(m)]
    return d, spark.createDataFrame(cells, "variant_id long, sample_id long, dosage int")


def test_kinship_matches_brute_force_across_blocks(spark):
    d, g = panel(spark)
    got = {(r["iid1"], r["iid2"]): r["kinship"] for r in G.kinship(g, -9.0).collect()}
    for i, j in itertools.combinations(range(len(d)), 2):
        ok = ~np.isnan(d[i]) & ~np.isnan(d[j])
        a, b = d[i][ok], d[j][ok]
        hi, hj, both, z = (a == 1).sum(), (b == 1).sum(), ((a == 1) & (b == 1)).sum(), (abs(a - b) == 2).sum()
        m = min(hi, hj)
        assert np.isclose(got[i, j], (both - 2 * z) / (2 * m) + 0.5 - (hi + hj) / (4 * m))


def cells(spark, d):
    i, j = np.nonzero(~np.isnan(d))
    return spark.createDataFrame(pd.DataFrame({"variant_id": j.astype("int64"), "sample_id": i.astype("int64"), "dosage": d[i, j].astype("int32")}))


def large_panel(n, m, seed):
    """Neighbouring variants are alike, so that many pairs are correlated."""
    r = np.random.default_rng(seed)
    d = r.binomial(2, r.uniform(0.1, 0.5, m), (n, m)).astype(float)
    for j in range(1, m):
        same = r.random(n) < r.choice([0.2, 0.6, 0.9])
        d[same, j] = d[same, j - 1]
    d[r.random((n, m)) < 0.05] = np.nan
    return d


@pytest.mark.parametrize("chunks", [1, 3])
def test_kinship_over_several_super_blocks(spark, chunks):
    d = large_panel(300, 600, 3)
    got = {(r["iid1"], r["iid2"]): (r["kinship"], r["n_variants"]) for r in G.kinship(cells(spark, d), 0.02, wide=1, chunks=chunks).collect()}
    ok, het = (~np.isnan(d)).astype(int), (d == 1).astype(int)
    hi, hj = het @ ok.T, ok @ het.T
    z = (d == 0).astype(int) @ (d == 2).astype(int).T
    m = np.minimum(hi, hj)
    phi = (het @ het.T - 2 * (z + z.T)) / (2 * m) + 0.5 - (hi + hj) / (4 * m)
    want = {(i, j): (phi[i, j], (ok @ ok.T)[i, j]) for i, j in itertools.combinations(range(300), 2) if phi[i, j] >= 0.02}
    assert set(got) == set(want) and want and all(np.isclose(got[k], want[k]).all() for k in want)


def plain_prune(d, chroms, window, step, limit):
    """A greedy pass over all windows of each chromosome; missing cells are left out pair by pair."""
    ok, x = ~np.isnan(d), np.nan_to_num(d)
    f = x.sum(axis=0) / (2 * ok.sum(axis=0))
    maf, gone, pairs = np.minimum(f, 1 - f), set(), set()

    def linked(i, j):
        both = ok[:, i] & ok[:, j]
        return np.corrcoef(x[both, i], x[both, j])[0, 1] ** 2 > limit

    for c in sorted(set(chroms)):
        mine = [k for k, v in enumerate(chroms) if v == c]
        for start in range(0, len(mine), step):
            now = mine[start:start + window]
            for a, i in enumerate(now):
                for j in now[a + 1:]:
                    if i not in gone and j not in gone and linked(i, j):
                        pairs.add((i, j))
                        gone.add(i if maf[i] < maf[j] else j)
    return set(range(len(chroms))) - gone


@pytest.mark.parametrize("window, step, ranges", [(30, 11, 1), (5, 5, 64)])
def test_pruning_equals_a_plain_greedy_pass(spark, window, step, ranges):
    d = large_panel(50, 560, 5)
    chroms = ["1" if j < 400 else "2" for j in range(560)]
    v = spark.createDataFrame([(j, c, 1000 + j // 2) for j, c in enumerate(chroms)], "variant_id long, chrom string, pos long")
    kept = {r["variant_id"] for r in V.ld_prune(cells(spark, d), v, window, step, 0.2, ranges=ranges).collect()}
    assert kept == plain_prune(d, chroms, window, step, 0.2)


def test_ld_pairs_of_neighbouring_super_blocks(spark):
    d = large_panel(40, 560, 6)
    v = spark.createDataFrame([(j, "1" if j < 300 else "2", j) for j in range(560)], "variant_id long, chrom string, pos long")
    want = set()
    for i, j in itertools.combinations(range(560), 2):
        ok = ~np.isnan(d[:, i]) & ~np.isnan(d[:, j])
        if (i < 300) == (j < 300) and j - i <= 270 and np.corrcoef(d[ok, i], d[ok, j])[0, 1] ** 2 > 0.15:
            want.add((i, j))
    got = {(r["variant_i"], r["variant_j"]) for r in V.ld_pairs(cells(spark, d), v, 270, 0.15, wide=1).collect()}
    assert got == want and any(j - i > 256 for i, j in want)


@pytest.fixture
def few_cells(spark, monkeypatch):
    """One cell in twenty is observed: tiles would be empty almost everywhere, so none may be packed."""
    def fail(*_):
        raise AssertionError("sparse cells were packed")

    monkeypatch.setattr(V.T, "pack", fail)
    r = np.random.default_rng(21)
    d = r.binomial(2, r.uniform(0.2, 0.5, 500), (300, 500)).astype(float)
    d[r.random(d.shape) > 0.05] = np.nan
    return d, cells(spark, d)


def test_kinship_of_few_cells(spark, few_cells):
    d, g = few_cells
    got = {(x["iid1"], x["iid2"]): (x["kinship"], x["n_variants"], x["hethet"]) for x in G.kinship(g, -0.3).collect()}
    want = {}
    for i, j in itertools.combinations(range(len(d)), 2):
        ok = ~np.isnan(d[i]) & ~np.isnan(d[j])
        a, b = d[i][ok], d[j][ok]
        hi, hj, both, z = (a == 1).sum(), (b == 1).sum(), ((a == 1) & (b == 1)).sum(), (abs(a - b) == 2).sum()
        if (m := min(hi, hj)) and (k := (both - 2 * z) / (2 * m) + 0.5 - (hi + hj) / (4 * m)) >= -0.3:
            want[i, j] = k, ok.sum(), both / ok.sum()
    assert set(got) == set(want) and want and all(np.isclose(got[k], want[k]).all() for k in want)


@pytest.mark.filterwarnings("ignore::RuntimeWarning")
def test_pruning_of_few_cells(spark, few_cells):
    d, g = few_cells
    chroms = ["1" if j < 350 else "2" for j in range(500)]
    v = spark.createDataFrame([(j, c, 1000 + j // 2) for j, c in enumerate(chroms)], "variant_id long, chrom string, pos long")
    want = set()
    for i, j in itertools.combinations(range(500), 2):
        ok = ~np.isnan(d[:, i]) & ~np.isnan(d[:, j])
        if chroms[i] == chroms[j] and j - i <= 29 and ok.sum() > 1 and np.corrcoef(d[ok, i], d[ok, j])[0, 1] ** 2 > 0.21:
            want.add((i, j))
    got = {(x["variant_i"], x["variant_j"]) for x in V.ld_pairs(g, v, 29, 0.21).collect()}
    assert got == want and want
    kept = {x["variant_id"] for x in V.ld_prune(g, v, 30, 11, 0.21, ranges=1).collect()}
    assert kept == plain_prune(d, chroms, 30, 11, 0.21)


def test_association_of_few_cells(spark, few_cells):
    d, g = few_cells
    y = np.random.default_rng(4).normal(size=(300, 9))
    y[::7, 1] = np.nan
    names = [f"t {k}" for k in range(9)]
    t = spark.createDataFrame([(i, *[None if np.isnan(v) else float(v) for v in row]) for i, row in enumerate(y)], "sample_id long, " + ", ".join(f"`{n}` double" for n in names))
    got = {(x["variant_id"], x["pheno_id"]): x for x in V.associate(g, t, names).collect()}
    for j, k in itertools.product(range(0, 500, 50), range(9)):
        ok = ~np.isnan(d[:, j]) & ~np.isnan(y[:, k])
        row = got[j, names[k]]
        assert row["n"] == ok.sum() and np.isclose(row["a1freq"], d[ok, j].mean() / 2) and np.isclose(row["beta"], np.polyfit(d[ok, j], y[ok, k], 1)[0])


def test_packed_sums_split_where_they_do_not_fit(spark):
    rows = spark.range(40).selectExpr("id % 3 AS k", "id AS a", "2 * id AS b", "1 AS c", "id * id AS d")
    terms = {n: F.col(n) for n in "abcd"}
    one, other = (sorted(map(tuple, V.T.added(rows, ["k"], terms, most).collect())) for most in (1 << 20, 1 << 40))
    assert one == other == sorted((k, sum(r := range(k, 40, 3)), 2 * sum(r), len(r), sum(x * x for x in r)) for k in range(3))


def test_independent_set_does_not_depend_on_partitions(spark):
    r = np.random.default_rng(8)
    pairs = spark.createDataFrame([(int(a), int(b)) for a, b in r.integers(0, 400, (600, 2))], "iid1 long, iid2 long")
    nodes = spark.range(400).withColumnRenamed("id", "iid")
    equal = nodes.select("iid", F.lit(1.0).alias("p"))
    one, other = ({x["iid"] for x in G.independent_set(nodes.repartition(n), pairs.repartition(n), equal.repartition(n)).collect()} for n in (2, 17))
    assert one == other


def test_components_of_cells_match_svd(spark):
    d, g = panel(spark)
    loads, scores, eigen = V.fit_pcs(g, 2)
    f = np.nanmean(d, axis=0) / 2
    z = np.nan_to_num((d - 2 * f) / np.sqrt(2 * f * (1 - f)))
    u, s, vt = np.linalg.svd(z, full_matrices=False)
    assert np.allclose(eigen, s[:2] ** 2, rtol=1e-3)
    got = scores.toPandas().sort_values("sample_id")[["pc1", "pc2"]].to_numpy()
    w = loads.toPandas().sort_values("variant_id")[["w1", "w2"]].to_numpy()
    for k in range(2):
        assert abs(got[:, k] @ u[:, k]) > 0.99 and abs(w[:, k] @ vt[k]) > 0.99
    proj = V.project_pcs(g, loads, 2).toPandas().sort_values("sample_id")
    assert np.allclose(proj["pc1"], (z @ w[:, 0]) / (2 * (~np.isnan(d)).sum(axis=1)))


def test_association_matches_least_squares(spark):
    d, g = panel(spark)
    r = np.random.default_rng(2)
    y = r.normal(size=len(d))
    t = spark.createDataFrame([(i, float(v), None if i % 5 == 0 else float(v)) for i, v in enumerate(y)], "sample_id long, full double, part double")
    got = {(x["variant_id"], x["pheno_id"]): x for x in V.associate(g, t, ["full", "part"], with_p=True).collect()}
    for j, name in itertools.product(range(60), ("full", "part")):
        ok = ~np.isnan(d[:, j]) & (np.arange(len(d)) % 5 != 0 if name == "part" else True)
        x, yy = d[ok, j], y[ok]
        b = np.cov(x, yy)[0, 1] / x.var(ddof=1)
        se = np.sqrt(((yy - yy.mean() - b * (x - x.mean())) ** 2).sum() / (len(x) - 2) / ((x - x.mean()) ** 2).sum())
        row = got[j, name]
        assert row["n"] == ok.sum() and np.isclose(row["beta"], b) and np.isclose(row["se"], se) and row["log10p"] >= 0


def test_many_traits_run_in_batches(spark):
    d = large_panel(300, 40, 9)
    r = np.random.default_rng(1)
    y = r.normal(size=(300, 70))
    y[r.random(y.shape) < 0.1] = np.nan
    names = [f"t {k}" for k in range(70)]
    t = spark.createDataFrame([(i, *[None if np.isnan(v) else float(v) for v in row]) for i, row in enumerate(y)], "sample_id long, " + ", ".join(f"`{n}` double" for n in names))
    got = {(x["variant_id"], x["pheno_id"]): (x["n"], x["beta"]) for x in V.associate(cells(spark, d), t, names).collect()}
    assert len(got) == 40 * 70
    for j, k in itertools.product((0, 17, 39), (0, 63, 64, 69)):
        ok = ~np.isnan(d[:, j]) & ~np.isnan(y[:, k])
        assert got[j, names[k]][0] == ok.sum() and np.isclose(got[j, names[k]][1], np.polyfit(d[ok, j], y[ok, k], 1)[0])


def test_association_p_values_of_a_small_exact_table(spark):
    """Dosages 0, 1, 2 against 1, 3, 4 and its mirror image: t = 5.196 and -5.196 with one degree of freedom, so p = 2 atan(1 / 5.196) / pi."""
    g = spark.createDataFrame([(7, s, s) for s in range(3)] + [(8, s, 2 - s) for s in range(3)], "variant_id long, sample_id long, dosage int")
    t = spark.createDataFrame([(0, 1.0), (1, 3.0), (2, 4.0)], "sample_id long, y double")
    got = {x["variant_id"]: x for x in V.associate(g, t, ["y"], with_p=True).collect()}
    p = 2 * np.arctan(1 / np.sqrt(27)) / np.pi
    for key, sign in ((7, 1), (8, -1)):
        assert np.isclose(got[key]["beta"], 1.5 * sign) and np.isclose(got[key]["se"], 1.5 / np.sqrt(27)) and np.isclose(10 ** -got[key]["log10p"], p, rtol=1e-6)


def test_components_that_do_not_settle_raise(spark):
    _, g = panel(spark)
    with pytest.raises(ValueError, match="did not settle"):
        V.fit_pcs(g, 2, tol=1e-9, rounds=1, spare=0)


def test_null_missingness_rule(spark):
    v = spark.createDataFrame([(1, "A", "G", 40, 100, None), (2, "A", "G", 40, 100, 0.2), (3, "A", "G", 0, 0, 0.0), (4, "A", "C", 40, 100, 0.0)], "variant_id long, ref string, alt string, alt_ct long, obs_ct long, f_miss double")
    ref = spark.createDataFrame([(i, "G", "A", 0.4) for i in range(1, 5)], "variant_id long, a1 string, a2 string, a1_freq double")
    step = lambda flag: {r["variant_id"]: r["failed_step"] for r in V.variant_ladder(v, ref, 0.03, 0.01, 0.05, flag).collect()}
    assert step(True) == {1: "missingness", 2: "missingness", 3: "frequency_difference", 4: "alignment"}
    assert step(False)[1] is None


def test_components_of_few_cells(spark, few_cells):
    d, g = few_cells
    loads, scores, eigen = V.fit_pcs(g, 2)
    f = np.nanmean(d, axis=0) / 2
    z = np.nan_to_num((d - 2 * f) / np.sqrt(2 * f * (1 - f)), posinf=0.0, neginf=0.0)
    u, s, vt = np.linalg.svd(z, full_matrices=False)
    assert np.allclose(eigen, s[:2] ** 2, rtol=1e-6)
    got = scores.toPandas().sort_values("sample_id")[["pc1", "pc2"]].to_numpy()
    w = loads.toPandas().sort_values("variant_id")[["w1", "w2"]].to_numpy()
    for k in range(2):
        assert abs(got[:, k] @ u[:, k]) > 0.999 and abs(w[:, k] @ vt[k]) > 0.999


@pytest.mark.parametrize("bytes_", [300 * 8 * 2, 1 << 20])
def test_product_of_few_cells(spark, few_cells, monkeypatch, bytes_):
    """Rows end between variants, and columns are sent in batches."""
    monkeypatch.setattr(V.T, "CELLS", 64)
    monkeypatch.setattr(V.T, "LIST_BYTES", bytes_)
    d, g = few_cells
    z = np.nan_to_num(d)
    cells_ = g.where("dosage > 0").select("variant_id", "sample_id", F.col("dosage").cast("double").alias("z"))
    t = V.T.sparse_rows(g, cells_)
    x = np.random.default_rng(3).normal(size=(t.n_samples, 5))
    rows = spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)], "idx long, y array<double>")
    got = np.array([r.y for r in V.T.gram_times(t, rows, 5).orderBy("idx").collect()])
    assert t.n_samples == 300 and np.allclose(got, z @ (z.T @ x))


def test_components_that_have_many_copies(spark):
    """Forty equal panels side by side: every component occurs forty times, which is more than a block of vectors holds."""
    r = np.random.default_rng(5)
    d = r.integers(0, 3, (30, 60)).astype(float)
    rows = [(60 * c + j, 30 * c + i, int(d[i, j])) for c in range(40) for i in range(30) for j in range(60)]
    g = spark.createDataFrame(rows, "variant_id long, sample_id long, dosage int")
    loads, scores, eigen = V.fit_pcs(g, 2)
    f = d.mean(axis=0) / 2
    largest = np.linalg.svd((d - 2 * f) / np.sqrt(2 * f * (1 - f)), compute_uv=False)[0] ** 2
    assert np.allclose(eigen, [largest, largest], rtol=1e-6)
    got = V.verify_pcs(g, loads, scores, eigen).first()
    assert got.skew < 1e-6 and got.residual < 2e-4


def test_blocks_of_vectors(spark, monkeypatch):
    """Blocks hold the rows that they come from, also the last one, and sums, turns and cross products are those of the whole."""
    monkeypatch.setattr(V.T, "SPAN", 64)
    r = np.random.default_rng(6)
    x, y, turn = r.normal(size=(150, 3)), r.normal(size=(150, 3)), r.normal(size=(6, 2))
    a, b = (V.T.blocks_of(spark.createDataFrame([(i, [float(v) for v in row]) for i, row in enumerate(m)], "idx long, y array<double>"), 3) for m in (x, y))
    back = lambda t, q: np.array([row.y for row in V.T.rows_of(t, q, 150).orderBy("idx").collect()])
    assert np.array_equal(back(a, 3), x) and np.allclose(back(V.T.added_blocks(a.unionAll(b)), 3), x + y)
    wide = V.T.side_by_side([a, b])
    both = np.hstack([x, y])
    assert np.array_equal(back(wide, 6), both) and np.allclose(V.T.cross_products(wide, 6), both.T @ both) and np.allclose(back(V.T.turned(wide, turn), 2), both @ turn)


def test_cells_of_the_components_check_are_made_once(spark, monkeypatch):
    """The fit and its check read one written table of genotypes, and the check sends the fit's written scores whole."""
    from cohortloom.plans import catalog, genome

    _, g = panel(spark)
    seen, fit, verify = [], V.fit_pcs, V.verify_pcs
    monkeypatch.setattr(genome.roles, "genotypes", lambda *_: g)
    monkeypatch.setattr(genome, "table", lambda *_: g.select("sample_id").distinct())
    monkeypatch.setattr(genome.V, "fit_pcs", lambda x, *a, **k: seen.append(x) or fit(x, *a, **k))
    monkeypatch.setattr(genome.V, "verify_pcs", lambda x, *a: seen.extend([x, a[1]]) or verify(x, *a))
    row = catalog.QUERIES["V7_components_check"](spark, "").first()
    assert row.orthonormal and row.settled and row.share_is_sound
    assert seen[0].cut_path == seen[1].cut_path and seen[2].cut_path
