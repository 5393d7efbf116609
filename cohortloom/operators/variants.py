"""Variant quality, reference alignment, pruning, components, association and summary statistics."""

from __future__ import annotations

from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import alleles as L
from ..functions import numeric as N
from ..session import bounded_batches, cut, key_list, sent_whole, uncut
from . import aggregates as A
from . import joins as J
from . import stats
from . import tiles as T


# ladders -------------------------------------------------------------------------------------------------------------------
def variant_ladder(variants: DataFrame, ref: DataFrame, max_diff: float, min_maf: float, max_miss: float, null_missing_fails: bool = True) -> DataFrame:
    """Alignment to the reference, frequency difference, minor frequency, missingness: first step each variant fails.

    `variants` has variant_id, ref, alt, alt_ct, obs_ct, f_miss; `ref` has variant_id, a1, a2, a1_freq.
    """
    j = variants.join(ref.select("variant_id", "a1", "a2", "a1_freq"), "variant_id", "left")
    j = j.withColumn("freq", L.frequency("alt_ct", "obs_ct")).withColumn("ref_freq", L.alt_freq("a1", "a2", "ref", "alt", "a1_freq"))
    j = j.withColumn("diff", F.abs(F.col("freq") - F.col("ref_freq"))).withColumn("maf", L.minor_frequency("freq"))
    miss = F.col("f_miss") <= max_miss
    steps = [
        ("alignment", F.col("ref_freq").isNotNull()), ("frequency_difference", F.col("diff") <= max_diff), ("maf", F.col("maf") >= min_maf),
        ("missingness", miss if null_missing_fails else (miss | F.col("f_miss").isNull())),
    ]
    return A.ladder(j, steps)


LADDER_STEPS = ["alignment", "frequency_difference", "maf", "missingness"]


def presence(requested: DataFrame, present: DataFrame, key: str = "rsid") -> DataFrame:
    """Per chromosome: requested ids, found and absent."""
    j = requested.join(present.select(key).distinct().withColumn("_hit", F.lit(True)), key, "left")
    return j.groupBy("chrom").agg(F.count(F.lit(1)).alias("requested"), F.count("_hit").alias("found"), F.count_if(F.col("_hit").isNull()).alias("absent"))


def split_multiallelic(variants: DataFrame) -> DataFrame:
    """One row per ALT allele, right-trimmed, with its own id; `alt` is comma separated."""
    rows = variants.select("chrom", "pos", "ref", F.posexplode(F.split("alt", ",")).alias("allele_idx", "alt")).withColumn("t", L.right_trim("ref", "alt"))
    return rows.select("chrom", "pos", "allele_idx", F.col("t.ref").alias("ref"), F.col("t.alt").alias("alt"), L.variant_id("chrom", "pos", "t.ref", "t.alt").alias("variant_key"))


def remap_ids(variants: DataFrame, idmap: DataFrame, key: str = "variant_key") -> DataFrame:
    """Mapped id where the map knows the variant, its own key otherwise."""
    return variants.join(idmap.select(key, F.col("rsid").alias("_new")), key, "left").withColumn("id", F.coalesce("_new", key)).withColumn("mapped", F.col("_new").isNotNull()).drop("_new")


def align_reference(variants: DataFrame, ref: DataFrame) -> DataFrame:
    """Status and reference frequency in the data's allele order for every shared variant."""
    j = variants.join(ref.select("variant_id", "a1", "a2", "a1_freq"), "variant_id").withColumn("status", L.align_alleles("alt", "ref", "a1", "a2"))
    return j.withColumn("ref_freq", F.element_at(L.aligned_freqs("status", F.array("a1_freq")), 1))


def marker_subset(markers: DataFrame, variants: DataFrame, max_miss: float) -> DataFrame:
    """Flagged markers that are in the data with missingness strictly below the limit."""
    return variants.join(markers.select("rsid").distinct(), "rsid", "left_semi").where(F.col("f_miss") < max_miss)


def sequential_qc(
    genotypes: DataFrame, samples: DataFrame, variants: DataFrame, ref: DataFrame, ranges: DataFrame, max_diff: float, min_maf: float, max_geno: float, max_mind: float,
    window: int = 1000, step: int = 80, r2: float = 0.1,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Kept genotypes, the kept variants, and variants and samples left after each step; every step recounts what is left.

    Frequency difference, then minor frequency, variant missingness, sample missingness, excluded regions, pruning of correlated variants. The working
    table is cut once per axis change, so later steps do not repeat the earlier ones.
    """
    g = cut(genotypes.join(samples.select("sample_id").distinct(), "sample_id", "left_semi"))
    steps = []

    def note(name: str, table: DataFrame) -> None:
        row = table.agg(F.count_distinct("variant_id"), F.count_distinct("sample_id")).first()
        steps.append((len(steps), name, row[0], row[1]))

    note("samples", g)
    counts = A.variant_freq(g).join(A.missingness(g, "variant_id").select("variant_id", "f_miss"), "variant_id")
    j = counts.join(variants.select("variant_id", "chrom", "pos", "ref", "alt"), "variant_id").join(ref.select("variant_id", "a1", "a2", "a1_freq"), "variant_id", "left")
    near = j.where(F.abs(F.col("freq") - L.alt_freq("a1", "a2", "ref", "alt", "a1_freq")) <= max_diff)
    near = cut(near.select("variant_id", "chrom", "pos", "freq", "f_miss"))
    for name, keep in (("frequency_difference", F.lit(True)), ("maf", L.minor_frequency("freq") >= min_maf), ("geno", F.col("f_miss") <= max_geno)):
        near = near.where(keep)
        if name != "geno":
            note(name, g.join(near.select("variant_id"), "variant_id", "left_semi"))
    g = cut(g.join(near.select("variant_id"), "variant_id", "left_semi"))
    note("geno", g)
    low = A.missingness(g, "sample_id").where(F.col("f_miss") <= max_mind).select("sample_id")
    g = g.join(low, "sample_id", "left_semi")
    note("mind", g)
    outside = J.exclude_ranges(near, ranges).select("variant_id")
    g = cut(g.join(outside, "variant_id", "left_semi"))
    note("regions", g)
    seen = g.select("variant_id").distinct()
    outside = cut(ld_prune(g, near.select("variant_id", "chrom", "pos").join(seen, "variant_id", "left_semi"), window, step, r2).select("variant_id"))
    g = cut(g.join(outside, "variant_id", "left_semi"))
    note("ld_prune", g)
    log = g.sparkSession.createDataFrame(steps, "step int, name string, n_variants long, n_samples long")
    return g, outside, log


# pruning and components -------------------------------------------------------------------------------------------------------
def _ld_products(lhs: np.ndarray, rhs: np.ndarray) -> np.ndarray:
    f = lambda m: m.astype(np.float32)
    ok_l, ok_r = f(lhs >= 0), f(rhs >= 0)
    x, y = f(np.maximum(lhs, 0)), f(np.maximum(rhs, 0))
    return np.stack([ok_l @ ok_r.T, x @ ok_r.T, ok_l @ y.T, (x * x) @ ok_r.T, ok_l @ (y * y).T, x @ y.T])


def placed_tiles(genotypes: DataFrame, variants: DataFrame) -> T.Tiles:
    """Tiles whose variants stand in order of chromosome, position and id; those without a position are left out."""
    order = ("chrom", "pos", "variant_id")
    return T.pack(genotypes, variants.where(F.col("pos").isNotNull()).select(*order), order)


def placed(genotypes: DataFrame, variants: DataFrame) -> T.Tiles | T.Cells:
    """The variants in order of chromosome, position and id, as tiles or, where few cells are observed, as rows of cells."""
    genotypes = cut(genotypes.select("variant_id", "sample_id", "dosage"))
    if not T.sparse(genotypes):
        return placed_tiles(genotypes, variants)
    order = ("chrom", "pos", "variant_id")
    v = T.numbered(variants.where(F.col("pos").isNotNull()).select(*order), *order)
    at = v.join(F.broadcast(v.groupBy(F.col("chrom").alias("c_")).agg(F.min("idx").alias("c"))), F.expr("chrom <=> c_"))  # chromosomes
    rows = genotypes.where(F.col("dosage").isNotNull()).join(sent_whole(cut(at.select("variant_id", "idx", "c"))), "variant_id")
    return T.Cells(cut(rows.select("idx", "c", "sample_id", F.col("dosage").cast("tinyint").alias("dosage"))), v)


def _minor(t: T.Tiles | T.Cells) -> DataFrame:
    """idx and maf of every variant, 0 where nothing is observed."""
    if isinstance(t, T.Tiles):
        return T.variant_counts(t).select("idx", F.coalesce(L.minor_frequency("freq"), F.lit(0.0)).alias("maf"))
    freq = t.rows.groupBy("idx").agg((F.sum("dosage") / (2 * F.count(F.lit(1)))).alias("freq"))
    return t.variants.select("idx").join(freq, "idx", "left").select("idx", F.coalesce(L.minor_frequency("freq"), F.lit(0.0)).alias("maf"))


def _cell_pairs(t: T.Cells, window: int, r2: float) -> DataFrame:
    """i, j, n, r2 from pairs of observed cells of one sample and chromosome: stretches of `window` places meet themselves and the next."""
    cell = t.rows.select("sample_id", "c", "idx", "dosage", F.floor(F.col("idx") / max(window, 1)).alias("stretch"))
    a = cell.select("sample_id", "c", "stretch", F.col("idx").alias("i"), F.col("dosage").cast("long").alias("x"))
    b = cell.select("sample_id", "c", F.explode(F.array("stretch", F.col("stretch") - 1)).alias("stretch"), F.col("idx").alias("j"), F.col("dosage").cast("long").alias("y"))
    both = a.join(b, ["sample_id", "c", "stretch"]).where((F.col("j") > F.col("i")) & (F.col("j") - F.col("i") <= window))
    x, y, n = F.col("x"), F.col("y"), F.col("n")
    terms = {"n": F.lit(1), "sx": x, "sy": y, "sxx": x * x, "syy": y * y, "sxy": x * y}
    both = both.select((F.col("i") * (window + 1) + F.col("j") - F.col("i")).alias("at"), "x", "y")
    sums = T.added(both, ["at"], terms, 4 * T.most_cells(t.rows, "idx")).withColumn("i", F.floor(F.col("at") / (window + 1))).withColumn("j", F.col("i") + F.pmod("at", F.lit(window + 1)))
    of = lambda a, b, ab: (n * F.col(ab) - F.col(a) * F.col(b)).cast("double")
    sums = sums.where(n > 1).select("i", "j", "n", of("sx", "sy", "sxy").alias("cov"), of("sx", "sx", "sxx").alias("vx"), of("sy", "sy", "syy").alias("vy"))
    cov = F.col("cov")
    return sums.where("vx > 0 AND vy > 0").select("i", "j", "n", (cov * cov / (F.col("vx") * F.col("vy"))).alias("r2")).where(F.col("r2") > r2)


def ld_pairs(genotypes: DataFrame | T.Tiles | T.Cells, variants: DataFrame | None, window: int, r2: float, wide: int = 4, chunks: int | None = None) -> DataFrame:
    """Variant pairs of one chromosome at most `window` places apart whose squared correlation is above the limit: variant_i, variant_j, i, j, n, r2.

    Places are counted in order of position. A super-block of variants meets itself and the next ones as far as the window reaches. Where few cells
    are observed, only variants that meet in a sample are paired at all.
    """
    t = placed(genotypes, variants) if isinstance(genotypes, DataFrame) else genotypes
    if isinstance(t, T.Cells):
        return _named_pairs(t, _cell_pairs(t, window, r2))
    grid = T.grid_of(t.n_variants, wide)

    def finish(i: np.ndarray, j: np.ndarray, sums: np.ndarray) -> dict:
        n, sx, sy, sxx, syy, sxy = sums
        with np.errstate(all="ignore"):
            cov, vx, vy = n * sxy - sx * sy, n * sxx - sx * sx, n * syy - sy * sy
            value = cov * cov / (vx * vy)
        ok = (n > 1) & (vx > 0) & (vy > 0) & (value > r2) & (j > i) & (j - i <= window)
        return {"i": i[ok], "j": j[ok], "n": n[ok].astype(np.int64), "r2": value[ok]}

    reach = -(-window // (grid.wide * T.TILE))
    pairs = T.pair_sums(t, "variants", grid, reach, 6, _ld_products, finish, "i long, j long, n long, r2 double", chunks)
    return _named_pairs(t, pairs)


def _named_pairs(t: T.Tiles | T.Cells, pairs: DataFrame) -> DataFrame:
    """Ids and chromosome of the pairs' variants; those of two chromosomes go."""
    ids = sent_whole(cut(t.variants.select("idx", "variant_id", "chrom")))
    side = lambda x, c: ids.select(F.col("idx").alias(x), F.col("variant_id").alias(f"variant_{x}"), F.col("chrom").alias(c))
    return pairs.join(side("i", "c"), "i").join(side("j", "d"), "j").where("c <=> d").select("variant_i", "variant_j", "i", "j", F.col("c").alias("chrom"), "n", "r2")


def ld_prune(genotypes: DataFrame | T.Tiles | T.Cells, variants: DataFrame, window: int = 1000, step: int = 80, r2: float = 0.1, ranges: int = 64) -> DataFrame:
    """Variants left by a greedy pass over windows of `window` variants that move on by `step`.

    In each window, pairs of variants that are still there are looked at in order; if their squared correlation is above the limit the one with the smaller
    minor frequency goes, the later one of equals. A pair is looked at in the first window that holds both. Windows are cut into ranges of
    at least `ranges` windows. Every range runs the pass by itself, then hands the variants gone from its last windows to the range after it; ranges that got
    something new run again, until nothing new is handed over. A range is right as soon as the one before it is, so the result is that of one pass from
    the first window to the last; in practice a border is forgotten after a few windows.
    """
    t = placed(genotypes, variants) if isinstance(genotypes, DataFrame) else genotypes
    freq = cut(_minor(t))
    starts = t.variants.groupBy(F.col("chrom").alias("c")).agg(F.min("idx").alias("start"))  # chromosomes
    span = max(ranges, -(-window // step) + 1)
    pairs = ld_pairs(t, None, window - 1, r2).select("i", "j", "chrom")
    e = pairs.join(F.broadcast(starts), F.expr("chrom <=> c")).drop("chrom", "c")
    nth = F.greatest(F.lit(0), F.ceil((F.col("j") - F.col("start") - window + 1) / step)).cast("long")
    e = e.withColumn("k", nth).where(F.col("start") + F.col("k") * step <= F.col("i"))
    small = sent_whole(freq)
    e = e.join(small.select(F.col("idx").alias("i"), F.col("maf").alias("mi")), "i").join(small.select(F.col("idx").alias("j"), F.col("maf").alias("mj")), "j")
    part = F.floor(F.col("k") / span)
    e = cut(e.select((F.col("start") + part * span * step).alias("at"), (F.col("start") + (part + 1) * span * step).alias("next"), "k", "i", "j", F.when(F.col("mi") < F.col("mj"), F.col("i")).otherwise(F.col("j")).alias("goes")))
    known = cut(e.select("at").distinct())

    def run(pairs_: pd.DataFrame, gone_: pd.DataFrame) -> pd.DataFrame:
        gone = set(gone_.idx)
        if not len(pairs_):
            return pd.DataFrame({"at": [], "next": [], "idx": []})
        pairs_ = pairs_.sort_values(["k", "i", "j"])
        for i, j, goes in zip(pairs_.i.tolist(), pairs_.j.tolist(), pairs_.goes.tolist()):
            if i not in gone and j not in gone:
                gone.add(goes)
        return pd.DataFrame({"at": pairs_["at"].iloc[0], "next": pairs_["next"].iloc[0], "idx": sorted(gone)})

    schema = "at long, next long, idx long"
    handed = variants.sparkSession.createDataFrame([], "at long, idx long")
    gone, todo = None, known
    while True:
        fresh = e.join(todo, "at", "left_semi").groupBy("at").cogroup(handed.groupBy("at")).applyInPandas(run, schema)
        spent = gone
        gone = cut(fresh if gone is None else gone.join(todo, "at", "left_anti").unionByName(fresh))
        uncut(spent)
        now = cut(gone.where("idx >= next").select(F.col("next").alias("at"), "idx").join(known, "at", "left_semi"))
        todo = cut(now.exceptAll(handed).unionByName(handed.exceptAll(now)).select("at").distinct())
        handed = now
        if todo.isEmpty():
            break
    out = t.variants.select("idx", "variant_id").join(gone.select("idx").distinct(), "idx", "left_anti")
    return variants.join(out.select("variant_id"), "variant_id", "left_semi")


def standardized_dosage(genotypes: DataFrame, freq: DataFrame) -> DataFrame:
    """(g - 2f) / sqrt(2f(1-f)) for observed dosages of polymorphic variants."""
    f = F.col("freq")
    j = genotypes.where(F.col("dosage").isNotNull()).join(freq.where((f > 0) & (f < 1)).select("variant_id", "freq"), "variant_id")
    return j.select("variant_id", "sample_id", ((F.col("dosage") - 2 * f) / F.sqrt(2 * f * (1 - f))).alias("z"))


def _whitening(gram: np.ndarray, least: float) -> np.ndarray:
    """Turns columns with these cross products into orthonormal ones; directions that are nearly without length are left out."""
    scale = 1 / np.sqrt(np.maximum(np.diag(gram), 1e-300))
    values, vectors = np.linalg.eigh(gram * np.outer(scale, scale))
    some = values > least * max(values[-1], 1e-300)
    return scale[:, None] * vectors[:, some] / np.sqrt(values[some])


def _best(gram: np.ndarray, basis: np.ndarray, image: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """What a space holds of a matrix' components, largest first: values, the components and their images as turns of the columns with the cross products
    `gram`, and lengths of the residuals. basis, image: a basis and what the matrix makes of it, as turns of those columns."""
    own = _whitening(basis.T @ gram @ basis, least)
    small = own.T @ (basis.T @ gram @ image) @ own
    values, vectors = np.linalg.eigh((small + small.T) / 2)
    values, turn = np.maximum(values[::-1], 0), own @ vectors[:, ::-1]
    left = image @ turn - basis @ turn * values
    return values, basis @ turn, image @ turn, np.sqrt(np.maximum(np.einsum("ij,ik,kj->j", left, gram, left), 0))


STEPS = 8  # products of a round
KEPT = 24  # components beside the block's that go on to the next round
DRIFT = 1e-8  # of the largest value: where kept images are off by more, the kept components are left out


def fit_pcs(genotypes: DataFrame, k: int, tol: float = 1e-4, rounds: int = 60, seed: int = 7, spare: int = 2) -> tuple[DataFrame, DataFrame, list[float]]:
    """Leading components of the standardized dosages: loadings per variant (w1..wk and freq), scores per sample, eigenvalues.

    A random block of k + spare vectors over the samples is run through Z Z' some times; its Chebyshev polynomials, the vectors of the block and the best components
    of earlier rounds span the space from which the best components are taken, as in a restarted block Lanczos method: copies of a component are found as long as the
    block has as many vectors, however many there are. It ends when |Z Z'u - lambda u| <= tol * lambda for each of the k, by a product with u itself, and raises
    if that is not so after `rounds` rounds. Tables keep the vectors of one round; each product passes over the matrix, as tiles or, where few cells
    are observed, as rows of cells, and what is sent by it grows with the samples.
    """
    bounded_batches(genotypes.sparkSession)
    q = k + spare
    if getattr(genotypes, "cut_path", None) is None:
        genotypes = cut(genotypes.select("variant_id", "sample_id", "dosage"))
    few = T.sparse(genotypes)
    if few:
        freq = cut(A.variant_freq(genotypes).select("variant_id", "freq"))
        cells = cut(standardized_dosage(genotypes, freq))
        matrix = T.sparse_rows(genotypes, cells)
        samples, n = matrix.samples.select("idx", "sample_id"), matrix.n_samples
        product = lambda x, width: T.gram_parts(matrix, x, width)
    else:
        tiles = T.pack(genotypes)
        z = T.standardize(tiles)
        samples, n = tiles.samples.select("idx", "sample_id"), tiles.n_samples
        product = lambda x, width: T.blocks_of(T.times(z, T.times(z, T.rows_of(x, width, n), "samples", width), "variants", width), width)

    def with_product(x: DataFrame, width: int, more: list[DataFrame], n_more: int) -> DataFrame:
        """x, beside it what the matrix makes of it, and n_more columns."""
        eye = np.eye(2 * width + n_more)
        parts = [T.turned(x, eye[:width]), T.turned(product(x, width), eye[width:2 * width]), *(T.turned(m, eye[2 * width:]) for m in more)]
        return cut(T.added_blocks(reduce(DataFrame.unionAll, parts)))

    noise = [F.pmod(F.xxhash64(F.lit(seed), F.lit(i), "sample_id"), F.lit(2001)) / 1000.0 - 1.0 for i in range(q)]
    block = cut(T.blocks_of(samples.select("idx", F.array(*noise).alias("y")), q))
    white = _whitening(T.cross_products(block, q), 1e-12)
    q = white.shape[1]
    even = cut(T.turned(block, white))
    uncut(block)
    state, n_kept, low = with_product(even, q, [], 0), 0, 0.0  # columns: block, its image, kept components, their images
    uncut(even)
    for _ in range(rounds):
        width = 2 * (q + n_kept)
        eye = np.eye(width)
        gram = T.cross_products(state, width)
        values, best, _, left = _best(gram, eye[:, :q], eye[:, q:2 * q], 1e-12)
        lam, left = values[:k], left[:k]
        if (left <= tol * np.maximum(lam, 1e-300)).all():
            break
        # images of kept components were put together from others, round after round; the matrix is symmetric, and so they have to be
        both = np.hstack([eye[:, :q], eye[:, 2 * q:2 * q + n_kept]]).T @ gram @ np.hstack([eye[:, q:2 * q], eye[:, 2 * q + n_kept:]])
        used = n_kept if np.abs(both - both.T).max() <= DRIFT * values[0] else 0
        high = values[0] + left[0]
        half, mid = max((high - low) / 2, 1e-8 * high, 1e-300), (high + low) / 2
        polys: list[DataFrame] = []
        first = np.zeros((width, 2 * q))  # the block and its first polynomial
        first[:q, :q], first[:q, q:], first[q:2 * q, q:] = np.eye(q), -mid / half * np.eye(q), np.eye(q) / half
        before, now = T.turned(state, first[:, :q]), cut(T.turned(state, first[:, q:]))
        one = now
        for _ in range(STEPS - 1):
            terms = [T.turned(product(now, q), 2 / half * np.eye(q)), T.turned(now, -2 * mid / half * np.eye(q)), T.turned(before, -np.eye(q))]
            polys.append(cut(T.added_blocks(reduce(DataFrame.unionAll, terms))))
            before, now = now, polys[-1]
        uncut(one)
        wide = cut(T.side_by_side([state, *polys]))
        for x in (state, *polys):
            uncut(x)
        width += q * len(polys)
        eye = np.eye(width)
        own = [eye[:, :q], np.vstack([first[:, q:], np.zeros((width - len(first), q))]), *(eye[:, width - q * m:][:, :q] for m in range(len(polys), 0, -1))]
        images = [eye[:, q:2 * q], *(mid * own[j] + half / 2 * (own[j - 1] + own[j + 1]) for j in range(1, len(own) - 1))]
        basis = np.hstack([*own[:-1], eye[:, 2 * q:2 * q + used]])
        image = np.hstack([*images, eye[:, 2 * q + n_kept:2 * q + n_kept + used]])
        gram = T.cross_products(wide, width)
        _, best, made, _ = _best(gram, basis, image, 1e-8)
        low = 0.9 * _best(gram, basis, image, 1e-6)[0][-1]
        q = min(q, best.shape[1])
        n_kept = min(KEPT, best.shape[1] - q)
        even, rest = cut(T.turned(wide, best[:, :q])), T.turned(wide, np.hstack([best[:, q:q + n_kept], made[:, q:q + n_kept]]))
        state = with_product(even, q, [rest] if n_kept else [], 2 * n_kept)
        uncut(even)
        uncut(wide)
    else:
        raise ValueError(f"components did not settle in {rounds} rounds: residuals {left / np.maximum(lam, 1e-300)}")
    v = best[:, :k]
    u = cut(T.turned(state, v * np.sign(v[np.abs(v).argmax(axis=0), range(len(lam))])))
    uncut(state)
    found = T.rows_of(u, len(lam), n)
    scores = cut(found.join(samples, "idx").select("sample_id", *[F.get("y", F.lit(i)).alias(f"pc{i + 1}") for i in range(len(lam))]))
    root = [F.lit(float(np.sqrt(max(x, 1e-300)))) for x in lam]
    if few:
        sums = cells.join(sent_whole(scores), "sample_id").groupBy("variant_id").agg(*[F.sum(F.col("z") * F.col(f"pc{i + 1}")).alias(f"s{i}") for i in range(len(lam))])
        loadings = freq.join(sums, "variant_id", "left").select("variant_id", "freq", *[(F.coalesce(f"s{i}", F.lit(0.0)) / x).alias(f"w{i + 1}") for i, x in enumerate(root)])
    else:
        made = T.times(z, found, "samples", len(lam))
        loadings = made.join(z.freq, "idx").select("variant_id", "freq", *[(F.get("y", F.lit(i)) / x).alias(f"w{i + 1}") for i, x in enumerate(root)])
    return loadings, scores, [float(x) for x in lam]


def verify_pcs(genotypes: DataFrame, loadings: DataFrame, scores: DataFrame, eigen: list[float]) -> DataFrame:
    """One row from the cells themselves: total (sum of squared cells), share of the components, largest departure from orthonormal scores and largest
    residual |Z Z'u - lambda u| / lambda."""
    k = len(eigen)
    freq = A.variant_freq(genotypes).select("variant_id", "freq")
    z = cut(standardized_dosage(genotypes, freq))
    scores = cut(scores) if getattr(scores, "cut_path", None) is None else scores
    pcs, made = [f"pc{i + 1}" for i in range(k)], [f"y{i + 1}" for i in range(k)]
    by_variant = z.join(sent_whole(scores), "sample_id").groupBy("variant_id").agg(*[F.sum(F.col("z") * F.col(p)).alias(p) for p in pcs])
    again = z.join(by_variant, "variant_id").groupBy("sample_id").agg(*[F.sum(F.col("z") * F.col(p)).alias(y) for p, y in zip(pcs, made)])
    rows = scores.join(again, "sample_id", "left").na.fill(0.0, made)
    gram = [F.abs(F.sum(F.col(pcs[i]) * F.col(pcs[j])) - (1.0 if i == j else 0.0)) for i in range(k) for j in range(i, k)]
    left = [F.sqrt(F.sum((F.col(y) - F.lit(x) * F.col(p)) ** 2)) / F.lit(x) for p, y, x in zip(pcs, made, eigen)]
    total = z.agg(F.sum(F.col("z") * F.col("z")).alias("total"))
    checks = rows.agg(F.greatest(*gram, F.lit(0.0)).alias("skew"), F.greatest(*left, F.lit(0.0)).alias("residual"))
    return total.join(checks).select("total", (F.lit(float(sum(eigen))) / F.col("total")).alias("share"), "skew", "residual")  # two single rows


def project_pcs(genotypes: DataFrame, loadings: DataFrame, k: int) -> DataFrame:
    """Scores of all samples by the fit set's loadings and frequencies: sum of z w over observed alleles, nothing imputed."""
    w = key_list(loadings.where((F.col("freq") > 0) & (F.col("freq") < 1)))
    z = (F.col("dosage") - 2 * F.col("freq")) / F.sqrt(2 * F.col("freq") * (1 - F.col("freq")))
    rows = genotypes.where(F.col("dosage").isNotNull()).join(w, "variant_id").withColumn("z", z)
    n = F.count(F.lit(1)) * 2
    return rows.groupBy("sample_id").agg(n.alias("n_alleles"), *[(F.sum(F.col("z") * F.col(f"w{i + 1}")) / n).alias(f"pc{i + 1}") for i in range(k)])


# association --------------------------------------------------------------------------------------------------------------------
def _cell_sums(cells: DataFrame, traits: DataFrame, names: list[str]) -> DataFrame:
    """As `tiles.trait_sums`, one row per cell, added up before the shuffle."""
    values = traits.select("sample_id", *[F.col(f"`{n}`").cast("double").alias(f"y{k}") for k, n in enumerate(names)])
    g = F.col("dosage").cast("double")
    parts = []
    for k in range(len(names)):
        y = F.when(~F.isnan(f"y{k}"), F.col(f"y{k}"))
        there = F.when(y.isNotNull(), g)
        parts.append({"n": F.count(y), "g": F.sum(there), "gg": F.sum(there * g), "s": F.sum(y), "yy": F.sum(y * y), "gy": F.sum(g * y)})
    wide = cells.join(values, "sample_id").groupBy("variant_id").agg(*[c.alias(f"{n}{k}") for k, p in enumerate(parts) for n, c in p.items()])
    rows = [F.struct(F.lit(k).alias("trait"), *[F.col(f"{n}{k}").alias(n) for n in p]) for k, p in enumerate(parts)]
    return wide.select("variant_id", F.explode(F.array(*rows)).alias("r")).select("variant_id", "r.*").where(F.col("n") > 0)


def associate(genotypes: DataFrame | T.Tiles, traits: DataFrame, names: list[str], with_p: bool = False, batch: int = 64) -> DataFrame:
    """Covariate-free regression of residual traits on every variant.

    `traits` is wide: sample_id and one column per name, null where missing. Genotypes are packed once; batches of at most `batch` traits, fewer where their values
    could not be sent whole, are multiplied with the tiles. Where few cells are observed they stay rows. Any number of traits may be given.
    """
    tiles, cells = genotypes, None
    if not isinstance(genotypes, T.Tiles):
        genotypes = cut(genotypes.select("variant_id", "sample_id", "dosage"))
        if T.sparse(genotypes):
            cells = genotypes.where(F.col("dosage").isNotNull())
        else:
            tiles = T.pack(genotypes)
    size = min(batch, 8) if cells is not None else T.traits_at_once(tiles.n_samples, batch)
    t = None
    for at in range(0, len(names), size):
        some = names[at:at + size]
        sums = (T.trait_sums(tiles, traits, some) if cells is None else _cell_sums(cells, traits, some)).withColumn("pheno_id", F.element_at(F.array(*map(F.lit, some)), F.col("trait") + 1)).drop("trait")
        t = sums if t is None else t.unionByName(sums)
    n = F.col("n")
    t = t.withColumn("sxx", F.col("gg") - F.col("g") * F.col("g") / n).withColumn("sxy", F.col("gy") - F.col("g") * F.col("s") / n).withColumn("syy", F.col("yy") - F.col("s") * F.col("s") / n)
    t = t.withColumn("beta", F.when(F.col("sxx") > 1e-9, F.col("sxy") / F.col("sxx")))
    t = t.withColumn("se", F.when((n > 2) & (F.col("sxx") > 1e-9), F.sqrt(F.greatest(F.col("syy") - F.col("beta") * F.col("sxy"), F.lit(0.0)) / (n - 2) / F.col("sxx"))))
    out = t.select("variant_id", "pheno_id", "n", (F.col("g") / (2 * n)).alias("a1freq"), "beta", "se")
    return out.withColumn("log10p", -stats.log10_p(F.col("beta"), F.col("se"), (n - 2).cast("double"))) if with_p else out


def lightweight(sumstats: DataFrame) -> DataFrame:
    """The columns of a light summary table, with -log10 p."""
    return sumstats.select("rsid", "chrom", "pos", "allele1", "a1freq", "n", "beta", "se", N.neg_log10("p").alias("log10p"))


def harmonize_stats(sumstats: DataFrame, ref: DataFrame) -> DataFrame:
    """Effects for the reference's first allele: the sign turns when the data counted the second one; others are mismatches."""
    j = sumstats.join(ref.select("rsid", F.col("allele1").alias("r1"), F.col("allele2").alias("r2")), "rsid", "left")
    status = F.when(F.col("r1").isNull(), "missing").when(F.col("allele1") == F.col("r1"), "same").when(F.col("allele1") == F.col("r2"), "flipped").otherwise("mismatch")
    return j.withColumn("status", status).withColumn("beta", F.when(F.col("status") == "same", F.col("beta")).when(F.col("status") == "flipped", -F.col("beta"))).drop("r1", "r2")


def assert_harmonized(stats_: DataFrame) -> None:
    bad = stats_.where("status = 'mismatch'").limit(3).collect()
    if bad:
        raise ValueError(f"alleles do not match the reference: {[x['rsid'] for x in bad]}")


