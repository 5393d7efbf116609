"""Quality rules by robust multivariate outliers: minimum-covariance-determinant estimates per language and source.

Counts of each whole text come from one Python pass; everything after it is Spark aggregation over a table of a few numbers per
document. Six transformed statistics are stored as integers in 1/1024 steps, so that sums do not depend on the order of the rows. The
estimate of a group starts from medians and quartiles and takes concentration steps: rows within the distance that holds 3/4 of
the group give the next mean and covariance, until the determinant falls no further. Quantiles are read from counts of a bounded
number of steps, moments are sums with map-side combine: a group may hold any part of the rows.

Defined cases: a null text counts nothing and fails the base rules; a null language or source is a value of its own; groups under
`min_rows` usable documents are pooled by language, pools under it over all, and where that is too small as well the verdict is to
keep; equal statistics get equal verdicts; repeated rows count each time; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut, spent
from .common import having, text_key

SYMBOLS = "#*$%&|<>"
STATS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_caps long, n_marks long, n_distinct long"
UNIT = 1024
DIMS = 6


def repeated_words(words: list[bytes]) -> tuple[int, int]:
    """Words in windows of three that occur twice or more, and distinct words."""
    n, ids = len(words), {}
    code = np.fromiter((ids.setdefault(w, len(ids)) for w in words), np.int64, n)
    if n < 4:
        return 0, len(ids)
    pair = code[:-1] * len(ids) + code[1:]
    if len(ids) ** 3 >= 2**62:
        pair = np.unique(pair, return_inverse=True)[1]
    _, place, times = np.unique(pair[:-1] * len(ids) + code[2:], return_inverse=True, return_counts=True)
    start = np.flatnonzero(times[place] > 1)
    hit = np.zeros(n, bool)
    for k in range(3):
        hit[start + k] = True
    return int(hit.sum()), len(ids)


def text_stats(text: str | None) -> tuple[int, ...]:
    text = text or ""
    raw = text.encode()
    words = raw.split()  # bytes split at ASCII white space only
    seen, twice = set(), 0
    for line in raw.split(b"\n"):
        if line in seen:
            twice += bool(line.strip())
        else:
            seen.add(line)
    repeats, distinct = repeated_words(words)
    return (
        len(words), len(text) - sum(map(text.count, " \t\n\v\f\r")), sum(map(text.count, SYMBOLS)), twice, repeats,
        len(raw) - len(raw.translate(None, b"ABCDEFGHIJKLMNOPQRSTUVWXYZ")), len(raw) - len(raw.translate(None, b".,;:!?")), distinct,
    )


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [text_stats(t.as_py()) for t in batch.column("text")]
        cols = list(zip(*rows)) if rows else [()] * 8
        names = [x.split()[0] for x in STATS.split(", ")]
        own = ["doc_id", "lang", "source", "text_key"]
        yield pa.RecordBatch.from_arrays([batch.column(c) for c in own] + [pa.array(c, pa.int64()) for c in cols], names=[*own, *names])


def count_stats(docs: DataFrame) -> DataFrame:
    d = docs.select("doc_id", F.col("lang").cast("string").alias("lang"), F.col("source").cast("string").alias("source"), text_key().alias("text_key"), F.col("text").cast("string").alias("text"))
    return d.mapInArrow(_count, f"doc_id {dict(d.dtypes)['doc_id']}, lang string, source string, text_key long, {STATS}")


def base_failed():
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def _steps(c):
    return F.round(c * UNIT).cast("long")


def features(stats: DataFrame) -> DataFrame:
    """x0..x5: log of the words, log of word length, of symbols, capitals and marks per 100 letters, repeated share. All below 32."""
    n, chars = F.greatest("n_words", F.lit(1)), F.greatest("word_chars", F.lit(1))
    per = lambda c: F.log1p(100 * F.col(c) / chars)
    x = [F.log(n), 4 * F.log(chars / n), per("n_symbols"), per("n_caps"), per("n_marks"), 3 * F.col("n_repeat_words") / n]
    return stats.withColumns({f"x{i}": _steps(c) for i, c in enumerate(x)})


def estimation_groups(stats: DataFrame, min_rows: int) -> DataFrame:
    """Per language and source the group g whose estimate counts: its own, its language's small ones pooled, or all small ones pooled; null under min_rows."""
    t = stats.groupBy("lang", "source").agg(F.count(F.lit(1)).alias("n"))
    own = F.col("n") >= min_rows
    pool = F.sum(F.when(own, 0).otherwise(F.col("n"))).over(Window.partitionBy("lang"))
    t = t.withColumn("level", F.when(own, 0).when(pool >= min_rows, 1).otherwise(2))
    rest = t.where("level = 2").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    g = F.when(F.col("level") == 0, F.to_json(F.struct("lang", "source"))).when(F.col("level") == 1, F.to_json(F.struct("lang", F.lit("*").alias("pool"))))
    return t.select("lang", "source", (g if rest < min_rows else F.coalesce(g, F.lit("*"))).alias("g"))


def _solve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Mean, whitening rows and log determinant of each group from its integer sums; the floor keeps constant statistics invertible."""
    for b in batches:
        out = []
        for g, n, s, q in zip(b.g, b.n, b.s, b.q):
            m = np.array(s, float) / n / UNIT
            cov = np.zeros((DIMS, DIMS))
            cov[np.triu_indices(DIMS)] = np.array(q, float) / n / UNIT**2
            cov = cov + np.triu(cov, 1).T - np.outer(m, m) + np.diag(np.full(DIMS, FLOOR))
            w = np.linalg.inv(np.linalg.cholesky(cov))
            out.append((g, m.tolist(), w[np.tril_indices(DIMS)].tolist(), float(-2 * np.log(np.diag(w)).sum())))
        yield pd.DataFrame(out, columns=["g", "mean", "white", "logdet"])


#: Variance added to each statistic: differences under about a tenth of a log unit are never outlying by themselves.
FLOOR = 0.01


def _distance():
    """Squared distance: whitened coordinates, six small dot products inside generated code."""
    total = F.lit(0.0)
    for i in range(DIMS):
        y = F.lit(0.0)
        for j in range(i + 1):
            y = y + F.col("white")[i * (i + 1) // 2 + j] * (F.col(f"x{j}") / UNIT - F.col("mean")[j])
        total = total + y * y
    return total


BINS = 32  # per doubling of the squared distance


def _bin(d2):
    return F.floor(F.log2(F.greatest(d2, F.lit(1e-6))) * BINS).cast("long")


def _quantile_bin(rows: DataFrame, share: float) -> DataFrame:
    """Histogram bin within which `share` of the group's rows lie. The exact percentile keeps counts of distinct bins, whose number is bounded."""
    return rows.groupBy("g").agg(F.ceil(F.percentile("bin", share)).alias("edge"))


def _start(rows: DataFrame) -> DataFrame:
    """Medians and quartile ranges, of statistics in 1/32 steps for the same reason."""
    quarter = [F.percentile(F.floor(F.col(f"x{i}") / 32), F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75))) for i in range(DIMS)]
    mid = rows.groupBy("g").agg(F.array(*quarter).alias("c"))
    sd = lambda i: (F.col("c")[i][2] - F.col("c")[i][0]) * 32 / UNIT / 1.349
    white = F.array(*[(1 / F.sqrt(sd(i) ** 2 + FLOOR)) if i == j else F.lit(0.0) for i in range(DIMS) for j in range(i + 1)])
    mean = F.array(*[(F.col("c")[i][1] * 32 + 16) / UNIT for i in range(DIMS)])
    return mid.select("g", mean.alias("mean"), white.alias("white"), F.lit(1e9).alias("logdet"))


def mcd(rows: DataFrame, share: float = 0.75) -> DataFrame:
    """Mean and whitening of each group g of rows (g, x0..x5), with `scale`: the factor that brings the distances' median to that of normal data.

    A group is settled once its determinant falls by less than 1 %; the loop ends when all are. The floor bounds determinants from
    below, so it does end.
    """
    params = cut(_start(rows)).withColumn("settled", F.lit(False))
    sums = [F.sum(f"x{i}") for i in range(DIMS)]
    squares = [F.sum(F.col(f"x{i}") * F.col(f"x{j}")) for i in range(DIMS) for j in range(i, DIMS)]
    while True:
        live = params.where("not settled")
        near = rows.join(live, "g").select("g", *[f"x{i}" for i in range(DIMS)], _bin(_distance()).alias("bin"))
        edge = cut(_quantile_bin(near, share))
        core = near.join(edge, "g").where("bin <= edge")
        moments = core.groupBy("g").agg(F.count(F.lit(1)).alias("n"), F.array(*sums).alias("s"), F.array(*squares).alias("q"))
        new = moments.mapInPandas(_solve, "g string, mean array<double>, white array<double>, logdet double")
        old = params.select("g", F.struct("mean", "white", "logdet").alias("o"), F.col("settled").alias("was"))
        both = old.join(new.select("g", F.struct("mean", "white", "logdet").alias("n")), "g", "left")
        better = F.coalesce(F.col("n.logdet") < F.col("o.logdet") - 0.01, F.lit(False)) & ~F.col("was")
        params = cut(both.select("g", F.when(better, F.col("n")).otherwise(F.col("o")).alias("p"), (~better).alias("settled")).select("g", "p.*", "settled"))
        if params.where("not settled").isEmpty():
            break
    half = _quantile_bin(rows.join(params, "g").select("g", _bin(_distance()).alias("bin")), 0.5)
    return cut(params.join(half, "g").select("g", "mean", "white", (F.pow(F.lit(2.0), (F.col("edge") + 1) / BINS) / (DIMS * (1 - 2 / (9 * DIMS)) ** 3)).alias("scale")))  # the chi-squared median


def judge(docs: DataFrame, min_rows: int = 100, far: float = 22.0) -> DataFrame:
    """One row per document: the counts, base_failed, distance (squared, scaled; null where no estimate exists) and kept.

    Documents that pass the base rules are kept unless their distance is beyond `far` robust standard deviations. Text statistics have
    heavier tails than normal ones; sound documents reach some 18, shouted, symbol-ridden or babbled ones start at about 29.
    """
    stats = cut(count_stats(docs)).withColumn("base_failed", base_failed())
    usable = stats.where("not base_failed")
    groups = cut(estimation_groups(usable, min_rows))
    rows = features(usable).join(groups.where("g is not null"), usable["lang"].eqNullSafe(groups["lang"]) & usable["source"].eqNullSafe(groups["source"]))
    params = mcd(cut(rows.select("g", *[f"x{i}" for i in range(DIMS)])))
    known = groups.join(params, "g").select(F.col("lang").alias("l"), F.col("source").alias("s"), "mean", "white", "scale")
    f = features(stats)
    seen = f.join(known, f["lang"].eqNullSafe(known["l"]) & f["source"].eqNullSafe(known["s"]), "left")
    distance = _distance() / F.col("scale")
    out = seen.withColumn("distance", distance).withColumn("kept", ~F.col("base_failed") & F.coalesce(F.col("distance") <= far**2, F.lit(True)))
    return out.select(*stats.columns, "distance", "kept")


def accept(docs: DataFrame, **options) -> DataFrame:
    """The documents that are kept, all columns; rows equal in id and text share one fate."""
    with spent(keep=(keep := [])):
        keep.append(cut(judge(docs, **options).where("not kept").select("doc_id", "text_key").distinct()))
    return having(docs, keep[0], "left_anti")
