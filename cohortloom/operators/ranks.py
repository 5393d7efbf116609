"""Ranks and exact quantiles without a one-task sort.

A value histogram collapses ties before any shuffle; value buckets cut at global quantiles bound every sort, however large a
single group is; bucket totals (a few rows per group) carry the running count from bucket to bucket.
"""

from __future__ import annotations

import math

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import numeric


BUCKET_ROWS = 5_000_000


def _splits(df: DataFrame, y: str, buckets: int) -> list[float]:
    """Fixed cut points for this run: at most `buckets` numbers reach the driver."""
    cuts = df.approxQuantile(y, [i / buckets for i in range(1, buckets)], 0.5 / buckets)
    return [-math.inf, *sorted(set(cuts)), math.inf]


def cumulative_histogram(df: DataFrame, keys: list[str], y: str, buckets: int | None = None) -> DataFrame:
    """Per key and distinct value: `n_at` rows hold it, `n_below` rows are smaller, `n_key` rows in all. Nulls are left out.

    Buckets hold about BUCKET_ROWS rows, so their number grows with the rows; buckets=1 is for values known to have few levels.
    """
    if buckets is None:
        buckets = max(8, math.ceil(df.count() / BUCKET_ROWS))
    df = df.where(F.col(y).isNotNull()).withColumn(y, F.col(y).cast("double") + F.lit(0.0))
    hist = df.groupBy(*keys, y).agg(F.count(F.lit(1)).alias("n_at"))
    if buckets > 1:
        splits = _splits(df, y, buckets)
        hist = Bucketizer(splits=splits, inputCol=y, outputCol="bucket").transform(hist) if len(splits) > 2 else hist.withColumn("bucket", F.lit(0.0))
    else:
        hist = hist.withColumn("bucket", F.lit(0.0))
    totals = hist.groupBy(*keys, "bucket").agg(F.sum("n_at").alias("in_bucket"))
    over_key = W.partitionBy(*keys)
    totals = totals.select(
        *keys,
        "bucket",
        (F.sum("in_bucket").over(over_key.orderBy("bucket")) - F.col("in_bucket")).alias("before"),
        F.sum("in_bucket").over(over_key).alias("n_key"),
    )
    inside = W.partitionBy(*keys, "bucket").orderBy(y)
    local = hist.withColumn("upto", F.sum("n_at").over(inside))
    on = [F.col(f"h.{k}").eqNullSafe(F.col(f"t.{k}")) for k in keys] + [F.col("h.bucket") == F.col("t.bucket")]
    return local.alias("h").join(totals.alias("t"), on).select(
        *[F.col(f"h.{k}").alias(k) for k in keys],
        F.col(f"h.{y}").alias(y),
        "n_at",
        (F.col("before") + F.col("upto") - F.col("n_at")).alias("n_below"),
        "n_key",
    )


def with_histogram(df: DataFrame, keys: list[str], y: str, buckets: int | None = None) -> DataFrame:
    """Rows with their value's counts; hot values are split by the adaptive skew join."""
    ch = cumulative_histogram(df, keys, y, buckets)
    rows = df.where(F.col(y).isNotNull()).withColumn(y, F.col(y).cast("double") + F.lit(0.0))
    on = [F.col(f"a.{k}").eqNullSafe(F.col(f"c.{k}")) for k in keys] + [F.col(f"a.{y}") == F.col(f"c.{y}")]
    return rows.alias("a").join(ch.alias("c"), on).select("a.*", "c.n_at", "c.n_below", "c.n_key")


def average_rank(df: DataFrame, keys: list[str], y: str, out: str = "rank", buckets: int | None = None) -> DataFrame:
    """Rank from 1, ties share their mean rank."""
    return with_histogram(df, keys, y, buckets).withColumn(out, F.col("n_below") + (F.col("n_at") + 1) / 2.0).drop("n_at", "n_below")


def average_ranks(df: DataFrame, keys: list[str], columns: dict[str, str], buckets: int | None = None) -> DataFrame:
    """Average ranks of several columns at once; every histogram is taken from the same rows, so passes do not nest."""
    out = df
    for c in columns:
        out = out.where(F.col(c).isNotNull()).withColumn(c, F.col(c).cast("double") + F.lit(0.0))
    rows = out
    for c, name in columns.items():
        ch = cumulative_histogram(rows, keys, c, buckets).alias("c")
        on = [F.col(f"a.{k}").eqNullSafe(F.col(f"c.{k}")) for k in keys] + [F.col(f"a.{c}") == F.col(f"c.{c}")]
        out = out.alias("a").join(ch, on).select("a.*", (F.col("c.n_below") + (F.col("c.n_at") + 1) / 2.0).alias(name))
    return out


def rank_normal(df: DataFrame, keys: list[str], y: str, out: str = "z", buckets: int | None = None) -> DataFrame:
    """Inverse-rank normal score: quantile of (average rank - 0.5) / n."""
    ranked = average_rank(df, keys, y, "_rank", buckets)
    return ranked.withColumn(out, numeric.normal_quantile((F.col("_rank") - 0.5) / F.col("n_key"))).drop("_rank", "n_key")


def quantiles(df: DataFrame, keys: list[str], y: str, exact: dict[str, float] | None = None, nearest: dict[str, float] | None = None, buckets: int | None = None) -> DataFrame:
    """Interpolated quantiles and observed values at position round((n - 1) * p) per key, read off one table of cumulative counts."""
    ch = cumulative_histogram(df, keys, y, buckets)
    last = F.col("n_key") - 1
    at = lambda k: F.max(F.when((F.col("n_below") <= k) & (k < F.col("n_below") + F.col("n_at")), F.col(y)))
    aggs, out = [], []
    for name, p in (exact or {}).items():
        pos = last * F.lit(float(p))
        lo, hi = F.floor(pos), F.ceil(pos)
        aggs += [at(lo).alias(f"{name}_lo"), at(hi).alias(f"{name}_hi"), F.max(pos - lo).alias(f"{name}_w")]
        out.append((F.col(f"{name}_lo") + F.col(f"{name}_w") * (F.col(f"{name}_hi") - F.col(f"{name}_lo"))).alias(name))
    for name, p in (nearest or {}).items():
        aggs.append(at(F.rint(last * F.lit(float(p)))).alias(name))
        out.append(F.col(name))
    return ch.groupBy(*keys).agg(*aggs).select(*keys, *out)


def exact_quantiles(df: DataFrame, keys: list[str], y: str, probs: dict[str, float], buckets: int | None = None) -> DataFrame:
    return quantiles(df, keys, y, exact=probs, buckets=buckets)


def nearest_rank_quantiles(df: DataFrame, keys: list[str], y: str, probs: dict[str, float], buckets: int | None = None) -> DataFrame:
    return quantiles(df, keys, y, nearest=probs, buckets=buckets)


def number_rows(df: DataFrame, order: str, out: str = "row_idx", buckets: int | None = None) -> DataFrame:
    """0-based position in the order of a unique numeric column, without one global sort task."""
    return with_histogram(df, [], order, buckets).withColumn(out, F.col("n_below")).drop("n_at", "n_below", "n_key")
