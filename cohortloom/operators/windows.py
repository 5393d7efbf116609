"""Top row per key, argmax, z-scores and global order. Top rows are aggregations with map-side combine, not per-key sorts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import id_sort_key


def latest_row(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The row with the largest order values (nulls last), with the number of rows of its key."""
    rest = [c for c in df.columns if c not in keys]
    out = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_r"), F.count(F.lit(1)).alias("n_records"))
    return out.select(*keys, *[F.col(f"_r.{c}").alias(c) for c in rest], "n_records")


def first_valid(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The row with the smallest order values."""
    rest = [c for c in df.columns if c not in keys]
    out = df.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("_r"))
    return out.select(*keys, *[F.col(f"_r.{c}").alias(c) for c in rest])


def earliest_in_range(df: DataFrame, keys: list[str], value: str, ts: list[str], lo: float, hi: float) -> DataFrame:
    """The earliest plausible value per key."""
    return first_valid(df.where(F.col(value).between(lo, hi)), keys, ts)


def dominant(cols: list[str], labels: list[str]) -> Column:
    """Label of the largest column; the first listed wins a tie, nulls never win."""
    n = len(cols)
    cells = F.array_compact(F.array(*[F.when(F.col(c).isNotNull(), F.struct(F.col(c).cast("double").alias("v"), F.lit(n - i).alias("o"), F.lit(x).alias("l"))) for i, (c, x) in enumerate(zip(cols, labels))]))
    return F.array_max(cells)["l"]


def zscore(df: DataFrame, col: str, mask: Column | None = None, out: str = "z", ddof: int = 1) -> DataFrame:
    """z by the mean and SD of the reference rows (all rows when no mask); null when the SD is zero."""
    mask = F.lit(True) if mask is None else mask
    sd = F.stddev_samp if ddof else F.stddev_pop
    one = df.where(mask).agg(F.avg(col).alias("_m"), sd(col).alias("_s"))
    return df.crossJoin(F.broadcast(one)).withColumn(out, F.when(F.col("_s") > 0, (F.col(col) - F.col("_m")) / F.col("_s"))).drop("_m", "_s")


def order_ids(df: DataFrame, c: str) -> DataFrame:
    """Numeric-aware order for a sink: a range-partitioned sort."""
    return df.orderBy(id_sort_key(c))


def top_k(df: DataFrame, by: str, name: str, k: int) -> DataFrame:
    """The k largest, ties by name."""
    return df.orderBy(F.col(by).desc(), F.col(name)).limit(k)
