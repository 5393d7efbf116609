"""Partitioned outputs, id maps, metric tables, pending work, wide batches, fingerprints."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import alleles as A
from ..operators import ranks
from ..session import cut
from .tables import require_unique


def write_compact(stats: DataFrame, reference: DataFrame, path: str, key: str = "rsid") -> None:
    """Reference columns once, per trait only beta, se and n as narrow types; traits are directories, variants sorted inside."""
    ref = reference.select(key, F.col("chrom"), F.col("pos").cast("int"), "allele1", "allele2", F.col("a1freq").cast("float"))
    ref.repartitionByRange("chrom", "pos").sortWithinPartitions("chrom", "pos").write.mode("overwrite").parquet(f"{path}/reference", compression="zstd")
    slim = stats.select("pheno_id", key, F.col("beta").cast("float"), F.col("se").cast("float"), F.col("n").cast("int"))
    _split(cut(slim), "pheno_id", [key]).sortWithinPartitions("pheno_id", key).write.mode("overwrite").partitionBy("pheno_id").parquet(f"{path}/traits", compression="zstd")


FILE_ROWS = 5_000_000


def _split(rows: DataFrame, by: str, spread: list[str]) -> DataFrame:
    """Rows dealt out so that each key value has one file per FILE_ROWS rows, and no task has more of one value than that."""
    files = rows.groupBy(by).agg(F.ceil(F.count(F.lit(1)) / FILE_ROWS).alias("_files")).withColumnRenamed(by, "_by")
    dealt = rows.join(files, rows[by].eqNullSafe(files["_by"])).withColumn("_file", F.pmod(F.xxhash64(*spread), F.col("_files")))
    return dealt.repartition(by, "_file").drop("_by", "_files", "_file")


def write_partitioned(df: DataFrame, path: str, by: str) -> DataFrame:
    """Compressed tab-separated files, one directory per key value; returns counts in and out and fails when they differ."""
    spark: SparkSession = df.sparkSession
    df = cut(df)  # evaluated once: for the files and for the counts
    _split(df, by, df.columns).write.mode("overwrite").partitionBy(by).option("compression", "gzip").csv(path, sep="\t", header=True)
    back = spark.read.csv(path, sep="\t", header=True)
    n_in = df.groupBy(F.col(by).cast("string").alias(by)).agg(F.count(F.lit(1)).alias("n_in"))
    n_out = back.groupBy(F.col(by).cast("string").alias(by)).agg(F.count(F.lit(1)).alias("n_out"))
    both = n_in.join(n_out, by, "full_outer")
    both = cut(both.withColumn("ok", F.coalesce(F.col("n_in") == F.col("n_out"), F.lit(False))))
    bad = both.where("not ok").limit(3).collect()
    if bad:
        raise ValueError(f"files do not hold what was written: {bad}")
    return both


def variant_id_maps(variants: DataFrame) -> DataFrame:
    """chrom:pos:ref:alt beside the public id; both must be present and unique."""
    out = variants.select("chrom", A.variant_id("chrom", "pos", "ref", "alt").alias("variant_key"), "rsid")
    if out.where(F.col("rsid").isNull() | F.col("variant_key").isNull()).limit(1).count():
        raise ValueError("variant without an id")
    require_unique(out, ["variant_key"], "variant map")
    require_unique(out, ["rsid"], "variant map")
    return out


def metric_table(df: DataFrame, metrics: dict) -> DataFrame:
    """One pass over the data, then one row per metric."""
    one = df.agg(*[F.expr(e).cast("double").alias(n) if isinstance(e, str) else e.cast("double").alias(n) for n, e in metrics.items()])
    return one.unpivot([], list(metrics), "metric", "value")


def pending(manifest: DataFrame, done: DataFrame, keys: list[str], params: list[str]) -> DataFrame:
    """Work whose stored output is absent or was made with other parameters."""
    cond = reduce(lambda a, c: a & F.col(f"m.{c}").eqNullSafe(F.col(f"d.{c}")), params, reduce(lambda a, c: a & (F.col(f"m.{c}") == F.col(f"d.{c}")), keys, F.lit(True)))
    return manifest.alias("m").join(done.alias("d"), cond, "left_anti")


def assign_batches(dim: DataFrame, order: str, size: int) -> DataFrame:
    """Fixed-size batches of a dimension in the order of a unique numeric id."""
    return ranks.number_rows(dim, order).withColumn("batch", F.floor(F.col("row_idx") / F.lit(size)).cast("int")).drop("row_idx")


def batch_wide(values: DataFrame, names: list[str]) -> DataFrame:
    """At most one batch of traits as columns over the union of their samples; absent is null."""
    if len(names) > 64:
        raise ValueError("a batch holds at most 64 traits")
    return values.groupBy("iid").pivot("pheno_id", names).agg(F.first("y", ignorenulls=True))


def split_duplicates(df: DataFrame, key: str, order: str) -> DataFrame:
    """First row of every name is kept, the rest are reported: flag them without sorting a name's rows."""
    first = df.groupBy(key).agg(F.min(order).alias("_first"))
    return df.join(first, key).withColumn("kept", F.col(order) == F.col("_first")).drop("_first")


def fingerprint(df: DataFrame) -> DataFrame:
    """Order-free hash of a table: row count, sum and xor-like second moment of row hashes, columns by name."""
    cols = sorted(df.columns)
    h = F.xxhash64(F.to_json(F.struct(*[F.col(f"`{c}`").cast("string").alias(c) for c in cols]), {"ignoreNullFields": "false"}))  # nulls keep their column
    return df.select(h.alias("h")).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.sum(F.pmod("h", F.lit(2**31))).alias("low_sum"),
        F.bit_xor("h").alias("hash_xor"),
    ).withColumn("columns", F.lit(",".join(cols)))
