"""Content signatures as hash trees, and a manifest ledger with conflict rules and versions that appear at once."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import cut


# hash trees --------------------------------------------------------------------------------------------------------------------
def hash_tree(leaves: DataFrame, by: list[str], leaf: str = "leaf") -> DataFrame:
    """n_leaves and digest of each group of leaves (hex MD5 values), whatever their order and however they are split.

    A node holds the leaves with the same first two digits as their number and the sums of two stretches of their digits, so it is added up before the shuffle;
    the digest is that of a group's nodes, 256 at most.
    """
    part = lambda at: F.conv(F.substring(leaf, at, 15), 16, 10).cast("decimal(38,0)")
    nodes = leaves.groupBy(*by, F.substring(leaf, 1, 2).alias("_node")).agg(F.count(F.lit(1)).alias("n"), F.sum(part(1)).alias("a"), F.sum(part(16)).alias("b"))
    text = F.concat_ws(":", "_node", F.col("n").cast("string"), F.col("a").cast("string"), F.col("b").cast("string"))
    return nodes.groupBy(*by).agg(F.sum("n").alias("n_leaves"), F.md5(F.array_join(F.array_sort(F.collect_list(text)), ",").cast("binary")).alias("digest"))


def row_leaf(*columns: Column | str) -> Column:
    """MD5 of a row: the columns as text, each with its length, so that no two different rows look alike."""
    text = [F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit("\0")) for c in columns]
    return F.md5(F.concat(*[F.concat(F.length(t).cast("string"), F.lit(":"), t) for t in text]).cast("binary"))


def row_tree(df: DataFrame, by: list[str] = ()) -> DataFrame:
    """Signature of a table or of its groups; columns count by name, rows in any order."""
    cols = sorted(c for c in df.columns if c not in by)
    return hash_tree(df.select(*by, row_leaf(*[F.col(f"`{c}`") for c in cols]).alias("leaf")), list(by))


def file_tree(spark: SparkSession, path: str, by: Column | None = None) -> DataFrame:
    """Signature of each file below a path, or of groups of files: grp, n_files, n_bytes, n_leaves, digest.

    Leaves are the stretches of bytes between newlines, read as ranges of the file by many tasks; a file is never one value, so it may be of any size.
    Stretches count in any order.
    """
    lines = spark.read.option("lineSep", "\n").option("recursiveFileLookup", "true").text(path)
    named = lines.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("size"), F.md5(F.col("value").cast("binary")).alias("leaf"))
    named = named.withColumn("grp", F.element_at(F.split("file", "/"), -1) if by is None else by)
    sizes = named.groupBy("grp", "file").agg(F.max("size").alias("size")).groupBy("grp").agg(F.count(F.lit(1)).alias("n_files"), F.sum("size").alias("n_bytes"))
    return hash_tree(named, ["grp"]).join(sizes, "grp").select("grp", "n_files", "n_bytes", "n_leaves", "digest")


# ledger ---------------------------------------------------------------------------------------------------------------------------
def settle(rows: DataFrame, reserved: DataFrame, key: str = "pheno_id", place: str = "place") -> tuple[DataFrame, DataFrame]:
    """Rows that enter the manifest and rows that are skipped, with skip_reason: the first of an id, by `place`, wins; a reserved id that comes twice raises."""
    first = rows.groupBy(key).agg(F.min(place).alias("_first"), F.count(F.lit(1)).alias("_n"))
    twice = first.where("_n > 1").join(reserved.select(key).distinct(), key, "left_semi").limit(3).collect()
    if twice:
        raise ValueError(f"reserved ids were made twice: {sorted(r[key] for r in twice)}")
    j = rows.join(first.drop("_n"), key)
    return j.where(F.col(place) == F.col("_first")).drop("_first"), j.where(F.col(place) > F.col("_first")).drop("_first").withColumn("skip_reason", F.lit("duplicate_pheno_id"))


def merge_manifest(new: DataFrame, old: DataFrame, selected: DataFrame, key: str = "pheno_id") -> DataFrame:
    """Prior rows of traits that were not selected stay; selected traits come from the new run."""
    return old.join(selected.select(key).distinct(), key, "left_anti").unionByName(new, allowMissingColumns=True)


def _fs(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def versions(spark: SparkSession, folder: str) -> dict[int, tuple[str, str]]:
    """Published versions of a folder: number to (data folder, signature). A version is there when its marker is."""
    fs, where = _fs(spark, folder)
    if not fs.exists(where):
        return {}
    marks = [f.getPath().getName() for f in fs.listStatus(where) if f.getPath().getName().startswith("v-")]
    return {int(n): (data, digest) for _, n, data, digest in (m.split("-") for m in marks)}


def current(spark: SparkSession, folder: str) -> DataFrame:
    found = versions(spark, folder)
    return spark.read.parquet(f"{folder}/{found[max(found)][0]}")


def publish(df: DataFrame, folder: str) -> int:
    """Writes the next version and returns its number; a table with the signature of the current version is not written again.

    Data lie in a folder of their own until the marker, made by one exclusive step, names them; a run that fails before leaves the current version as it was, and of two
    writers of one number the second one raises.
    """
    spark = df.sparkSession
    df = cut(df)
    signed = row_tree(df).collect()
    digest = signed[0].digest if signed else "empty"
    found = versions(spark, folder)
    if found and found[max(found)][1] == digest:
        return max(found)
    number, data = max(found, default=0) + 1, f"data{uuid.uuid4().hex}"
    df.write.parquet(f"{folder}/{data}")
    lock, mark = (f"{folder}/{name}" for name in (f"lock{number}", f"v-{number}-{data}-{digest}"))
    fs, where = _fs(spark, lock)
    fs.create(where, False).close()  # raises if another run has this number
    fs.create(_fs(spark, mark)[1], False).close()
    return number
