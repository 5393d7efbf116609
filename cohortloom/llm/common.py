"""Shared pieces of the corpus operators: words, sizes, and the registry of their queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import sent_whole

#: ASCII white space separates words, nothing else does.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole(text: Column | str = "text") -> Column:
    """The text, empty where it is null."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def text_key() -> Column:
    """Tells rows with the same id, or none, apart."""
    return F.xxhash64(whole())


def having(docs: DataFrame, keys: DataFrame, how: str) -> DataFrame:
    """Rows of `docs` with (left_semi) or without (left_anti) a row of the cut table of (doc_id, text_key); texts stay where they are while the keys' files are small."""
    k = sent_whole(keys).select(F.col("doc_id").alias("__d"), F.col("text_key").alias("__k"))
    d = docs.withColumn("__t", text_key())
    return d.join(k, d["doc_id"].eqNullSafe(k["__d"]) & (d["__t"] == k["__k"]), how).select(*docs.columns)
