"""Registered queries over the given tables and their DuckDB counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
NUDGE = 1.0000000000001


def query(name: str, sql: str | None = None):
    def register(fn):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def r(c, digits: int = 6):
    """Rounded double without negative zero; the tiny factor moves exact halves off the tie, so both engines print the same value."""
    c = F.col(c) if isinstance(c, str) else c
    return F.round(c.cast("double") * F.lit(NUDGE), digits) + F.lit(0.0)


def rs(expr: str, digits: int = 6) -> str:
    return f"(round(CAST({expr} AS DOUBLE) * CAST({NUDGE!r} AS DOUBLE), {digits}) + 0.0)"
