"""Delimited and multi-source reads with required columns, typed coercion and checked keys."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators.responses import union_all
from ..session import key_list


def require_columns(df: DataFrame, required, where: str = "table") -> None:
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"{where} lacks columns {missing}")


def require_unique(df: DataFrame, keys: list[str], where: str = "table") -> DataFrame:
    """Fail with examples when a key repeats; only a handful of counterexamples reach the driver."""
    bad = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1").limit(3).collect()
    if bad:
        raise ValueError(f"{where}: key {keys} repeats, e.g. {[tuple(row) for row in bad]}")
    return df


def read_table(
    spark: SparkSession, path: str, sep: str = "\t", required=(), casts: dict[str, str] | None = None, names: list[str] | None = None
) -> DataFrame:
    """Delimited file (plain or compressed), all text at first; listed columns are cast, what does not parse becomes null.

    sep='ws' splits at runs of white space, as in aligned tables. Their header is the first line of a single file; for a folder
    of parts, whose first line is not defined, give the names. Header lines are dropped by content wherever they stand.
    """
    if sep == "ws":
        lines = spark.read.text(path).where(F.trim("value") != "")
        names = names or lines.first()["value"].split()
        parts = F.split(F.trim("value"), r"[ \t]+")
        header = F.regexp_replace(F.array_join(parts, " "), r"\A#", "") == F.lit(" ".join(names).lstrip("#"))
        df = lines.where(~header).select(*[F.get(parts, F.lit(i)).alias(n) for i, n in enumerate(names)])
    else:
        df = spark.read.csv(path, sep=sep, header=True, inferSchema=False)
    if df.columns and df.columns[0].startswith("#"):
        df = df.withColumnRenamed(df.columns[0], df.columns[0][1:])
    require_columns(df, required, path)
    for name, kind in (casts or {}).items():
        value = F.col(name).try_cast(kind)
        df = df.withColumn(name, F.when(~F.isnan(value), value) if kind in ("double", "float") else value)
    return df


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(jvm_path)


def read_responses(spark: SparkSession, paths: list[str], keep: DataFrame | None = None, qids=None, texts=None, sep: str = ",") -> DataFrame:
    """Union of the sources that exist, kept persons only, listed questions (by id or normalized text) only."""
    found = [spark.read.csv(p, sep=sep, header=True) for p in paths if path_exists(spark, p)]
    if not found:
        raise ValueError("none of the response sources exists")
    df = union_all(found)
    wanted = F.lit(False) if (qids or texts) else F.lit(True)
    if qids:
        wanted = wanted | F.trim("question_concept_id").isin(list(qids))
    if texts:
        wanted = wanted | T.norm_question("question").isin(list(texts))
    df = df.where(wanted)
    return semi_scan(df, keep, "person_id") if keep is not None else df


def semi_scan(df: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """Rows of a huge table whose key is wanted; the id list is broadcast only after it was counted."""
    return df.join(key_list(ids.select(key).distinct()), key, "left_semi")


def anti_scan(df: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    return df.join(key_list(ids.select(key).distinct()), key, "left_anti")


def extract_with_age(events: DataFrame, person: DataFrame, key: str, ts: str, birth: str) -> DataFrame:
    """Events joined to their person with the age in years at the event; events without a date are left out."""
    return events.where(F.col(ts).isNotNull()).join(person, key).withColumn(
        "age", F.datediff(F.col(ts).cast("date"), F.col(birth).cast("date")) / F.lit(365.25)
    )


def read_id_list(df: DataFrame, key: str) -> DataFrame:
    """A list of ids: blanks and repeats are errors."""
    blank = df.where(F.col(key).isNull() | (F.trim(F.col(key).cast("string")) == "")).limit(1).count()
    if blank:
        raise ValueError(f"id list has blank values in {key}")
    return require_unique(df, [key], "id list")


def duplicate_ids(df: DataFrame, key: str) -> DataFrame:
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
