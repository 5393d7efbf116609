"""Features as rows, their vocabulary, and one sparse vector per person.

A feature row is (iid, feature, kind, scope, value). Kinds: took, numeric, ordinal, nonresponse, one_hot. Only chosen options are one-hot rows; their zeros follow from the scope, the
question that the person answered, which is kept once per person and question. What is neither a row nor in scope is unknown, but for took flags, which are 0. The vocabulary comes from
the rows, so nothing lists features beforehand and no table has a column per feature.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T
from .responses import union_all

KINDS = ("took", "numeric", "ordinal", "nonresponse", "one_hot")


def _rows(df: DataFrame, feature: Column, kind: str, value: Column, scope: Column | None = None) -> DataFrame:
    return df.select("iid", feature.alias("feature"), F.lit(kind).alias("kind"), (F.lit(None).cast("string") if scope is None else scope).alias("scope"), value.cast("double").alias("value"))


def survey_features(events: DataFrame) -> DataFrame:
    """took_ and age_at_ (the latest age) of each survey. events: iid, survey, age."""
    per = events.groupBy("iid", "survey").agg(F.max("age").alias("age"))
    return _rows(per, F.concat(F.lit("took_"), "survey"), "took", F.lit(1.0)).unionByName(_rows(per.where("age is not null"), F.concat(F.lit("age_at_"), "survey"), "numeric", F.col("age")))


def area_features(people: DataFrame, area: DataFrame, place: str, columns: list[str], prefix: str = "area_") -> DataFrame:
    """A numeric feature per column of the person's area; persons without a known area have none."""
    j = people.where(F.col(place).isNotNull()).join(area, place)
    return _rows(j.select("iid", *columns).unpivot(["iid"], columns, "name", "v").where("v is not null"), F.concat(F.lit(prefix), "name"), "numeric", F.col("v"))


def answer_features(answers: DataFrame, ordinal: DataFrame, numeric: DataFrame) -> DataFrame:
    """Numeric questions as numbers, ordinal ones as their answer's value, all others one-hot by chosen option.

    answers: iid, qid, answer; ordinal: qid, answer, value, of questions with one answer per person and a value for each (see features.ordinal_eligible); numeric: qid. The
    definition tables are joined by question.
    """
    q = lambda tail: F.concat(F.lit("q_"), "qid", F.lit(tail))
    num = answers.join(numeric.select("qid").distinct(), "qid", "left_semi").withColumn("v", T.parse_number(T.answer_tail("answer"), strict=False)).where("v is not null").groupBy("iid", "qid").agg(F.max("v").alias("v"))
    rest = answers.join(numeric.select("qid").distinct(), "qid", "left_anti")
    ords = rest.join(ordinal, ["qid", "answer"]).groupBy("iid", "qid").agg(F.max("value").alias("v"))
    hot = rest.join(ordinal.select("qid").distinct(), "qid", "left_anti").select("iid", "qid", T.slug(T.answer_tail("answer")).alias("option")).distinct()
    return union_all([_rows(num, q("_num"), "numeric", F.col("v")), _rows(ords, q("_ord"), "ordinal", F.col("v")), _rows(hot, F.concat_ws("_", F.lit("q"), "qid", F.lit("a"), "option"), "one_hot", F.lit(1.0), F.col("qid"))])


def nonresponse_features(events: DataFrame, listed: DataFrame, declined: Column) -> DataFrame:
    """1 for persons who declined a listed question at some time, 0 for those who only answered it, nothing for others. events: iid, qid, answer; `declined` tells."""
    per = events.join(listed.select("qid").distinct(), "qid", "left_semi").groupBy("iid", "qid").agg(F.bool_or(declined).alias("d"), F.bool_or(~T.is_missing_answer("answer")).alias("v"))
    return _rows(per.where("d or v"), F.concat(F.lit("q_"), "qid", F.lit("_nonresponse")), "nonresponse", F.when(F.col("d"), 1.0).otherwise(0.0))


def vocabulary(rows: DataFrame) -> DataFrame:
    """The feature catalog: idx (from 0, by name), feature, kind, scope, n_known persons, n_nonzero. Its size is that of the definitions, not of the persons."""
    per = rows.groupBy("feature", "kind", "scope").agg(F.count_distinct("iid").alias("n"), F.count_if(F.col("value") != 0).alias("n_nonzero"))
    scopes = rows.where("scope is not null").groupBy(F.col("scope").alias("s")).agg(F.count_distinct("iid").alias("n_scope"))
    j = per.join(scopes, F.col("scope") == F.col("s"), "left").drop("s")
    # features are numbered in one place: a row per feature
    at = F.row_number().over(Window.orderBy("feature")) - 1
    return j.select(at.cast("int").alias("idx"), "feature", "kind", "scope", F.coalesce("n_scope", "n").alias("n_known"), "n_nonzero")


def vectors(rows: DataFrame, catalog: DataFrame) -> DataFrame:
    """iid, indices (ascending), values and scopes (questions answered, whose other options are 0)."""
    j = rows.join(catalog.select("feature", "idx"), "feature")
    cells = j.groupBy("iid", "idx").agg(F.max("value").alias("value"), F.max("scope").alias("scope"))
    g = cells.groupBy("iid").agg(F.array_sort(F.collect_list(F.struct("idx", "value"))).alias("v"), F.array_sort(F.collect_set("scope")).alias("scopes"))
    return g.select("iid", F.col("v.idx").alias("indices"), F.col("v.value").alias("values"), "scopes")


def feature_counts(catalog: DataFrame) -> DataFrame:
    """Columns by kind, and in all: metric, value."""
    n = lambda c, name: F.count_if(c).alias(name)
    one = catalog.agg(F.count(F.lit(1)).alias("feature_columns"), *[n(F.col("kind") == k, f"{k}_columns") for k in KINDS])
    return one.unpivot([], ["feature_columns", *(f"{k}_columns" for k in KINDS)], "metric", "value")
