"""Checkbox composites with contradiction status and provenance, and their quality report. Options are rows, so one plan serves all composites."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: What an answer option stands for, and the statuses of a score.
CLASS, NONE, OTHER, DECLINED = "class", "none", "other", "declined"
SCORED, MISSING, INVALID, CONTRADICTION = "scored", "missing", "invalid", "contradiction"


def label_of(text: str | Column) -> Column:
    """Lower case, single spaces; no word is dropped."""
    return F.trim(F.regexp_replace(F.lower(F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))), r"\s+", " "))


def checkbox_counts(selected: DataFrame, concepts: DataFrame, labels: DataFrame) -> DataFrame:
    """Distinct classes ticked per composite and person: composite, iid, y, observed, status, age, source_surveys, source_event.

    selected: pid, qid, ts, age, answers (array of text, concept, survey); concepts: composite, qid, concept, code, kind; labels: composite, qid, label (as label_of), code, kind. The concept decides; its
    label must not stand for another code, and an unknown concept is invalid however familiar its label. Without a concept the label counts if it stands for one code only.
    Invalid answers make the person invalid; unrecognized or declined ones missing; none together with a class is a contradiction; none alone or with other is 0; other alone is missing.
    Definition tables are a few rows per composite.
    """
    kinds = concepts.select("composite", "qid", "code", "kind").unionByName(labels.select("composite", "qid", "code", "kind")).distinct()
    asked = kinds.select("composite", "qid").distinct()
    size = kinds.groupBy("composite").agg(F.count_distinct(F.when(F.col("kind") == CLASS, F.col("code"))).alias("size"))
    one = labels.groupBy("composite", "qid", "label").agg(F.min("code").alias("label_code"), F.count_distinct("code").alias("n_codes"))
    a = selected.select("pid", "qid", "ts", "age", F.explode("answers").alias("a")).join(F.broadcast(asked), "qid")
    a = a.select("composite", "pid", "qid", "ts", "age", F.trim(F.coalesce("a.concept", F.lit(""))).alias("concept"), label_of(F.col("a.text")).alias("label"), F.col("a.survey").alias("survey"))
    a = a.join(F.broadcast(concepts.select("composite", "qid", "concept", F.col("code").alias("concept_code"))), ["composite", "qid", "concept"], "left").join(F.broadcast(one), ["composite", "qid", "label"], "left")
    given = F.col("concept") != ""
    clash = F.col("label_code").isNotNull() & ((F.col("n_codes") > 1) | (F.col("label_code") != F.col("concept_code")))
    bad = given & (F.col("concept_code").isNull() | clash)
    code = F.when(given & ~bad, F.col("concept_code")).when(~given & (F.col("n_codes") == 1), F.col("label_code"))
    a = a.withColumn("bad", bad).withColumn("code", code).join(F.broadcast(kinds), ["composite", "qid", "code"], "left")
    is_ = lambda kind: F.coalesce(F.col("kind") == kind, F.lit(False))
    g = a.groupBy("composite", "pid").agg(
        F.bool_or("bad").alias("bad"), F.bool_or(F.col("code").isNull() | is_(DECLINED)).alias("open"), F.bool_or(is_(NONE)).alias("none"), F.count_distinct(F.when(is_(CLASS), F.col("code"))).alias("n"), F.min("age").alias("age"),
        F.array_join(F.array_sort(F.collect_set(F.nullif("survey", F.lit("")))), "|").alias("source_surveys"), F.array_join(F.array_sort(F.collect_set(F.concat_ws(":", "qid", F.col("ts").cast("string")))), "|").alias("source_event"))
    status = F.when(F.col("bad"), INVALID).when(F.col("open"), MISSING).when(F.col("none") & (F.col("n") > 0), CONTRADICTION).when(F.col("none") | (F.col("n") > 0), SCORED).otherwise(MISSING)
    g = g.join(F.broadcast(size), "composite").withColumn("status", status)
    seen = F.when(F.col("status").isin(SCORED, CONTRADICTION), F.col("size")).otherwise(0)
    return g.select("composite", F.col("pid").alias("iid"), F.when(F.col("status") == SCORED, F.col("n").cast("double")).alias("y"), seen.alias("observed"), "status", "age", "source_surveys", "source_event")


def composite_report(scores: DataFrame) -> DataFrame:
    """composite, metric, value: persons per status, and count, least, greatest, mean and population SD of the scores."""
    per = scores.groupBy("composite").agg(
        *[F.count_if(F.col("status") == s).cast("double").alias(s) for s in (SCORED, MISSING, INVALID, CONTRADICTION)],
        F.min("y").alias("minimum"), F.max("y").alias("maximum"), F.avg("y").alias("mean"), F.stddev_pop("y").alias("sd"))
    return per.unpivot(["composite"], [c for c in per.columns if c != "composite"], "metric", "value")
