"""One-vs-rest traits kept sparse: cases as rows, one list of who answered per question, and a catalog that says where each trait comes from.

A person who answered is a control of every other option of the question; such zeros are never rows. They are counted (answered less cases) and filled in only where a batch
of traits becomes columns. All rules are tables: the manifest gives each question its disposition, kind and rule, rules give least ages.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..session import cut
from .builders import preference

#: Dispositions whose questions get one-vs-rest traits.
BINARY = ["ordinal_and_binary", "binary_only", "nominal_binary", "flagged_review"]


class Sparse(NamedTuple):
    """cases: pheno_id, iid. answered: qid, iid, age. catalog: one row per question and answer, see `catalog`."""

    cases: DataFrame
    answered: DataFrame
    catalog: DataFrame


def catalog(answers: DataFrame, gated: DataFrame, manifest: DataFrame, values: DataFrame, min_cases: int, min_controls: int) -> DataFrame:
    """Every observed answer with its trait id, counts, status and wording.

    Columns: qid, answer, pheno_id, n_seen, n_cases, n_controls, status, construction_id, question, rule, case_wording, control_wording. The first status that applies: not_in_manifest, excluded,
    not_binary, below_min_age (nobody old enough), redundant_complement (the other of two answers of a single-select question is the trait), too_few, made.
    """
    seen = answers.groupBy("qid", "answer").agg(F.count_distinct("pid").alias("n_seen"))
    n = gated.groupBy("qid", "answer").agg(F.count_distinct("pid").alias("n_cases"))
    totals = gated.groupBy("qid").agg(F.count_distinct("pid").alias("n_answered"))
    slugs = seen.withColumn("slug", T.slug(T.answer_tail("answer")))
    alike = slugs.groupBy("qid", "slug").agg(F.count(F.lit(1)).alias("alike"))
    mark = F.when(F.col("alike") > 1, F.substring(F.md5("answer"), 1, 8))
    c = slugs.join(alike, ["qid", "slug"]).withColumn("pheno_id", F.concat_ws("_", F.lit("bin"), "qid", "slug", mark)).drop("slug", "alike")
    c = c.join(n, ["qid", "answer"], "left").join(totals, "qid", "left").join(manifest, "qid", "left").join(values, ["qid", "answer"], "left")
    two = n.join(values, ["qid", "answer"], "left").groupBy("qid").agg(F.count(F.lit(1)).alias("n_options"), F.max_by("answer", preference("answer", "value")).alias("best"))
    c = c.join(two, "qid", "left")
    kept = F.concat_ws("_", F.lit("bin"), "qid", T.slug(T.answer_tail("best")))
    other = (F.col("n_options") == 2) & ~F.col("multi") & (F.col("answer") != F.col("best"))
    cases, controls = F.coalesce("n_cases", F.lit(0)), F.coalesce(F.col("n_answered") - F.col("n_cases"), F.lit(0))
    status = (
        F.when(F.col("disposition").isNull(), "not_in_manifest").when(F.col("disposition").startswith("excluded"), "excluded").when(~F.col("disposition").isin(BINARY), "not_binary")
        .when(cases == 0, "below_min_age").when(other, "redundant_complement").when((cases < min_cases) | (controls < min_controls), "too_few").otherwise("made")
    )
    control = F.when(F.col("multi"), "question shown, option not selected").otherwise(F.concat(F.lit("any other valid answer to "), "question"))
    return c.select(
        "qid", "answer", "pheno_id", "n_seen", cases.alias("n_cases"), controls.alias("n_controls"), status.alias("status"), F.when(status == "redundant_complement", F.concat(F.lit("complement_of:"), kept)).alias("construction_id"),
        "question", "rule", F.concat(F.lit("answered '"), "answer", F.lit("' to "), "question").alias("case_wording"), control.alias("control_wording"))


def build(answers: DataFrame, manifest: DataFrame, min_ages: DataFrame, values: DataFrame, min_cases: int = 1, min_controls: int = 1) -> Sparse:
    """Sparse traits of all questions.

    answers: pid, qid, answer, age, valid answers only; manifest: qid, disposition, multi, rule, question; min_ages: rule, min_age, by which persons below (or without an age) do not
    count for the question; values: qid, answer, value where ordinal values are known. Definition tables are joined by question.
    """
    j = answers.join(manifest.select("qid", "rule"), "qid", "left").join(min_ages, "rule", "left")
    gated = cut(j.where(F.col("min_age").isNull() | (F.col("age") >= F.col("min_age"))).select("pid", "qid", "answer", "age"))
    known = cut(catalog(answers, gated, manifest, values, min_cases, min_controls))
    made = known.where("status = 'made'")
    cases = gated.join(made.select("qid", "answer", "pheno_id"), ["qid", "answer"]).select("pheno_id", F.col("pid").alias("iid")).distinct()
    answered = gated.join(made.select("qid").distinct(), "qid", "left_semi").groupBy("qid", F.col("pid").alias("iid")).agg(F.min("age").alias("age"))
    return Sparse(cases, answered, known)


def wide_batch(traits: Sparse, names: list[str]) -> DataFrame:
    """iid and a column per trait: 1 case, 0 answered otherwise, null not asked or not made. The one place where zeros are filled in. Rows are the persons asked for some of them."""
    if len(names) > 64:
        raise ValueError("a batch holds at most 64 traits")
    of = {r.pheno_id: r.qid for r in traits.catalog.where(F.col("pheno_id").isin(names) & (F.col("status") == "made")).select("pheno_id", "qid").collect()}  # at most 64 rows
    asked = traits.answered.where(F.col("qid").isin(sorted(set(of.values())))).groupBy("iid").agg(F.collect_set("qid").alias("qids"))
    ones = traits.cases.where(F.col("pheno_id").isin(names)).withColumn("y", F.lit(1.0)).groupBy("iid").pivot("pheno_id", names).agg(F.max("y"))
    zero = lambda n: F.when(F.array_contains("qids", of[n]), 0.0) if n in of else F.lit(None).cast("double")
    return asked.join(ones, "iid", "left").select("iid", *[F.coalesce(F.col(f"`{n}`"), zero(n)).alias(n) for n in names])


def legacy_ids(known: DataFrame, legacy: DataFrame) -> DataFrame:
    """Earlier one-hot ids of the listed questions: qid, answer, pheno_id, n_cases, n_controls of every answer that was given, complements included.

    legacy: qid, item (the name in the id; without one it is xgb_q and the question).
    """
    item = F.coalesce("item", F.concat(F.lit("xgb_q"), "qid"))
    j = known.where("n_cases > 0").join(F.broadcast(legacy), "qid")
    return j.select("qid", "answer", F.concat(F.lit("bin_"), item, F.lit("__"), T.slug(T.answer_tail("answer"))).alias("pheno_id"), "n_cases", "n_controls")
