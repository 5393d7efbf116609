"""Survey responses: union of sources, latest valid event per person and question, answer-level views."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import fixed
from ..functions import text as T


def union_all(dfs: list[DataFrame]) -> DataFrame:
    """Union by name; a column a source lacks is null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)


def latest_valid(responses: DataFrame, keep_missing_qids: list[str] = ()) -> DataFrame:
    """One row per (pid, qid): all distinct answers at the latest instant that has a valid answer.

    Skips and refusals after a valid answer change nothing. For the listed questions a person without any valid answer keeps
    the latest missing event. Two aggregations with map-side combine; no window, so a hot person or question costs no long sort.
    """
    flagged = responses.where(F.col("qid").isNotNull() & (F.col("qid") != "") & F.col("ts").isNotNull()).withColumn(
        "valid", ~T.is_missing_answer("answer")
    )
    listed = F.col("qid").isin(list(keep_missing_qids)) if keep_missing_qids else F.lit(False)
    events = (
        flagged.where(F.col("valid") | listed)
        .groupBy("pid", "qid", "valid", "ts")
        .agg(
            F.min(T.col("age")).alias("age"),
            F.collect_set(F.struct(F.trim("answer").alias("text"), F.col("concept"), F.col("survey"))).alias("answers"),
        )
    )
    best = events.groupBy("pid", "qid").agg(F.max_by(F.struct("valid", "ts", "age", "answers"), F.struct("valid", "ts")).alias("e"))
    return best.select("pid", "qid", "e.valid", "e.ts", "e.age", F.array_sort("e.answers").alias("answers"))


def single_answer(selected: DataFrame) -> DataFrame:
    """Persons with exactly one valid answer text to the question; a valid event holds valid answers only."""
    texts = F.array_distinct("answers.text")
    return selected.where("valid").withColumn("texts", texts).where(F.size("texts") == 1).select("pid", "qid", "ts", "age", F.col("texts")[0].alias("answer"))


def answers_long(selected: DataFrame) -> DataFrame:
    """One row per person, question and distinct valid answer text."""
    return selected.where("valid").select("pid", "qid", "ts", "age", F.explode(F.array_distinct("answers.text")).alias("answer"))


def question_scan(responses: DataFrame) -> DataFrame:
    """Rows, persons and distinct valid answers per question; distinct triples are combined before the shuffle."""
    base = responses.withColumn("valid_answer", F.when(~T.is_missing_answer("answer"), T.answer_norm("answer")))
    cells = base.groupBy("qid", "pid", "valid_answer").agg(F.count(F.lit(1)).alias("n"))
    persons = cells.groupBy("qid", "pid").agg(F.sum("n").alias("n"), F.max(F.col("valid_answer").isNotNull()).alias("valid"))
    per_q = persons.groupBy("qid").agg(
        F.sum("n").alias("n_rows"), F.count(F.lit(1)).alias("n_persons"), F.sum(F.col("valid").cast("long")).alias("n_valid_persons")
    )
    answers = cells.where(F.col("valid_answer").isNotNull()).select("qid", "valid_answer").distinct().groupBy("qid").agg(F.count(F.lit(1)).alias("n_answers"))
    return per_q.join(answers, "qid", "left").withColumn("n_answers", F.coalesce("n_answers", F.lit(0)))


def coverage(scan: DataFrame, catalog: DataFrame, made: DataFrame, skipped: DataFrame) -> DataFrame:
    """Status of every live question against the traits produced and skipped for it."""
    m = made.groupBy("qid").agg(F.count(F.lit(1)).alias("n_made"))
    s = skipped.groupBy("qid").agg(F.count(F.lit(1)).alias("n_skipped"))
    out = scan.join(m, "qid", "left").join(s, "qid", "left").join(catalog.select("qid", "disposition"), "qid", "left")
    made_status = F.create_map(*[F.lit(x) for (m, k), name in fixed.COVERAGE_MADE.items() for x in (f"{m}{k}".lower(), name)])
    state = F.concat(F.col("n_made").isNotNull().cast("string"), F.col("n_skipped").isNotNull().cast("string"))
    named = {k: v for k, v in fixed.COVERAGE_DISPOSITIONS.items() if k not in (None, "else")}
    by_disposition = F.create_map(*[F.lit(x) for pair in named.items() for x in pair])
    kind = F.regexp_replace("disposition", "^excluded.*", "excluded")
    rest = F.when(kind.isNull(), F.lit(fixed.COVERAGE_DISPOSITIONS[None])).otherwise(F.coalesce(by_disposition[kind], F.lit(fixed.COVERAGE_DISPOSITIONS["else"])))
    status = F.coalesce(made_status[state], rest)
    return out.withColumn("status", status).fillna(0, ["n_made", "n_skipped"])
