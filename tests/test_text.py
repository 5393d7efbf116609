"""Text and number columns on hand-made values."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortloom.functions import alleles as A
from cohortloom.functions import numeric as N
from cohortloom.functions import text as T


def one(spark, value, make):
    return spark.createDataFrame([(value,)], "x string").select(make("x").alias("y")).first()["y"]


@pytest.mark.parametrize("raw, want", [
    ("<b>How  often</b> do you \"feel\" ‘sad’?", "how often do you feel sad"), (None, ""), ("so high, \"excited, or hyper\".", "so high, excited, or hyper"),
])
def test_norm_question(spark, raw, want):
    assert one(spark, raw, T.norm_question) == want


@pytest.mark.parametrize("raw, want", [("Cat: Sub: Yes.", "yes"), ("Dont know", "don't know"), ("PMI: Skip", "skip"), ("Yes:", ""), ("<i>No</i>", "no")])
def test_norm_answer(spark, raw, want):
    assert one(spark, raw, T.norm_answer) == want


@pytest.mark.parametrize("raw, want", [("A: b: c", "b: c"), ("Yes: ", "Yes:"), (" plain ", "plain"), (None, "")])
def test_answer_tail(spark, raw, want):
    assert one(spark, raw, T.answer_tail) == want


@pytest.mark.parametrize("raw, want", [("PMI: Prefer Not To Answer", True), ("", True), (None, True), ("Never", False), ("Q: Don't know", True), ("Yes: ", True)])
def test_missing(spark, raw, want):
    assert one(spark, raw, T.is_missing_answer) is want


def test_tokens_drop_stopwords_and_plurals(spark):
    assert one(spark, "Which of the doctors' visits was your last one?", T.content_tokens) == ["doctor", "last", "one", "visit"]


@pytest.mark.parametrize("raw, want", [("Who has had it? - Self", "self"), ("Mother smith: asthma", "mother"), ("x: y - Half-Sibling.", "half-sibling"), ("None", "none")])
def test_relation(spark, raw, want):
    assert one(spark, raw, T.relation_norm) == want


@pytest.mark.parametrize("raw, strict, loose", [("12", 12.0, 12.0), ("1e2", None, 100.0), ("+3.5", 3.5, 3.5), ("PMI: Skip", None, None), (".5", None, 0.5), ("", None, None)])
def test_numbers(spark, raw, strict, loose):
    assert one(spark, raw, T.parse_number) == strict
    assert one(spark, raw, lambda c: T.parse_number(c, strict=False)) == loose


def test_integer_bounds(spark):
    keep = lambda c: T.parse_number(c, 0, 10, integer=True, strict=False)
    assert [one(spark, v, keep) for v in ("10", "10.5", "11", "-1", "3.0")] == [10.0, None, None, None, 3.0]


def test_options_and_range(spark):
    assert [tuple(o) for o in one(spark, "1=Yes | x | 2 = a=b", T.parse_options)] == [("1", "Yes"), ("2", "a=b")]
    assert tuple(one(spark, "note range [1.5, 20] years", T.parse_range)) == (1.5, 20.0)
    assert tuple(one(spark, "range [low, 20]", T.parse_range)) == (None, None)


def test_identifiers(spark):
    assert one(spark, "??", T.slug) == "x"
    assert one(spark, "A-b  C!", T.sanitize) == "a_b_c"
    assert len(one(spark, "z" * 99, T.slug)) == 40


@pytest.mark.parametrize("r, a, want", [("GAT", "CAT", ("G", "C", 2)), ("A", "A", ("A", "A", 0)), ("TTT", "TT", ("TT", "T", 1)), ("AC", "GT", ("AC", "GT", 0))])
def test_right_trim(spark, r, a, want):
    got = spark.createDataFrame([(r, a)], "r string, a string").select(A.right_trim("r", "a").alias("t")).first()["t"]
    assert tuple(got) == want


@pytest.mark.parametrize("row, want", [
    (("A", "G", "A", "G"), "same"), (("A", "G", "G", "A"), "swapped"), (("A", "G", "T", "C"), "strand_flip"), (("A", "G", "C", "T"), "swapped_strand_flip"),
    (("A", "T", "A", "T"), "strand_ambiguous"), (("A", "G", "A", "C"), "allele_mismatch"), (("AT", "A", "TA", "T"), "allele_mismatch"), (("AT", "A", "A", "AT"), "swapped"),
])
def test_alignment(spark, row, want):
    df = spark.createDataFrame([row], "a string, b string, c string, d string")
    assert df.select(A.align_alleles("a", "b", "c", "d").alias("s")).first()["s"] == want


def test_normal_quantile(spark):
    ps = [1e-12, 1e-4, 0.025, 0.3, 0.5, 0.8, 0.975, 1 - 1e-6]
    got = [r[0] for r in spark.createDataFrame([(p,) for p in ps], "p double").select(N.normal_quantile("p")).collect()]
    back = [0.5 * math.erfc(-z / math.sqrt(2)) for z in got]
    assert np.allclose(back, ps, rtol=1e-12, atol=0)


def test_student_tail_known_values():
    assert np.isclose(10 ** N.student_log10_p([1.0], [1.0])[0], 0.5)
    assert np.isclose(10 ** N.student_log10_p([2.0], [2.0])[0], 1 - 2 / math.sqrt(6))
    assert np.isclose(10 ** N.student_log10_p([1.959963985], [1e7])[0], 0.05, rtol=1e-5)
    assert N.student_log10_p([0.0], [5.0])[0] == 0.0
    assert -330 < N.student_log10_p([38.0], [1e6])[0] < -300


def test_months_and_year(spark):
    df = spark.createDataFrame([("years", 2.0, "2000-07-01"), ("weeks", 8.69, "2001-01-01"), ("months", 12.0, "1999-12-31")], "u string, v double, d string")
    rows = df.select(N.to_months("v", "u").alias("m"), N.fractional_year(F.col("d").cast("date")).alias("y")).collect()
    assert [None if r["m"] is None else round(r["m"], 6) for r in rows] == [24.0, 2.0, None]
    assert [round(r["y"], 6) for r in rows] == [round(2000 + 182 / 366, 6), 2001.0, round(1999 + 364 / 365, 6)]
