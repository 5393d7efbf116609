"""Selection of responses and trait builders on hand-made rows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from cohortloom.operators import builders as B
from cohortloom.operators import composites as C
from cohortloom.operators import joins as J
from cohortloom.operators import responses as R
from cohortloom.operators import rules as U
from cohortloom.operators import sparse_traits as Q
from cohortloom.operators import vocabulary as Y

SCHEMA = "pid string, qid string, ts timestamp, answer string, concept string, survey string, age double"


def day(n):
    return dt.datetime(2020, 1, n)


def pick(spark, rows, **kw):
    return {(r["pid"], r["qid"]): r for r in R.latest_valid(spark.createDataFrame(rows, SCHEMA), **kw).collect()}


def test_latest_valid_rules(spark):
    rows = [
        ("p", "q", day(1), "Yes", "1", "A", 30.0), ("p", "q", day(3), "PMI: Skip", "9", "A", 31.0),  # a later skip changes nothing
        ("p", "m", day(2), "Red", "1", "A", 30.0), ("p", "m", day(2), "Blue", "2", "A", 30.0), ("p", "m", day(2), "Red", "1", "A", 30.0), ("p", "m", day(1), "Green", "3", "A", 29.0),
        ("p", "only", day(1), "Skip", "9", "A", 30.0), ("p", "plain", day(1), "Skip", "9", "A", 30.0), ("p", "", day(1), "Yes", "1", "A", 30.0),
    ]
    got = pick(spark, rows, keep_missing_qids=["only"])
    assert set(got) == {("p", "q"), ("p", "m"), ("p", "only")}
    assert [a["text"] for a in got["p", "q"]["answers"]] == ["Yes"] and got["p", "q"]["age"] == 30.0
    assert [a["text"] for a in got["p", "m"]["answers"]] == ["Blue", "Red"]
    assert not got["p", "only"]["valid"]


def test_hot_group_stays_whole(spark):
    """A third of all rows belong to one person and question."""
    base = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("pid"), F.lit("q").alias("qid"), (F.lit(day(1)) + F.expr("make_interval(0,0,0,0,0,int(id))")).alias("ts"),
        F.concat(F.lit("a"), (F.col("id") % 4).cast("string")).alias("answer"), F.lit("1").alias("concept"), F.lit("s").alias("survey"), F.lit(1.0).alias("age"))
    got = {r["pid"]: [a["text"] for a in r["answers"]] for r in R.latest_valid(base).collect()}
    assert len(got) == 2001 and got["hot"] == ["a1"]


def test_gate_floor_and_missing_paths(spark):
    rows = [("no", 0, 3.0), ("yes", 1, 2.0), ("yes_missing", 1, None), ("no_screen", None, 2.0), ("out", 1, 9.0)]
    df = spark.createDataFrame(rows, "pid string, s int, f double")
    got = {r["pid"]: r["y"] for r in df.select("pid", B.gated(F.col("s"), F.col("f"), -1, 0, 5).alias("y")).collect()}
    assert got == {"no": -1.0, "yes": 2.0, "yes_missing": None, "no_screen": None, "out": None}


def test_hurdle_constant_component_and_shift(spark):
    rows = [("a", "endorser", 1.0, 5.0), ("b", "endorser", 3.0, 5.0), ("c", "endorser", None, 5.0), ("n", "negative", None, None), ("u", None, 2.0, 2.0)]
    got = {r["iid"]: r["y"] for r in B.hurdle(spark.createDataFrame(rows, "pid string, gate string, x double, k double"), ["x", "k"]).collect()}
    assert got == {"a": 0.0, "b": 2.0, "n": -1.0}


def test_battery(spark):
    rows = [("r", "i1", 1.0), ("n", "i1", 0.0), ("n", "i2", 0.0), ("half", "i1", 0.0)]
    got = {r["pid"]: r["gate"] for r in B.battery_gate(spark.createDataFrame(rows, "pid string, item string, y double"), 2).collect()}
    assert got == {"r": "reporter", "n": "screen_negative", "half": None}


def test_followup_controls(spark):
    parent = spark.createDataFrame([("p1", "No", 40.0), ("p2", "Yes", 41.0), ("p3", "No", 42.0)], "pid string, answer string, age double")
    follow = spark.createDataFrame([("p3", "Type A", 50.0), ("p4", "Type B", 51.0)], "pid string, answer string, age double")
    got = {(r["option"], r["iid"]): (r["y"], r["age"]) for r in B.followup_binary(parent, follow, ["no"]).collect()}
    assert got["type a", "p3"] == (1.0, 50.0) and got["type b", "p3"] == (0.0, 50.0) and got["type a", "p1"] == (0.0, 40.0)
    assert not any(k[1] == "p2" for k in got) and len(got) == 6


def test_family_burden(spark):
    chosen = spark.createDataFrame([("a", "Q - Self", 1.0), ("a", "Q - Mother", 1.0), ("b", "PMI: Skip", 1.0), ("c", "None", 1.0)], "pid string, answer string, age double")
    done = spark.createDataFrame([("a", 1.0), ("b", 1.0), ("d", 9.0)], "pid string, age double")
    got = {r["iid"]: r["y"] for r in B.family_burden(chosen, done).collect()}
    assert got == {"a": 1.5, "c": 0.0, "d": 0.0}


def test_complement_preference(spark):
    a = spark.createDataFrame([("q", "1", "Yes"), ("q", "2", "No"), ("w", "1", "A"), ("w", "1", "B"), ("z", "1", "Low"), ("z", "2", "High")], "qid string, pid string, answer string")
    v = spark.createDataFrame([("z", "Low", 1.0), ("z", "High", 2.0)], "qid string, answer string, value double")
    got = {(r["qid"], r["answer"]): r["status"] for r in B.collapse_complement(a, v).collect()}
    assert got["q", "Yes"] == "kept_complement" and got["q", "No"] == "skipped_complement" and got["w", "A"] == "kept" and got["z", "High"] == "kept_complement"


@pytest.mark.parametrize("opts, want", [(["1", "2", "1"], 2), (["0"], 0), (["0", "1"], None), (["8", "1"], None), (["7"], None), (["7", "1"], 1), (["zz", "1"], None), (None, None)])
def test_option_count(spark, opts, want):
    from cohortloom.operators.aggregates import option_count

    df = spark.createDataFrame([(opts,)], "o array<string>")
    assert df.select(option_count(F.col("o"), ["1", "2"], ["0"], ["7"], ["8"]).alias("n")).first()["n"] == want


def test_resolution_statuses(spark):
    A = "array<struct<text:string,concept:string>>"
    rows = [("ok", "q", 1.0, [("Yes", "10")]), ("clash", "q", 1.0, [("No", "10")]), ("unknown", "q", 1.0, [("Yes", "77")]), ("text", "q", 1.0, [("No", "")]), ("refused", "q", 1.0, [("Skip", "90")]), ("both", "q", 1.0, [("Yes", "10"), ("No", "11")])]
    c = spark.createDataFrame([("q", "10", 1.0), ("q", "11", 0.0), ("q", "90", None)], "qid string, concept string, value double")
    t = spark.createDataFrame([("yes", 1.0), ("no", 0.0), ("skip", None)], "label string, value double")
    got = {r["pid"]: (r["status"], r["value"]) for r in B.resolve_items(spark.createDataFrame(rows, f"pid string, qid string, age double, answers {A}"), c, t).collect()}
    assert got == {"ok": ("scored", 1.0), "clash": ("invalid", None), "unknown": ("invalid", None), "text": ("scored", 0.0), "refused": ("missing", None), "both": ("invalid", None)}


def test_rules_spellings(spark):
    df = spark.createDataFrame([("r", "Cat: Often; daily"), ("r", "4 to 6"), ("band", "4 to 6"), ("r", "Does not apply"), ("r", "rarely"), ("o", "often")], "rule string, answer string")
    rules = spark.createDataFrame([("r", "often", 3.0, False, False), ("r", "4-6", 5.0, False, False), ("band", "4-6", 5.0, False, True), ("r", "does not apply", None, True, False)], "rule string, label string, value double, local_missing boolean, dash boolean")
    over = spark.createDataFrame([("o", "often", 8.0), ("r", "often", 9.0), ("r", "does not apply", 7.0), ("r", "rarely", 1.0)], "rule string, label string, value double")
    got = {(r["rule"], r["answer"]): r["value"] for r in U.apply_rules(df, rules, over).collect()}
    assert got == {("r", "Cat: Often; daily"): 3.0, ("r", "4 to 6"): None, ("band", "4 to 6"): 5.0, ("r", "Does not apply"): None, ("r", "rarely"): 1.0, ("o", "often"): 8.0}


def test_unknown_sex_filter_fails(spark):
    meta = spark.createDataFrame([("a", "full"), ("b", "full")], "item string, covar_mode string").withColumn("sex_filter", F.lit("all"))
    good = spark.createDataFrame([("a", " Female")], "item string, sex_filter string")
    assert {(r["item"], r["sex_filter"], r["covar_mode"]) for r in U.sex_rules(meta, good).collect()} == {("a", "female", "agepc"), ("b", "all", "full")}
    with pytest.raises(Exception, match="invalid sex_filter"):
        U.sex_rules(meta, good.withColumn("sex_filter", F.lit("unknown"))).collect()


def test_options_with_one_slug_stay_apart(spark):
    long = "a very long answer that goes on for more than forty characters "
    rows = [("1", "q", long + "one", 30.0), ("2", "q", long + "two", 30.0), ("3", "q", "short", 30.0)]
    got = B.one_vs_rest(spark.createDataFrame(rows, "pid string, qid string, answer string, age double")).collect()
    assert len(got) == 9 and len({(r["pheno_id"], r["iid"]) for r in got}) == 9 and "bin_q_short" in {r["pheno_id"] for r in got}


def test_topics_search_the_survey(spark):
    items = spark.createDataFrame([("i", "Disability survey", "How are you", "descriptive", "")], "item string, survey string, field_label string, phenotype_class string, options string")
    rules = spark.createDataFrame([], "rule string, label string, value double, local_missing boolean, confidence string, priority int")
    assert U.classify_catalog(items, rules, spark.createDataFrame([], "item string"), "zzz").first()["topics"] == "disability"


def test_crosswalk_ladder(spark):
    live = spark.createDataFrame([("1", "s", "short label"), ("2", "s", "What is your Income?"), ("3", "s", "overallhealth_general"), ("4", "s", "red green blue yellow brown things here"), ("5", "s", "alpha beta gamma"), ("6", "s", "nothing alike")], "qid string, survey string, question string")
    cat = spark.createDataFrame([("item_a", "s", "x y z"), ("inc", "s", "what is your income"), ("general", "s", "how is it"), ("col", "s", "red green blue yellow black"), ("g1", "s", "alpha beta gamma"), ("dup1", "s", "zeta eta theta"), ("other", "t", "nothing alike")], "item string, survey string, label string")
    explicit = spark.createDataFrame([("1", "item a")], "qid string, item string")
    got = {r["qid"]: (r["item"], r["step"]) for r in J.crosswalk(live, cat, explicit).collect()}
    assert got["1"] == ("item_a", 1) and got["2"] == ("inc", 2) and got["3"] == ("general", 3) and got["4"] == ("col", 4) and got["5"] == ("g1", 2)
    assert got["6"] == ("other", 2)  # equal text does not ask for the survey


def test_strict_best_drops_ties(spark):
    df = spark.createDataFrame([("a", 1.0, "x"), ("a", 2.0, "y"), ("b", 2.0, "x"), ("b", 2.0, "y")], "k string, s double, c string")
    assert [tuple(r) for r in J.strict_best(df, ["k"], ["s"], "c").collect()] == [("a", "y", 2.0)]


def test_exclude_ranges_half_open(spark):
    pts = spark.createDataFrame([("1", 10), ("1", 11), ("1", 250000), ("2", 15)], "chrom string, pos long")
    rng = spark.createDataFrame([("1", 10, 20), ("1", 90000, 250000)], "chrom string, start long, end long")
    assert sorted((r[0], r[1]) for r in J.exclude_ranges(pts, rng).collect()) == [("1", 10), ("2", 15)]


def test_sex_additions_follow_their_rules(spark):
    rows = [
        ("same", 1, "XY", None), ("one x", 1, " xo", "Male"), ("female one x", 0, "X0", "Female"), ("skip", None, "XX", "PMI: Skip"), ("declined", None, "XY", "PMI_Prefer"), ("prefers", None, "XY", "I prefer not to answer"),
        ("other answer", None, "XX", "Something else"), ("no answer", None, "XX", None), ("withheld odd", None, "XXY", "PMI: Skip"), ("differs", 1, "XX", "PMI: Skip")]
    kept, audit = B.sex_additions(B.sex_status(spark.createDataFrame(rows, "iid string, reported int, ploidy string, answer string")))
    assert {(r.iid, r.sex_01, r.source) for r in kept.collect()} == {("same", 1, "concordant"), ("one x", 1, "imputed"), ("skip", 0, "imputed"), ("prefers", 1, "imputed")}
    assert {(r.iid, r.rule) for r in audit.collect()} == {("one x", "assigned_male_x0_xo"), ("skip", "withheld_xx"), ("prefers", "withheld_xy")}


def test_sparse_features_tell_zero_from_unknown(spark):
    a = spark.createDataFrame([(1, "q", "A: x"), (1, "q", "A: y"), (2, "q", "A: x"), (2, "n", "7.5"), (3, "o", "low")], "iid long, qid string, answer string")
    ordinal = spark.createDataFrame([("o", "low", 1.0), ("o", "high", 2.0)], "qid string, answer string, value double")
    rows = Y.answer_features(a, ordinal, spark.createDataFrame([("n",)], "qid string"))
    e = spark.createDataFrame([(1, "m", "Yes"), (2, "m", "PMI: Skip"), (3, "m", "PMI: Dont Know"), (2, "m", "No")], "iid long, qid string, answer string")
    rows = rows.unionByName(Y.nonresponse_features(e, spark.createDataFrame([("m",)], "qid string"), F.col("answer") == "PMI: Skip"))
    catalog = Y.vocabulary(rows)
    known = {r.feature: (r.idx, r.kind, r.n_known, r.n_nonzero) for r in catalog.collect()}
    assert known == {"q_m_nonresponse": (0, "nonresponse", 2, 1), "q_n_num": (1, "numeric", 1, 1), "q_o_ord": (2, "ordinal", 1, 1), "q_q_a_x": (3, "one_hot", 2, 2), "q_q_a_y": (4, "one_hot", 2, 1)}
    got = {r.iid: (r.indices, r["values"], r.scopes) for r in Y.vectors(rows, catalog).collect()}
    assert got == {1: ([0, 3, 4], [0.0, 1.0, 1.0], ["q"]), 2: ([0, 1, 3], [1.0, 7.5, 1.0], ["q"]), 3: ([2], [1.0], [])}
    assert {r.metric: r.value for r in Y.feature_counts(catalog).collect()}["one_hot_columns"] == 2


def test_sparse_traits_compose_their_rules(spark):
    yes = [(p, "yn", "Yes" if p % 3 else "No", 30.0) for p in range(12)]
    multi = [(p, "pick", a, 30.0) for p in range(8) for a in (["Red", "Blue"] if p < 4 else ["Blue"])]
    old = [(p, "income", "Low" if p < 6 else "High" if p < 9 else "Middle", 20.0 if p in (6, 7, 8) else None if p == 0 else 50.0) for p in range(12)]
    rest = [(1, "date", "2001", 30.0), (1, "amount", "7", 30.0), (1, "unheard", "Yes", 30.0)]
    manifest = [("yn", "binary_only", False, "", "q"), ("pick", "nominal_binary", True, "", "q"), ("income", "ordinal_and_binary", False, "earner", "q"), ("date", "excluded_date", False, "", "q"), ("amount", "numeric", False, "", "q")]
    t = Q.build(
        spark.createDataFrame(yes + multi + old + rest, "pid long, qid string, answer string, age double"), spark.createDataFrame(manifest, "qid string, disposition string, multi boolean, rule string, question string"),
        spark.createDataFrame([("earner", 40.0)], "rule string, min_age double"), spark.createDataFrame([], "qid string, answer string, value double"), 2, 1)
    status = {r.pheno_id: (r.status, r.n_cases, r.n_controls) for r in t.catalog.collect()}
    assert status == {
        "bin_yn_yes": ("made", 8, 4), "bin_yn_no": ("redundant_complement", 4, 8), "bin_pick_red": ("made", 4, 4), "bin_pick_blue": ("too_few", 8, 0), "bin_income_low": ("redundant_complement", 5, 3), "bin_income_high": ("below_min_age", 0, 0),
        "bin_income_middle": ("made", 3, 5), "bin_date_2001": ("excluded", 1, 0), "bin_amount_7": ("not_binary", 1, 0), "bin_unheard_yes": ("not_in_manifest", 1, 0)}
    got = {r.iid: (r["bin_yn_yes"], r["bin_pick_red"], r["none"]) for r in Q.wide_batch(t, ["bin_yn_yes", "bin_pick_red", "none"]).collect()}
    assert got[1] == (1.0, 1.0, None) and got[0] == (0.0, 1.0, None) and got[5] == (1.0, 0.0, None) and got[11] == (1.0, None, None)
    assert t.cases.where("pheno_id = 'bin_yn_yes'").count() == 8


def test_checkbox_statuses_and_provenance(spark):
    concepts = [("c", "q", "1", "a", "class"), ("c", "q", "2", "b", "class"), ("c", "q", "8", "none", "none"), ("c", "q", "7", "other", "other")]
    labels = [("c", "q", "tea", "a", "class"), ("c", "q", "juice", "b", "class"), ("c", "q", "drink", "a", "class"), ("c", "q", "drink", "b", "class"), ("c", "q", "none of these", "none", "none"), ("c", "q", "prefer not to answer", "declined", "declined"), ("c", "q", "something else", "other", "other")]
    cases = {
        "two": [("Tea", "1", "s"), ("Juice", "2", "r")], "twice": [("Tea", "1", "s"), (" tea ", "", "s")], "none": [("None of  these", "8", "s"), ("Something else", "7", "s")], "both": [("Tea", "1", "s"), ("none of these", "", "s")],
        "unknown concept": [("Tea", "99", "s")], "clash": [("Juice", "1", "s")], "vague with concept": [("Drink", "1", "s")], "vague": [("Drink", "", "s")], "unheard": [("Soup", None, "s")], "declined": [("Tea", "1", "s"), ("Prefer not to answer", "", "s")],
        "other": [("Something else", "7", "")]}
    rows = [(p, "q", 5, 30.0, a) for p, a in cases.items()]
    got = {r.iid: r for r in C.checkbox_counts(
        spark.createDataFrame(rows, "pid string, qid string, ts int, age double, answers array<struct<text: string, concept: string, survey: string>>"),
        spark.createDataFrame(concepts, "composite string, qid string, concept string, code string, kind string"), spark.createDataFrame(labels, "composite string, qid string, label string, code string, kind string")).collect()}
    assert {k: (r.status, r.y, r.observed) for k, r in got.items()} == {
        "two": ("scored", 2.0, 2), "twice": ("scored", 1.0, 2), "none": ("scored", 0.0, 2), "both": ("contradiction", None, 2), "unknown concept": ("invalid", None, 0), "clash": ("invalid", None, 0), "vague with concept": ("invalid", None, 0),
        "vague": ("missing", None, 0), "unheard": ("missing", None, 0), "declined": ("missing", None, 0), "other": ("missing", None, 0)}
    assert (got["two"].source_surveys, got["two"].source_event, got["other"].source_surveys) == ("r|s", "q:5", "")


def test_numeric_answers_are_not_dealt_by_their_few_questions(spark):
    single = spark.range(200).selectExpr("id AS pid", "CASE WHEN id % 2 = 0 THEN 'a' ELSE 'b' END AS qid", "cast(id AS string) AS answer", "30.0D AS age")
    ranges = spark.createDataFrame([("a", 10.0, 20.0), ("b", None, None)], "qid string, lo double, hi double")
    out = B.numeric_trait(single, ranges, integer=True)
    assert "Exchange hashpartitioning" not in out._jdf.queryExecution().toString()
    assert sorted((r.pheno_id, r.iid, r.y) for r in out.collect()) == sorted([("num_a", i, float(i)) for i in range(10, 21, 2)] + [("num_b", i, float(i)) for i in range(1, 200, 2)])
