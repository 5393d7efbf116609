"""Traits from selected responses. Builders are table-driven: definitions are rows, never one plan per trait.

Answer tables have pid, qid, y, age. A trait row is pheno_id, iid, y, age.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fixed
from ..functions import text as T
from ..session import cut, sent_whole
from .responses import union_all


def one_vs_rest(answers: DataFrame) -> DataFrame:
    """A yes/no trait per question and observed answer; any other valid answer is a control.

    `answers` has pid, qid, age, answer (one row per chosen option). Options per question are few, so each person is repeated once
    per option of the question and never per other person.
    """
    chosen = answers.groupBy("pid", "qid").agg(F.collect_set("answer").alias("chosen"), F.min("age").alias("age"))
    options = answers.select("qid", F.col("answer").alias("option")).distinct().withColumn("slug", T.slug(T.answer_tail("option")))
    alike = options.groupBy("qid", "slug").agg(F.count(F.lit(1)).alias("alike"))
    mark = F.when(F.col("alike") > 1, F.substring(F.md5("option"), 1, 8))  # options that share their first 40 characters stay apart
    options = options.join(alike, ["qid", "slug"]).select("qid", "option", F.concat_ws("_", F.lit("bin"), "qid", "slug", mark).alias("pheno_id"))
    j = chosen.join(options, "qid")
    return j.select(
        "pheno_id", "qid", "option", F.col("pid").alias("iid"),
        F.array_contains("chosen", F.col("option")).cast("double").alias("y"), "age",
    )


def preference(answer: str | Column, value: str | Column) -> Column:
    """How much an answer is worth as the side of a two-answer question that becomes the trait; larger wins.

    The kind decides, then the number of numeric answers, then the text. Each kind has its own test; the best kind whose test holds counts,
    but a numeric answer is never a control and only what fits nothing else is plain.
    """
    key = T.answer_norm(answer)
    number = F.coalesce(T.col(value), T.parse_number(key, strict=False))
    tests = {kind: key.rlike(pattern) for kind, pattern in fixed.ANSWER_KIND_PATTERNS.items()}
    tests["numeric"] = number.isNotNull()
    tests["plain"] = ~T.control_like(answer)
    tests["control"] = F.lit(True)
    places = [F.when(F.coalesce(tests[kind], F.lit(False)), F.lit(place)) for place, kind in enumerate(fixed.ANSWER_KINDS)]
    place = F.greatest(*places)
    numeric = fixed.ANSWER_KINDS.index("numeric")
    return F.struct(place.alias("place"), F.when(place == numeric, number).otherwise(0.0).alias("value"), key.alias("text"))


def collapse_complement(answers: DataFrame, values: DataFrame) -> DataFrame:
    """Two-answer single-select questions: the preferred side is kept, the other skipped. One row per question and option.

    `answers` has pid, qid, answer; `values` has qid, answer, value (ordinal values where known).
    """
    per = answers.groupBy("qid", "pid").agg(F.count_distinct("answer").alias("n"))
    shape = per.groupBy("qid").agg(F.max("n").alias("most"))
    opts = answers.select("qid", "answer").distinct().join(values, ["qid", "answer"], "left")
    count = opts.groupBy("qid").agg(F.count(F.lit(1)).alias("n_options"), F.max_by("answer", preference("answer", "value")).alias("best"))
    j = opts.join(count, "qid").join(shape, "qid")
    pair = (F.col("n_options") == 2) & (F.col("most") == 1)
    return j.select("qid", "answer", F.when(~pair, "kept").when(F.col("answer") == F.col("best"), "kept_complement").otherwise("skipped_complement").alias("status"))


def numeric_trait(single: DataFrame, ranges: DataFrame, integer: bool = False) -> DataFrame:
    """Numeric answers inside the question's range (no range: any number). The ranges are measured and sent whole if they are small: a few questions would be a few hot keys."""
    j = single.join(sent_whole(cut(ranges.select("qid", "lo", "hi"))), "qid")
    v = T.parse_number("answer", integer=integer, strict=False)
    ok = (F.col("lo").isNull() | F.col("hi").isNull()) | v.between(F.col("lo"), F.col("hi"))
    return j.withColumn("y", v).where(ok & F.col("y").isNotNull()).select(F.concat_ws("_", F.lit("num"), "qid").alias("pheno_id"), F.col("pid").alias("iid"), "y", "age")


def min_age(values: DataFrame, rules: DataFrame) -> DataFrame:
    """Rows at or above the least age of their trait; traits without a rule keep all rows."""
    j = values.join(rules.select("pheno_id", "min_age"), "pheno_id", "left")
    return j.where(F.col("min_age").isNull() | (F.col("age") >= F.col("min_age"))).drop("min_age")


def pooled_items(primary: DataFrame, fill: DataFrame) -> DataFrame:
    """Per person and item the primary source's score, else the fill-in's; `from_fill` says which."""
    both = primary.withColumn("p", F.lit(0)).unionByName(fill.withColumn("p", F.lit(1))).where(F.col("y").isNotNull())
    return both.groupBy("pid", "item").agg(F.min_by(F.struct("y", "age", "p"), "p").alias("b")).select("pid", "item", "b.y", "b.age", F.col("b.p").alias("from_fill"))


def pooled_scale(items: DataFrame, reverse: DataFrame, n_items: int, complete: bool = False) -> DataFrame:
    """Scale from pooled items: reverse keys (max - y), proration or completeness, fill-in flag if any item was filled in."""
    j = items.join(reverse.select("item", "top"), "item", "left")
    j = j.withColumn("y", F.when(F.col("top").isNotNull(), F.col("top") - F.col("y")).otherwise(F.col("y")))
    out = j.groupBy("pid").agg(F.count("y").alias("n_valid"), F.avg("y").alias("m"), F.avg("age").alias("age"), F.max("from_fill").alias("from_fill"))
    need = n_items if complete else n_items // 2 + 1
    return out.where(F.col("n_valid") >= need).select(F.col("pid").alias("iid"), (F.col("m") * n_items).alias("y"), "age", "from_fill", "n_valid")


def first_age(sources: list[str]) -> Column:
    """First known age in the stated order of sources."""
    return F.coalesce(*[F.when(~F.isnan(c), F.col(c)) for c in sources])


def by_question(answers: DataFrame, qids: list[str], value: str = "y") -> DataFrame:
    """One row per person with a value and an age column per listed question (a fixed, short list)."""
    hit = lambda q: F.col("qid") == q
    return answers.where(F.col("qid").isin(qids)).groupBy("pid").agg(
        *[F.max(F.when(hit(q), F.col(value))).alias(f"v_{q}") for q in qids], *[F.max(F.when(hit(q), F.col("age"))).alias(f"a_{q}") for q in qids]
    )


def gated(screen: Column, followup: Column, floor: float, lo: float | None = None, hi: float | None = None) -> Column:
    """No at the screen gives the floor (0, or -1 when the follow-up has its own 0); yes gives the follow-up; else missing."""
    ok = F.lit(True) if lo is None else followup.between(lo, hi)
    return F.when(screen == 0, F.lit(float(floor))).when((screen == 1) & ok, followup)


def gated_trait(wide: DataFrame, pheno_id: str, screen: Column, followup: Column, ages: list[str], floor: float, lo=None, hi=None) -> DataFrame:
    y = gated(screen, followup, floor, lo, hi)
    age = F.when(screen == 0, first_age(ages[1:])).otherwise(first_age(ages))
    return wide.select(F.lit(pheno_id).alias("pheno_id"), F.col("pid").alias("iid"), y.alias("y"), age.alias("age")).where("y is not null and age is not null")


def battery_gate(items: DataFrame, n_items: int) -> DataFrame:
    """Any positive item makes a reporter; only a full battery of negatives makes a screen-negative; otherwise undecided."""
    per = items.groupBy("pid", "item").agg(F.max(F.col("y") > 0).alias("hit"))
    g = per.groupBy("pid").agg(F.bool_or("hit").alias("any_hit"), F.count("hit").alias("n_valid"))
    return g.select("pid", F.when(F.col("any_hit"), "reporter").when(F.col("n_valid") == n_items, "screen_negative").alias("gate"), "n_valid")


def breadth(gates: DataFrame, grounds: DataFrame) -> DataFrame:
    """Distinct grounds of reporters (at least one), -1 for screen-negatives."""
    n = grounds.groupBy("pid").agg(F.count_distinct("ground").alias("n"))
    j = gates.where("gate is not null").join(n, "pid", "left")
    return j.select(F.col("pid").alias("iid"), F.when(F.col("gate") == "screen_negative", F.lit(-1.0)).otherwise(F.col("n").cast("double")).alias("y")).where("y is not null")


def activity_minutes(days: dict[str, Column], minutes: dict[str, Column]) -> Column:
    """Weighted minutes over all activities; every one must be known."""
    total = F.lit(0.0)
    for name, w in fixed.ACTIVITY_WEIGHTS.items():
        total = total + days[name] * minutes[name] * F.lit(w)
    return total


def pack_years(cigarettes: Column, years: Column) -> Column:
    return F.when(cigarettes.between(0, 200) & years.between(0, 100), cigarettes / 20.0 * years)


def self_history(cases: DataFrame, completers: DataFrame) -> DataFrame:
    """1 for persons who name themselves, 0 for other completers of the screen."""
    c = cases.groupBy("pid").agg(F.min("age").alias("_c"))
    s = completers.groupBy("pid").agg(F.min("age").alias("_s"))
    j = s.join(c, "pid", "full_outer")
    return j.select(F.col("pid").alias("iid"), F.col("_c").isNotNull().cast("double").alias("y"), F.coalesce("_c", "_s").alias("age"))


def family_burden(chosen: DataFrame, completers: DataFrame, weights: dict[str, float] = fixed.RELATION_WEIGHTS) -> DataFrame:
    """Relatedness-weighted sum over the chosen relations; completers without an answer have 0, missing-only answers are dropped.

    `chosen` has pid, answer, age; every distinct answer text counts once.
    """
    table = F.create_map(*[F.lit(x) for kv in weights.items() for x in kv])
    rel = T.relation_norm("answer")
    miss = T.is_missing_answer("answer") | rel.isin(fixed.MISSING_ANSWERS)
    per = chosen.withColumn("rel", F.when(~miss, rel)).groupBy("pid", "answer", "rel").agg(F.min("age").alias("age"))
    w = F.coalesce(F.try_element_at(table, F.col("rel")), F.lit(0.0))
    score = per.groupBy("pid").agg(F.sum(F.when(F.col("rel").isNotNull(), w)).alias("score"), F.min("age").alias("age"), F.lit(True).alias("answered"))
    s = completers.groupBy("pid").agg(F.min("age").alias("_s"))
    j = s.join(score, "pid", "full_outer")
    y = F.when(F.col("answered").isNull(), F.lit(0.0)).otherwise(F.col("score"))
    return j.select(F.col("pid").alias("iid"), y.alias("y"), F.coalesce("age", "_s").alias("age")).where("y is not null")


def composite(responses: DataFrame, scale_items: DataFrame) -> DataFrame:
    """Scales from a scoring table: instrument, item, qid, place, value_lo, value_hi, reverse.

    An item can live under several questions: the first answered one (by place) counts. Reverse items are turned on their own
    range; more than half of the items must be answered.
    """
    size = scale_items.groupBy("instrument").agg(F.count_distinct("item").alias("n_items"))
    j = responses.join(scale_items, "qid")
    v = F.when(F.col("reverse"), F.col("value_lo") + F.col("value_hi") - F.col("y")).otherwise(F.col("y"))
    per = j.withColumn("v", v).where("v is not null").groupBy("instrument", "pid", "item").agg(F.min_by(F.struct("v", "age"), "place").alias("b"))
    s = per.groupBy("instrument", "pid").agg(F.count(F.lit(1)).alias("n_valid"), F.avg("b.v").alias("m"), F.max_by("b.age", "item").alias("age"))
    return s.join(size, "instrument").where(F.col("n_valid") >= F.floor(F.col("n_items") / 2) + 1).select(
        F.col("instrument").alias("pheno_id"), F.col("pid").alias("iid"), (F.col("m") * F.col("n_items")).alias("y"), "age", "n_valid"
    )


def any_yes(flags: list[Column]) -> Column:
    """True if any is true, false if some is known and none true, null if all are unknown."""
    known = F.array_compact(F.array(*flags))
    return F.when(F.size(known) > 0, F.exists(known, lambda x: x))


def sure_count(flags: list[Column], need: int) -> Column:
    """At least `need` true: true when reached, false when out of reach whatever the unknowns are, else null."""
    yes = sum((F.when(f, 1).otherwise(0) for f in flags[1:]), F.when(flags[0], 1).otherwise(0))
    unknown = sum((f.isNull().cast("int") for f in flags[1:]), flags[0].isNull().cast("int"))
    return F.when(yes >= need, True).when(yes + unknown < need, False)


def symptom_sum(values: list[Column], screen: Column, floor: float = 0.0) -> Column:
    """Prorated sum of the symptoms with a floor for screen-negatives; more than half must be known otherwise."""
    known = F.array_compact(F.array(*values))
    n = len(values)
    mean = F.aggregate(known, F.lit(0.0), lambda a, x: a + x) / F.size(known)
    return F.when(screen == 0, F.lit(float(floor))).when(F.size(known) >= n // 2 + 1, mean * n)


def hurdle(components: DataFrame, cols: list[str]) -> DataFrame:
    """-1 for screen-negatives; complete endorsers get the sum of z over components (population SD, a constant counts 0), moved so
    that its least value is 0. `components` has pid, gate ('endorser' or 'negative') and the components.
    """
    whole = components.where("gate = 'endorser'").dropna(subset=cols)
    one = whole.agg(*[F.avg(c).alias(f"_m_{c}") for c in cols], *[F.stddev_pop(c).alias(f"_s_{c}") for c in cols])
    z = F.lit(0.0)
    for c in cols:
        z = z + F.when(F.col(f"_s_{c}") > 0, (F.col(c) - F.col(f"_m_{c}")) / F.col(f"_s_{c}")).otherwise(0.0)
    scored = whole.crossJoin(F.broadcast(one)).select("pid", z.alias("z"))
    least = scored.agg(F.min("z").alias("_least"))
    top = scored.crossJoin(F.broadcast(least)).select(F.col("pid").alias("iid"), (F.col("z") - F.col("_least")).alias("y"))
    return top.unionByName(components.where("gate = 'negative'").select(F.col("pid").alias("iid"), F.lit(-1.0).alias("y")))


def chronicity(screen: Column, followup: Column) -> Column:
    """0 no episode, 1 one episode, 2 several; unknown follow-up of a yes is missing."""
    return F.when(screen == 0, 0.0).when((screen == 1) & (followup == 1), 1.0).when((screen == 1) & (followup > 1), 2.0)


def index_sum(anchor: Column, second: Column, third: Column) -> Column:
    """Anchor plus two components scaled to 0..1; the third is taken as full when the second is, and unknown parts are left out."""
    third_or_full = F.when(second == 1, F.lit(1.0)).otherwise(third)
    return F.when(anchor.isNotNull(), anchor + F.coalesce(second, F.lit(0.0)) + F.coalesce(third_or_full, F.lit(0.0)))


def membership(people: DataFrame, place: str, clusters: DataFrame) -> DataFrame:
    """A yes/no trait per cluster whose members are listed as 'a|b|c'; everyone with a known place counts.

    Members are exploded and matched by equality; non-members are completed per cluster name, a small dimension.
    """
    members = clusters.select("cluster", F.explode(F.split("members", r"\|")).alias("m")).select("cluster", F.trim("m").alias("m")).distinct()
    per_place = members.groupBy("m").agg(F.collect_set("cluster").alias("inside"))
    names = clusters.select("cluster").distinct().agg(F.array_sort(F.collect_set("cluster")).alias("names"))
    j = people.where(F.col(place).isNotNull()).join(per_place, F.col(place).cast("string") == F.col("m"), "left").crossJoin(F.broadcast(names))
    return j.select("iid", "age", "inside", F.explode("names").alias("cluster")).select(
        F.col("cluster").alias("pheno_id"), "iid", F.coalesce(F.array_contains("inside", F.col("cluster")), F.lit(False)).cast("double").alias("y"), "age"
    )


def area_traits(latest: DataFrame, cols: list[str]) -> DataFrame:
    """One numeric trait per area column of each person's latest row."""
    return latest.unpivot(["iid", "age"], cols, "pheno_id", "y").where("y is not null")


def code_trait(codes: DataFrame, case: list, control: list, ages: DataFrame) -> DataFrame:
    """Cases and controls by code, age from a separate table; other codes and persons without age are left out."""
    y = F.when(F.col("code").isin(case), 1.0).when(F.col("code").isin(control), 0.0)
    return codes.withColumn("y", y).where("y is not null").join(ages, "iid").select("iid", "y", "age")


def followup_binary(parent: DataFrame, followup: DataFrame, control_answers: list[str]) -> DataFrame:
    """One-vs-rest over follow-up options with controls from the parent question.

    A valid follow-up decides; without one, a parent answer off the gate is a control of every option; gate answers without a
    follow-up are left out. `followup` has pid, answer, age (a row per option), `parent` pid, answer, age.
    """
    f = followup.groupBy("pid").agg(F.collect_set(T.answer_norm("answer")).alias("chosen"), F.min("age").alias("age"))
    p = parent.where(T.answer_norm("answer").isin(control_answers)).groupBy("pid").agg(F.min("age").alias("page"))
    options = followup.agg(F.array_sort(F.collect_set(T.answer_norm("answer"))).alias("options"))
    j = f.join(p, "pid", "full_outer").crossJoin(F.broadcast(options))
    j = j.select("pid", "chosen", F.coalesce(F.when(F.col("chosen").isNotNull(), F.col("age")), F.col("page")).alias("age"), F.explode("options").alias("option"))
    return j.select("option", F.col("pid").alias("iid"), F.coalesce(F.array_contains("chosen", F.col("option")), F.lit(False)).cast("double").alias("y"), "age").where("age is not null")


def resolve_items(selected: DataFrame, concepts: DataFrame, texts: DataFrame) -> DataFrame:
    """Approved items: the concept decides, text only when no concept is given, disagreement or an unknown concept is invalid.

    `selected` has pid, qid, age, answers(text, concept); `concepts` qid, concept, value; `texts` label, value (label unique).
    Result per person and question: value, status scored / missing / invalid.
    """
    a = selected.select("pid", "qid", "age", F.explode("answers").alias("a")).select("pid", "qid", "age", F.trim(F.coalesce("a.concept", F.lit(""))).alias("concept"), T.norm_answer("a.text").alias("label"))
    a = a.join(concepts.select("qid", "concept", F.col("value").alias("cv"), F.lit(True).alias("c_hit")), ["qid", "concept"], "left")
    a = a.join(texts.select("label", F.col("value").alias("tv"), F.lit(True).alias("t_hit")), "label", "left")
    known = F.when(F.col("concept") != "", F.col("c_hit")).otherwise(F.col("t_hit"))
    clash = (F.col("concept") != "") & F.col("t_hit") & ~F.col("cv").eqNullSafe(F.col("tv"))
    bad = known.isNull() | F.coalesce(clash, F.lit(False))
    v = F.when(~bad, F.when(F.col("concept") != "", F.col("cv")).otherwise(F.col("tv")))
    g = a.select("pid", "qid", "age", bad.alias("bad"), v.alias("v")).groupBy("pid", "qid").agg(
        F.bool_or("bad").alias("bad"), F.min("v").alias("lo"), F.max("v").alias("hi"), F.bool_or(F.col("v").isNull() & ~F.col("bad")).alias("refused"), F.min("age").alias("age")
    )
    invalid = F.col("bad") | (F.col("lo") != F.col("hi")) | (F.col("refused") & F.col("lo").isNotNull())
    status = F.when(F.coalesce(invalid, F.lit(False)) | F.col("bad"), "invalid").when(F.col("lo").isNull(), "missing").otherwise("scored")
    return g.select("pid", "qid", F.when(status == "scored", F.col("lo")).alias("value"), status.alias("status"), "age")


def approved_composite(items: DataFrame, n_items: int) -> DataFrame:
    """Count over all items: invalid wins, then scored when complete, else incomplete."""
    g = items.groupBy("pid").agg(
        F.bool_or(F.col("status") == "invalid").alias("inv"), F.count("value").alias("observed"), F.sum("value").alias("total"),
        F.avg(F.when(F.col("status") == "scored", F.col("age"))).alias("age"),
    )
    status = F.when(F.col("inv"), "invalid").when(F.col("observed") == n_items, "scored").otherwise("incomplete")
    return g.select(F.col("pid").alias("iid"), F.when(status == "scored", F.col("total")).alias("y"), status.alias("status"), "observed", "age")


def stratified_trait(values: DataFrame, people: DataFrame, sex_01: int, suffix: str) -> DataFrame:
    """Trait restricted to one sex; persons whose sources disagree on the value are missing."""
    one = values.groupBy("pheno_id", "iid").agg(F.min("y").alias("lo"), F.max("y").alias("hi"), F.min("age").alias("age")).where("lo = hi")
    kept = one.join(people.where(F.col("sex_01") == sex_01).select("iid"), "iid", "left_semi")
    return kept.select(F.concat("pheno_id", F.lit(suffix)).alias("pheno_id"), "iid", F.col("lo").alias("y"), "age")


# Sex coding and status names.
PLOIDY_OF_SEX = {0: "XX", 1: "XY"}
SEX_STATUS = ["missing_or_nonbinary_sex_at_birth", "missing_wgs_sex_ploidy", "concordant_binary", "discordant_binary", "noncanonical_wgs_sex_ploidy"]


def sex_status(samples: DataFrame) -> DataFrame:
    """Reported sex (0 female, 1 male) against ploidy; the first status that applies."""
    reported, ploidy = F.col("reported"), F.col("ploidy")
    no_sex, no_ploidy, same, differs, other = SEX_STATUS
    expected = F.when(reported == 0, PLOIDY_OF_SEX[0]).when(reported == 1, PLOIDY_OF_SEX[1])
    status = (
        F.when(expected.isNull(), no_sex).when(F.coalesce(ploidy, F.lit("")) == "", no_ploidy).when(ploidy == expected, same)
        .when(ploidy.isin(list(PLOIDY_OF_SEX.values())), differs).otherwise(other)
    )
    return samples.withColumn("status", status)


#: Answers that withhold the sex at birth, and the ploidies of a male with one X.
WITHHELD = ["pmi skip", "i prefer not to answer"]
ONE_X = ["X0", "XO"]


def sex_additions(status: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Sex of concordant samples and of those that a rule adds, and an audit row per addition.

    status: iid, reported, ploidy, status and answer (to sex at birth). Added are reported males with one X, and samples that withheld the answer and whose ploidy is
    XX or XY; others without a reported sex are not.
    """
    base = status.where(F.col("status") == SEX_STATUS[2]).select("iid", F.col("reported").alias("sex_01"), F.lit("concordant").alias("source"))
    ploidy = F.upper(F.trim(F.coalesce("ploidy", F.lit(""))))
    label = F.trim(F.regexp_replace(F.lower(F.coalesce("answer", F.lit(""))), r"[_:\s]+", " "))
    withheld = F.col("reported").isNull() & label.isin(WITHHELD)
    rule = (
        F.when((F.col("reported") == 1) & ploidy.isin(ONE_X), "assigned_male_x0_xo").when(withheld & (ploidy == PLOIDY_OF_SEX[0]), "withheld_xx")
        .when(withheld & (ploidy == PLOIDY_OF_SEX[1]), "withheld_xy")
    )
    audit = status.join(base.select("iid"), "iid", "left_anti").withColumn("rule", rule).where("rule is not null")
    audit = audit.select("iid", F.when(F.col("rule") == "withheld_xx", 0).otherwise(1).alias("sex_01"), "rule", "answer", "ploidy", "status")
    return base.unionByName(audit.select("iid", "sex_01", F.lit("imputed").alias("source"))), audit


def select_builders(builders: dict, requested: list[str]) -> DataFrame:
    """The requested traits from the builders that can make them; builders of no requested trait are never planned.

    builders: prefix of trait ids to a function that returns rows with pheno_id; requested: trait ids, or prefixes that end in an underscore.
    """
    wanted = lambda t: F.col("pheno_id").startswith(t) if t.endswith("_") else F.col("pheno_id") == t
    parts = []
    for name, make in builders.items():
        mine = [t for t in requested if t.startswith(f"{name}_")]
        if mine:
            parts.append(make().where(reduce(lambda a, b: a | b, map(wanted, mine))).withColumn("builder", F.lit(name)))
    if not parts:
        raise ValueError("no builder makes the requested traits")
    return union_all(parts)
