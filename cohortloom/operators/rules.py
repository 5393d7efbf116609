"""Rule tables applied as joins: answer to value, catalog classification, reserved ids, trait dictionary."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fixed
from ..functions import text as T


def answer_candidates(answer: str | Column, dash: Column) -> Column:
    """Spellings tried in order: the normalized answer, what precedes ';', and 'N to M' as 'N-M' for rules that ask for it."""
    key = T.answer_norm(answer)
    head = F.when(key.contains(";"), F.trim(F.substring_index(key, ";", 1)))
    dash = F.when(dash & key.rlike(r"\A[0-9]+[ ]+to[ ]+[0-9]+\z"), F.regexp_replace(key, r"\A([0-9]+)[ ]+to[ ]+([0-9]+)\z", "$1-$2"))
    return F.array_compact(F.array(key, head, dash))


def apply_rules(df: DataFrame, rules: DataFrame, overrides: DataFrame | None = None) -> DataFrame:
    """Value of each row's answer under its named rule.

    `df` has rule and answer; `rules` has rule, label, value, local_missing, and optionally dash (the rule reads 'N to M' as 'N-M');
    `overrides` has rule, label, value and is asked after the rule's own labels. A locally missing spelling makes the answer missing,
    whatever an override says. Distinct (rule, answer) pairs are resolved once and joined back, so the work on text does not grow
    with the rows.
    """
    keys = ["rule", "answer"]
    asked = df.select(*keys).distinct()
    if "dash" in rules.columns:
        asked = asked.join(rules.groupBy("rule").agg(F.bool_or("dash").alias("_dash")), "rule", "left")
    else:
        asked = asked.withColumn("_dash", F.lit(False))
    cands = asked.select(*keys, F.posexplode(answer_candidates("answer", F.coalesce("_dash", F.lit(False)))).alias("try", "label"))
    hit = cands.join(rules.select("rule", "label", "value", "local_missing"), ["rule", "label"], "left")
    first = F.min_by("value", F.when(F.col("value").isNotNull() & ~F.coalesce("local_missing", F.lit(False)), F.col("try")))
    aggs = [F.coalesce(F.bool_or("local_missing"), F.lit(False)).alias("_missing"), first.alias("_by_rule")]
    if overrides is not None:
        own = overrides.select("rule", "label", F.col("value").alias("_own"))
        hit = hit.join(own, ["rule", "label"], "left")
        aggs.append(F.min_by("_own", F.when(F.col("_own").isNotNull(), F.col("try"))).alias("_own"))
    per = hit.groupBy(*keys).agg(*aggs)
    found = F.coalesce("_by_rule", "_own") if overrides is not None else F.col("_by_rule")
    value = F.when(~F.col("_missing"), found)
    cond = [F.col(f"d.{k}").eqNullSafe(F.col(f"v.{k}")) for k in keys]
    return df.alias("d").join(per.select(*keys, value.alias("value")).alias("v"), cond, "left").select("d.*", "v.value")


def ordinal_trait(single: DataFrame, live: DataFrame, items: DataFrame, texts: DataFrame, fallback: bool = True) -> DataFrame:
    """Ordinal value of single answers, first source that knows it: live override, item table, question text table, text scale.

    `single` has pid, qid, item, question, answer, age; live and items have item, label, value; texts has question, label, value.
    """
    kinds = single.select("item", "question", "answer").distinct()
    k = kinds.withColumn("label", T.answer_norm("answer")).withColumn("_q", T.norm_question("question"))
    k = k.join(live.select("item", "label", F.col("value").alias("_a")), ["item", "label"], "left")
    k = k.join(items.select("item", "label", F.col("value").alias("_b")), ["item", "label"], "left")
    k = k.join(texts.select(T.norm_question("question").alias("_q"), "label", F.col("value").alias("_c")), ["_q", "label"], "left")
    last = T.text_ordinal("answer") if fallback else F.lit(None).cast("double")
    k = k.select("item", "question", "answer", F.coalesce("_a", "_b", "_c", last).alias("y")).where("y is not null")
    return single.join(k, ["item", "question", "answer"]).select("pid", "qid", "item", "y", "age")


def harmonize(df: DataFrame, mapping: DataFrame, key: str = "y") -> DataFrame:
    """Values of one source scale on another; unlisted values are dropped."""
    return df.join(mapping.select(F.col("source").alias(key), "target"), key).drop(key).withColumnRenamed("target", key)


def classify_catalog(items: DataFrame, rules: DataFrame, nominal: DataFrame, excluded: str) -> DataFrame:
    """What becomes of each question: excluded, numeric, binary only, nominal, ordinal and binary, or review.

    `items` has item, survey (optional, searched for topics as well), field_label, phenotype_class, options; `rules` has rule, label, value, local_missing, confidence and priority.
    A rule fits when it knows every informative option and gives at least 3 levels, or 2 when signed; the first fitting rule wins.
    """
    opts = items.select("item", F.explode(T.parse_options("options")).alias("o")).select("item", T.norm_answer("o.label").alias("label"), T.is_missing_answer("o.label").alias("miss"))
    core = opts.where("not miss").select("item", "label").distinct()
    n_core = opts.groupBy("item").agg(F.count_if(~F.col("miss")).alias("n_core"))
    n_labels = core.groupBy("item").agg(F.count(F.lit(1)).alias("n_labels"))
    fits = (
        core.join(rules, "label")
        .groupBy("item", "rule", "priority", "confidence")
        .agg(
            F.count_distinct("label").alias("known"), F.count_distinct(F.when(~F.col("local_missing"), F.col("value"))).alias("levels"),
            F.min(F.when(~F.col("local_missing"), F.col("value"))).alias("lowest"),
        )
        .join(n_labels, "item")
        .where((F.col("known") == F.col("n_labels")) & (F.col("levels") >= F.when(F.col("lowest") < 0, 2).otherwise(3)))
    )
    best = fits.groupBy("item").agg(F.min_by(F.struct("rule", "levels", "confidence"), F.struct("priority", "rule")).alias("b")).select("item", "b.*")
    out = items.join(n_core, "item", "left").join(best, "item", "left").join(nominal.select("item", F.lit(True).alias("_nominal")), "item", "left")
    cls, n = F.col("phenotype_class"), F.coalesce("n_core", F.lit(0))
    by_class = F.create_map(*[F.lit(x) for pair in fixed.CLASS_DISPOSITIONS.items() for x in pair])
    disposition = (
        F.when(by_class[cls].isNotNull(), by_class[cls])
        .when(F.col("field_label").rlike(excluded), "excluded_race_pii_admin")
        .when(cls == "numeric_text", "numeric")
        .when(cls == "multi_select", "binary_only")
        .when(~cls.isin("single_select", "slider"), "excluded_other")
        .when(n < 2, "excluded_degenerate")
        .when(F.col("_nominal"), "nominal_binary")
        .when(F.col("rule").isNotNull(), "ordinal_and_binary")
        .when(n == 2, "binary_only")
        .otherwise("flagged_review")
    )
    is_ord = disposition == "ordinal_and_binary"
    return out.select(
        "item", disposition.alias("disposition"), n.alias("n_core"), F.when(is_ord, F.col("rule")).alias("rule"), F.when(is_ord, F.col("levels")).alias("levels"),
        F.array_join(T.tag_topics(F.concat_ws(" ", "survey", "field_label") if "survey" in items.columns else F.col("field_label")), ";").alias("topics"),
    )


def check_reserved(manifest: DataFrame, definitions: DataFrame) -> DataFrame:
    """Manifest rows that use a reserved id for another construction."""
    d = definitions.select("pheno_id", F.col("construction_id").alias("expected"))
    return manifest.join(d, "pheno_id").where(~F.col("construction_id").eqNullSafe(F.col("expected")))


def assert_reserved(manifest: DataFrame, definitions: DataFrame) -> None:
    bad = [row["pheno_id"] for row in check_reserved(manifest, definitions).select("pheno_id").limit(5).collect()]
    if bad:
        raise ValueError(f"reserved ids in use: {bad}")


def sex_rules(meta: DataFrame, rules: DataFrame) -> DataFrame:
    """Item-level sex filters; a filtered trait is adjusted for age and components only. An unknown filter fails, rows without an item included."""
    j = meta.join(rules.select("item", F.lower(F.trim("sex_filter")).alias("_f")), "item", "left")
    f = F.when(F.lower(F.trim(F.coalesce("sex_filter", F.lit("all")))) != "all", F.lower(F.trim("sex_filter"))).otherwise(F.coalesce("_f", F.lit("all")))
    known = f.isin(fixed.SEX_FILTERS)
    f = F.when(known, f).otherwise(F.raise_error(F.concat(F.lit("invalid sex_filter: "), f)).cast("string"))
    return j.withColumn("sex_filter", f).withColumn("covar_mode", F.when(F.col("sex_filter") != "all", F.lit("agepc")).otherwise(F.col("covar_mode"))).drop("_f")


def trait_dictionary(answers: DataFrame, made: DataFrame, skipped: DataFrame) -> DataFrame:
    """Data dictionary row per question and answer: wording and the trait that was run or skipped for it."""
    status = made.select("pheno_id", F.lit("run").alias("status")).unionByName(skipped.select("pheno_id", F.lit("skipped").alias("status")))
    j = answers.join(status, "pheno_id", "left")
    return j.select(
        "qid", "answer", "pheno_id", F.coalesce("status", F.lit("not built")).alias("status"),
        F.concat(F.lit("case: answered '"), F.col("answer"), F.lit("'; control: any other valid answer")).alias("definition"),
    )
