"""A cross-section of the registered queries against DuckDB on the smallest data, and the shape of the registry."""

import itertools
import os

import duckdb
import pytest

import __spark_entry__ as E
from cohortloom.plans import catalog, roles
from tools import check

SF = "/root/testdata/sf0.001"
NAMES = [
    "flagship_trait_residuals", "S1_delimited_scan", "S3_multi_source_responses", "S6_partitioned_sink", "S9_pending_work", "P3_content_tokens", "P8_relation_label", "P20_right_trim",
    "J2_attrition", "J6_same_time_pair", "J9_range_exclusion", "A4_trial_rates", "A7_distribution", "A14_filter_ladder", "A20_option_count", "W1_latest_valid", "W6_strict_best",
    "B2_complement_collapse", "B13_composite_scales", "B16_hurdle", "B27_catalog_classes", "T2_residualize", "T16_pattern_scores", "G2_component_table", "V3_multiallelic_split", "V10_association", "M11_fold_safe_calibration",
    "S12_file_fingerprint", "S12_row_tree", "U4_ledger", "B1_sparse_batch", "B14_criteria", "B26_sex_audit", "B31_answer_coverage", "T22_model_comparison", "V6_ld_prune", "M1_sparse_vectors",
]
ROWS_ONLY = {
    "S12_fingerprint", "T15_one_factor_score", "T21_component_candidate", "G3_unrelated_set",
    "V7_fitted_components", "V10_association_p", "M4_fold_assignment", "M5_cross_fitted_scores", "M8_residual_boost", "M9_stable_split", "M10_direct_fit",
}


def test_registry_is_complete():
    """The corpus operators may be absent; they have a test of their own."""
    assert set(catalog.QUERIES) - set(catalog.ORACLES) == ROWS_ONLY
    assert set(catalog.QUERIES) <= set(E.queries()) and set(E.oracle_sql()) <= set(E.queries())


@pytest.fixture(scope="module")
def duck():
    if not os.path.isdir(SF):
        pytest.skip("no test data")
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in check.TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", NAMES)
def test_matches_duckdb(spark, duck, name):
    df = catalog.QUERIES[name](spark, SF)
    cols = sorted(df.columns)
    got = sorted("|".join(check.cell(x) for x in row) for row in df.select(*[f"`{c}`" for c in cols]).collect())
    cur = duck.execute(catalog.ORACLES[name])
    names = [d[0] for d in cur.description]
    order = [names.index(c) for c in cols]
    assert got == sorted("|".join(check.cell(row[i]) for i in order) for row in cur.fetchall())


def test_compact_sink_round_trip(spark, tmp_path):
    from cohortloom.sources import sinks

    ref = spark.createDataFrame([("rs1", "1", 5, "A", "G", 0.2), ("rs2", "2", 7, "C", "T", 0.3)], "rsid string, chrom string, pos long, allele1 string, allele2 string, a1freq double")
    stats = spark.createDataFrame([("t1", "rs1", 0.5, 0.1, 10), ("t2", "rs2", -0.5, 0.1, 11)], "pheno_id string, rsid string, beta double, se double, n long")
    sinks.write_compact(stats, ref, str(tmp_path / "out"))
    back = spark.read.parquet(str(tmp_path / "out" / "traits"))
    assert dict(back.dtypes) == {"rsid": "string", "beta": "float", "se": "float", "n": "int", "pheno_id": "string"} and back.count() == 2


def test_fingerprint_ignores_order_and_sees_change(spark):
    from cohortloom.sources import sinks

    a = spark.range(50).selectExpr("id", "id * 2 as v")
    b = a.orderBy("v", ascending=False).repartition(3)
    c = a.selectExpr("id", "case when id = 3 then 0 else v end as v")
    one, two, three = (sinks.fingerprint(x).first() for x in (a, b, c))
    assert one == two and one != three
    left, right = (sinks.fingerprint(spark.createDataFrame([row], "a string, b string")).first() for row in (("x", None), (None, "x")))
    assert left != right


def test_checked_inputs_fail(spark):
    from cohortloom.operators import joins
    from cohortloom.sources import tables

    df = spark.createDataFrame([("a",), ("a",)], "k string")
    with pytest.raises(ValueError):
        tables.read_id_list(df, "k")
    with pytest.raises(ValueError):
        joins.validated_join(df, df, ["k"])
    with pytest.raises(ValueError):
        tables.require_columns(df, ["missing"])


def test_trait_means_on_a_half_do_not_depend_on_the_order_of_orders(spark, tmp_path):
    prices = [1000.10, 2000.20, 3014.70]  # 2.005 thousand on average
    orders = [(k, "1-URGENT", p) for k, some in enumerate(itertools.permutations(prices)) for p in some] + [(9, "1-URGENT", 264715.0), (10, "1-URGENT", -2005.0), (11, "1-URGENT", None)]
    spark.createDataFrame(orders, "o_custkey long, o_orderpriority string, o_totalprice double").coalesce(1).write.parquet(f"{tmp_path}/orders.parquet")
    want = {**{k: 2.01 for k in range(6)}, 9: 264.72, 10: -2.01, 11: None}
    assert {r.iid: r.y for r in roles.exact_traits(spark, str(tmp_path)).collect()} == want
    con = duckdb.connect()
    con.execute(f"CREATE VIEW orders AS SELECT * FROM '{tmp_path}/orders.parquet/*.parquet'")
    assert dict(con.execute(roles.sql("exact_traits", "SELECT iid, y FROM exact_traits")).fetchall()) == want
    assert "exact_traits" in catalog.ORACLES["T4_eligibility"]
