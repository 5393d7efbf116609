"""Registered corpus queries: DuckDB where SQL exists, shapes, and the pipeline end to end."""

import duckdb
import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in ("documents", "benchmark", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def test_all_operators_and_the_pipeline_are_registered():
    names = set(E.queries())
    assert all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 14)) and "pipeline" in names


@pytest.mark.parametrize("name", ["op5_license_scan", "op9_mixing", "op11_centroid_clustering"])
def test_matches_duckdb(spark, duck, name):
    got = E.queries()[name](spark, SF)
    cols = sorted(got.columns)
    want = duck.execute(E.oracle_sql()[name]).df()
    rows = lambda df: sorted(map(str, df[cols].astype(object).where(df[cols].notna(), None).values.tolist()))
    assert rows(got.toPandas()) == rows(want)


def test_pipeline_stages(spark):
    import corpus_pipeline as P
    from cohortloom.session import cut

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    for name, stage in P.STAGES:
        before = docs
        docs = cut(stage(spark, before, SF))
        if name != P.STAGES[-1][0]:
            assert docs.columns == columns
            assert docs.select("doc_id", "text").exceptAll(docs.select("doc_id", "text").intersectAll(before.select("doc_id", "text"))).count() == 0 or name.startswith("mixing")
            assert docs.join(before.select("doc_id").distinct(), "doc_id", "left_anti").count() == 0
        else:
            assert docs.count() == before.count()
    assert docs.count() > 0
