"""Hash trees and the manifest ledger."""

import hashlib

import pytest

from cohortloom.sources import ledger as L


def plain(leaves):
    """Digest of hex leaves by plain sums."""
    nodes = {}
    for h in leaves:
        n, a, b = nodes.get(h[:2], (0, 0, 0))
        nodes[h[:2]] = (n + 1, a + int(h[:15], 16), b + int(h[15:30], 16))
    return hashlib.md5(",".join(f"{k}:{n}:{a}:{b}" for k, (n, a, b) in sorted(nodes.items())).encode()).hexdigest()


def test_file_signatures_do_not_depend_on_the_split(spark, tmp_path):
    data = bytes(range(256)) * 700 + b"\r\n\n" + b"tail without end"
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.bin").write_bytes(data)
    (tmp_path / "in" / "b.txt").write_bytes(b"one\ntwo\n")
    found = []
    for size in ("4k", "64k", "128m"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        found.append({r.grp: (r.n_bytes, r.n_leaves, r.digest) for r in L.file_tree(spark, f"{tmp_path}/in").collect()})
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    want = {"a.bin": data.split(b"\n"), "b.txt": [b"one", b"two"]}
    assert found[0] == found[1] == found[2] == {k: (len(data) if k == "a.bin" else 8, len(v), plain(hashlib.md5(x).hexdigest() for x in v)) for k, v in want.items()}
    (tmp_path / "in" / "b.txt").write_bytes(b"one\ntwp\n")
    assert {r.grp: r.digest for r in L.file_tree(spark, f"{tmp_path}/in").collect()}["b.txt"] != found[0]["b.txt"][2]


def test_rows_that_look_alike_have_other_leaves(spark):
    one, two, three = (L.row_tree(spark.createDataFrame([row], "a string, b string")).first().digest for row in (("x1:", None), ("x", "1:"), (None, "x1:")))
    assert len({one, two, three}) == 3


def test_first_id_wins_and_reserved_ids_fail(spark):
    rows = spark.createDataFrame([("t1", 3, "late"), ("t1", 1, "first"), ("t2", 2, "only")], "pheno_id string, place int, note string")
    kept, skipped = L.settle(rows, spark.createDataFrame([("t2",)], "pheno_id string"))
    assert sorted(map(tuple, kept.collect())) == [("t1", 1, "first"), ("t2", 2, "only")]
    assert [tuple(r) for r in skipped.collect()] == [("t1", 3, "late", "duplicate_pheno_id")]
    with pytest.raises(ValueError, match="t1"):
        L.settle(rows, spark.createDataFrame([("t1",)], "pheno_id string"))


def test_versions_appear_at_once_and_a_rerun_adds_none(spark, tmp_path):
    folder = str(tmp_path / "ledger")
    df = lambda *rows: spark.createDataFrame(list(rows), "pheno_id string, n int")
    assert [L.publish(df(("a", 1), ("b", 2)), folder), L.publish(df(("b", 2), ("a", 1)), folder), L.publish(df(("a", 1)), folder)] == [1, 1, 2]
    (tmp_path / "ledger" / "dataleft").mkdir()  # what a failed run leaves is not a version
    assert L.current(spark, folder).collect() == [("a", 1)] and sorted(L.versions(spark, folder)) == [1, 2]
