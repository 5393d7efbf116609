"""Improbable-feature digests against a plain reading of the method, window by window."""

import base64
import hashlib
import math
import random
from collections import Counter

import numpy as np
import pytest
from conftest import rows_of
from pyspark.sql import functions as F

import __spark_entry__ as E
from cohortloom.llm import fingerprints as fp

SF = "/root/testdata/sf0.001"


def plain_entropies(data):
    weight = [round(c * math.log2(c or 1) * 4096) for c in range(fp.WINDOW + 1)]
    top = weight[fp.WINDOW]
    return [(top - sum(weight[c] for c in Counter(data[i:i + fp.WINDOW]).values())) * fp.LEVELS // top for i in range(len(data) - fp.WINDOW + 1)]


def plain_ranks(texts):
    n = Counter(e for t in texts for e in plain_entropies(t))
    order = sorted(range(fp.LEAST, fp.LEVELS + 1), key=lambda k: (n[k], k))
    return {k: i for i, k in enumerate(order)}


def plain_features(data, ranks):
    rank = [ranks.get(e) for e in plain_entropies(data)]
    votes = Counter()
    for start in range(-fp.AROUND + 1, len(rank)):
        near = [(rank[i], i) for i in range(max(0, start), min(len(rank), start + fp.AROUND)) if rank[i] is not None]
        if near:
            votes[min(near)[1]] += 1
    return [i for i in sorted(votes) if votes[i] >= fp.VOTES]


def texts_of(corpus):
    r = random.Random(2)
    tough = ["a" * 500, "ab" * 300 + "The end of it all, at last and truly so.", "x", "", "short text", bytes(r.randrange(1, 128) for _ in range(3000)).decode()]
    return [(t or "").encode() for t in corpus if t is None or len(t) < 5000] + [t.encode() for t in tough]


def test_features_equal_a_plain_search(corpus):
    data = texts_of(corpus)
    at = np.concatenate([[0], np.cumsum([len(d) for d in data])])
    raw = np.frombuffer(b"".join(data), np.uint8)
    counts = fp.histogram(raw, at)
    assert {k: int(v) for k, v in enumerate(counts) if v} == Counter(e for t in data for e in plain_entropies(t))
    ranks = plain_ranks(data)
    table = np.full(fp.LEVELS + 1, fp.NEVER, np.uint32)
    table[list(ranks)] = list(ranks.values())
    want = [int(a) + i for a, d in zip(at, data) for i in plain_features(d, ranks)]
    assert fp.features(raw, at, table).tolist() == want


def test_blocks_do_not_change_the_choice(corpus, monkeypatch):
    data = b"".join(texts_of(corpus))
    raw, at = np.frombuffer(data, np.uint8), np.array([0, 700, len(data)])
    ranks = np.arange(fp.LEVELS + 1, dtype=np.uint32) % fp.NEVER
    whole, count = fp.features(raw, at, ranks), fp.histogram(raw, at)
    monkeypatch.setattr(fp, "BLOCK", 97)
    assert fp.features(raw, at, ranks).tolist() == whole.tolist() and (fp.histogram(raw, at) == count).all()


def plain_likeness(a, b):
    def filters(text):
        return [(int(p.split(".")[0]), int.from_bytes(base64.b64decode(p.split(".")[1]), "big")) for p in text.split(",")] if text else []

    a, b = filters(a), filters(b)
    if not a or not b:
        return float(not a and not b)
    if sum(n for n, _ in a) > sum(n for n, _ in b):
        a, b = b, a
    total = 0
    for n, x in a:
        best = 0
        for _, y in b:
            most, large = sorted((x.bit_count(), y.bit_count()))
            p = large / fp.BITS
            chance = min(most * p + 3 * math.sqrt(most * p * (1 - p)), most - 0.5)
            best = max(best, min(1, ((x & y).bit_count() - chance) / (most - chance)))
        total += n * best
    return total / sum(n for n, _ in a)


def check(got, texts, order):
    """got: rows by id; order: ids, each followed by its neighbour."""
    for here, there in zip(order, [*order[1:], order[0]]):
        r, text, other = got[here], texts[here] or "", texts[there] or ""
        half = len(text) // 2
        edited = text[:len(text) - half] + other[:half]
        assert r.n_chars == len(text) and r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert r.near_edited == pytest.approx(plain_likeness(r.fingerprint, r.edited_fingerprint), abs=1e-9)
        assert r.near_next == pytest.approx(plain_likeness(r.fingerprint, got[there].fingerprint), abs=1e-9)


@pytest.mark.parametrize("size", [1 << 20, 500])
def test_neighbours(make, corpus, monkeypatch, size):
    monkeypatch.setattr(fp, "BUCKET", size)
    docs = make(rows_of(corpus))
    rows = fp.beside_next(docs).collect()
    got = {r.doc_id: r for r in rows}
    assert len(rows) == len(got) == len(corpus)
    check(got, dict(enumerate(corpus)), sorted(got, reverse=True))
    by_text = {}
    for r in rows:
        assert by_text.setdefault(corpus[r.doc_id] or "", r.fingerprint) == r.fingerprint
    plain = {r.doc_id: (r.n_chars, r.fingerprint) for r in fp.fingerprint(docs).collect()}
    assert plain == {k: (r.n_chars, r.fingerprint) for k, r in got.items()}
    again = fp.fingerprint(docs).select("doc_id", fp.alike("fingerprint", "fingerprint").alias("same")).collect()
    assert all(r.same == 1 for r in again)


def test_repeated_and_null_ids(make, monkeypatch):
    monkeypatch.setattr(fp, "BUCKET", 100)
    rows = rows_of(["one text " * 9] * 30, first=0)
    rows = [(5 if k < 20 else None, f"{t}{k % 4}", *r) for k, (_, t, *r) in enumerate(rows)] + rows_of(["last of all", None], first=9)
    got = fp.beside_next(make(rows)).collect()
    assert len(got) == 32 and sorted(r.doc_id for r in got if r.doc_id is not None) == [5] * 20 + [9, 10]
    assert sum(r.near_next == 1 for r in got) >= 22  # copies lie side by side


def test_lone_and_no_document(make):
    one = fp.beside_next(make(rows_of(["some words"]))).collect()
    assert [(r.doc_id, r.near_next, r.edited_sha256) for r in one] == [(0, 1.0, hashlib.sha256(b"some some ").hexdigest())]
    assert fp.beside_next(make(rows_of(["x"])).where(F.lit(False))).count() == 0


def test_query_tells_edits_from_strangers(spark):
    got = {r.doc_id: r for r in E.queries()["op12_document_fingerprints"](spark, SF).collect()}
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()}
    check(got, texts, sorted(got, reverse=True))
    long = [r for r in got.values() if r.n_chars >= 400]
    assert np.mean([r.near_edited > r.near_next for r in long]) > 0.95
    assert np.median([r.near_edited for r in long]) > 0.25 and np.median([r.near_next for r in long]) < 0.02
