"""Repeated strings, near duplicates, benchmark leaks, personal data, licences, language model, quality: against brute force."""

import hashlib
import itertools
import functools
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from conftest import rows_of  # noqa: F401
from pyspark.sql import functions as F

from cohortloom.llm import decontaminate, licenses, lm, ngram_join, pii, quality, suffix_dedup


@pytest.mark.parametrize("size", [400, 30])
def test_repeated_strings(make, corpus, size):
    docs = make(rows_of(corpus))
    got = {r.doc_id: r for r in suffix_dedup.deduplicate(docs, size=size).collect()}
    raw = {i: (t or "").encode() for i, t in enumerate(corpus)}
    seen = Counter(r[p:p + size] for r in raw.values() for p in range(len(r) - size + 1))
    for i, r in raw.items():
        hit = bytearray(len(r))
        for p in range(len(r) - size + 1):
            if seen[r[p:p + size]] > 1:
                hit[p:p + size] = b"\1" * size
        g = got[i]
        assert (g.n_bytes, g.n_removed, bytes(g.kept)) == (len(r), sum(hit), bytes(c for c, h in zip(r, hit) if not h))
        assert g.n_spans == len(re.findall(b"\x01+", bytes(hit)))
    assert suffix_dedup.deduplicate(make([])).count() == 0


def brute_classes(texts):
    sets, where = {}, defaultdict(list)
    for i, t in texts.items():
        w = (t or "").encode().lower().split()
        sets[i] = {tuple(w[k:k + 5]) for k in range(max(len(w) - 4, 1))} if w else set()
        for x in sets[i]:
            where[x].append(i)
    root = {i: i for i in texts}

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    for i, s in sets.items():
        for j, v in Counter(j for x in s for j in where[x] if j < i).items():
            if 100 * v >= 75 * (len(s) + len(sets[j]) - v):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return {i: (len(sets[i]), find(i)) for i in texts}


@pytest.mark.parametrize("rare,pair_size", [(16, 64), (1, 256), (1, 40), (2, 4)])
def test_shingle_classes(make, corpus, rare, pair_size):
    """Also with hardly any token rare, so that combinations and large sets take their own ways."""
    r = random.Random(3)
    texts = list(corpus)
    for k in range(12):  # a chain of ever more changed copies, and sets near the threshold
        words = texts[9].split() + [f"x{k}{i}" for i in range(k * 3)]
        texts.append(" ".join(words))
        words = corpus[8].split()
        for _ in range(k):
            words[r.randrange(len(words))] = "y"
        texts.append(" ".join(words))
    got = {row.doc_id: (row.n_shingles, row.component_id) for row in ngram_join.classes(make(rows_of(texts)), rare=rare, pair_size=pair_size).collect()}
    assert got == brute_classes(dict(enumerate(texts)))


def test_texts_are_parsed_once_for_blocks_and_once_for_windows(spark, make, monkeypatch):
    r = random.Random(4)
    own = lambda: "".join(r.choice("abcdefghij ") for _ in range(500))
    passage = own() + own()
    docs = make(rows_of([own() + passage + own() for _ in range(12)]))
    parsed, picked = [], suffix_dedup._picked

    def counted(docs, mixed, size, names, rows_of):
        calls = spark.sparkContext.accumulator(0)
        parsed.append(calls)

        def rows(*args):
            calls.add(1)
            yield from rows_of(*args)

        return picked(docs, mixed, size, names, rows)

    monkeypatch.setattr(suffix_dedup, "_picked", counted)
    assert all(x.n_removed >= 1000 for x in suffix_dedup.deduplicate(docs, size=400).collect())
    assert [x.value for x in parsed] == [12, 12]


def test_texts_that_share_a_frequent_passage_are_not_paired(make, monkeypatch):
    """Two thirds of each text are one passage: its tokens are frequent wherever their hashes lie."""
    passage = " ".join(f"p{k}" for k in range(100))
    texts = [" ".join(f"own{i}x{k}" for k in range(45)) + " " + passage for i in range(150)]
    made, pairs = [], ngram_join._pairs
    monkeypatch.setattr(ngram_join, "_pairs", lambda found: made.append(found.count()) or pairs(found))
    got = {row.doc_id: (row.n_shingles, row.component_id) for row in ngram_join.classes(make(rows_of(texts))).collect()}
    assert got == {i: (141, i) for i in range(len(texts))}
    assert sum(made) <= 2 * len(texts)


def test_parities_lose_no_link(make, monkeypatch):
    """Edited copies around the threshold, apart after the first round."""
    monkeypatch.setattr(ngram_join, "FEW", 1)
    r = random.Random(11)
    base = [f"b{k}" for k in range(140)]
    texts = []
    for i in range(60):
        words = list(base)
        for k in r.sample(range(140), r.randrange(2, 9)):
            words[k] = f"e{i % 7}x{k}"
        texts.append(" ".join(words))
    got = {row.doc_id: (row.n_shingles, row.component_id) for row in ngram_join.classes(make(rows_of(texts))).collect()}
    assert got == brute_classes(dict(enumerate(texts)))


def test_one_per_class(make, corpus):
    rows = rows_of(corpus) + rows_of([corpus[0]])  # a repeated row
    docs = make(rows)
    kept = ngram_join.one_per_class(docs)
    assert kept.columns == docs.columns
    want = {i for i, (_, c) in brute_classes(dict(enumerate(corpus))).items() if i == c}
    assert sorted(r.doc_id for r in kept.collect()) == sorted(want)
    assert ngram_join.classes(make([])).count() == 0


def test_one_per_class_with_repeated_and_missing_ids(make):
    """Rows are told apart by id and text; a class loses all but its first row, whatever ids they have."""
    text = lambda k: " ".join(f"{k}{i}" for i in range(40))
    near = lambda k: text(k) + " more"
    rows = [(5, text("a")), (5, near("b")), (3, text("b")), (6, text("c")), (6, near("c")), (None, text("d")), (None, near("d")), (None, near("d")), (7, near("e")), (None, text("e")), (8, ""), (8, ""), (None, ""), (None, None)]
    docs = make([(i, t, "en", "s", 1, 7, "w", "k", 3, 9, 5, "x") for i, t in rows])
    kept = [(r.doc_id, r.text) for r in ngram_join.one_per_class(docs).collect()]
    assert len(kept) == 8 and {(5, text("a")), (3, text("b")), (7, near("e")), (8, ""), (None, ""), (None, None)} <= set(kept)
    assert sum(r in ((6, text("c")), (6, near("c"))) for r in kept) == 1 and sum(r in ((None, text("d")), (None, near("d"))) for r in kept) == 1


def test_leaks_are_found_and_clean_stay(spark, make, corpus):
    r = random.Random(9)
    items = [" ".join(r.choice("alpha beta gamma delta eps zeta eta theta iota kappa mu nu xi omicron pi rho".split()) + str(r.randint(0, 40)) for _ in range(n)) for n in (20, 40, 13, 9, 5)]
    bench = spark.createDataFrame([(i, t) for i, t in enumerate(items)] + [(99, items[0]), (50, None), (51, "")], "item_id long, text string")
    swapped = items[1].split()
    for k in (3, 9, 14, 21, 30):
        swapped[k] = "other"
    texts = [corpus[20] + " " + items[0].upper() + "! " + corpus[21], "x y " + ", ".join(items[2].split()) + " z", " ".join(swapped), " ".join(items[1].split()[:20]), items[3], items[4] * 3, " ".join(items[1].split()[:7]) + " " + corpus[22], corpus[23], None, ""]
    docs = make(rows_of(texts))
    got = {(x.doc_id, x.item_id) for x in decontaminate.hits(docs, bench).collect()}
    assert got == {(0, 0), (1, 2), (2, 1), (3, 1), (4, 3)}
    assert got == {(x.doc_id, x.item_id) for x in decontaminate.hits(docs, bench, broadcast_rows=0).collect()}
    kept = decontaminate.clean(docs, bench)
    assert kept.columns == docs.columns and {x.doc_id for x in kept.collect()} == {5, 6, 7, 8, 9}
    assert decontaminate.hits(make([]), bench).count() == 0 and decontaminate.hits(docs, bench.limit(0)).count() == 0


def test_masks_cover_all_that_is_accepted():
    """Every pattern of substituted words that the comparison accepts leaves a mask whole, also as a passage of its own."""
    for n in range(8, 17):
        most = int(0.25 * min(n, 13))
        places = [{m + k for m in mask} for mask in decontaminate.MASKS for k in range(n - mask[-1])]
        for changed in itertools.chain.from_iterable(itertools.combinations(range(n), k) for k in range(most + 1)):
            assert any(not p & set(changed) for p in places), (n, changed)


def test_adjacent_substitutions_are_found(spark, make):
    words = [f"b{i}" for i in range(16)]
    bench = spark.createDataFrame([(1, " ".join(words)), (2, " ".join(f"c{i}" for i in range(8)))], "item_id long, text string")
    middle = ["x" if i in (7, 8) else w for i, w in enumerate(words)]
    three = ["x" if i in (4, 5, 6) else w for i, w in enumerate(words[:13])]
    short = ["x" if i in (3, 4) else f"c{i}" for i in range(8)]
    four = ["x" if i in (2, 5, 8, 11) else w for i, w in enumerate(words[:13])]
    docs = make(rows_of([" ".join(["a"] * 9 + middle), " ".join(three), " ".join(["a"] + short), " ".join(four)]))
    assert {(x.doc_id, x.item_id) for x in decontaminate.hits(docs, bench).collect()} == {(0, 1), (1, 1), (2, 2)}


FIXED = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(d):
    return sum(int(c) if k % 2 == 0 else int(c) * 2 - 9 * (int(c) > 4) for k, c in enumerate(reversed(d))) % 10 == 0


def base(text):
    out = []
    for place, (kind, rx) in enumerate(FIXED.items()):
        for m in re.finditer(rx, text):
            d = re.sub("[^0-9]", "", m[0])
            ok = {"email": True, "ip": kind == "ip" and all(int(x) <= 255 for x in m[0].split(".")), "card": 12 <= len(d) <= 19 and luhn(d), "phone": 9 <= len(d) <= 15}[kind]
            if ok:
                out.append((m.start(), place, m.end(), kind))
    return ",".join(f"{k}:{s}:{e}" for s, _, e, k in sorted(out))


def test_fixed_patterns(make, corpus):
    r = random.Random(4)
    parts = ["a.b@c.de", "x@y", "@", ".", "..", "1", "4111 1111 1111 1111", "4111-1111-1111-1111", "  ", " ", "-", "--", "+1 (713) 555-8702", "+", "10.0.0.1", "256.1.1.1", "001.2.3.004", "1.2.3.4.5.6.7.8", "\n", "é", "😀", "q%", "a@b.cd%e@f.gh", "378282246310005", "12345678901234567890123"]
    texts = ["".join(r.choice(parts) for _ in range(r.randint(1, 12))) for _ in range(400)] + ["9" * 30_000, "a" * 30_000 + "@b.c", "1 " * 9_000, None, ""] + corpus
    got = {x.doc_id: x for x in pii.report(make(rows_of(texts))).collect()}
    for i, t in enumerate(texts):
        assert got[i].base == base(t or ""), t
        assert set(filter(None, got[i].base.split(","))) <= set(got[i].spans.split(","))
        assert [got[i][f"n_{k}"] for k in FIXED] == [len(re.findall(f"(?:^|,){k}:", got[i].base)) for k in FIXED]
    assert pii.report(make([])).count() == 0


def test_contexts_discover_unseen_identifiers(make):
    seeds = [f"please call me +1 555 010 {k:04d} soon" for k in range(5)]
    unseen = ["please call me 555-010-7777 today", "order number 123456789 shipped", "the total 99999 was"]
    got = {x.doc_id: x for x in pii.report(make(rows_of(seeds + unseen))).collect()}
    assert got[5].spans == "phone:15:27" and got[5].base == "" and got[5].n_phone == 0
    assert got[6].spans == "" and got[7].spans == ""


def test_known_identifiers_written_otherwise(make):
    """Also without a context that tells, and an address of digits is not a number of the same digits."""
    texts = ["+1 555 010 0001", "see 1-555-010-0001 there", "host 12.34.56.78 up", "batch 12345678 done"]
    got = {x.doc_id: x.spans for x in pii.report(make(rows_of(texts))).collect()}
    assert (got[1], got[3]) == ("phone:4:18", "")


def test_contexts_reach_over_earlier_matches(spark, make):
    seeds = [f"line 7b call +1 555 010 {k:04d} soon" for k in range(5)]
    got = {x.doc_id: x.spans for x in pii.report(make(rows_of([*seeds, "line 7b call 555-010-7777 today", "at 1 2 3 line 7b call 555-010-8888"]))).collect()}
    assert got[5] == "phone:13:25" and got[6] == "phone:22:34"
    r = random.Random(6)
    texts = ["".join(r.choice(["a1", "22", "x", " ", "\n", ", ", "word ", "b@c.d", "9" * 30, "é", "y" * 90]) for _ in range(r.randint(1, 120))) for _ in range(60)] + ["1 " * 200]
    rows = spark.createDataFrame(list(enumerate(texts)), "row_id long, text string")
    for pattern in (pii.CANDIDATE, pii.PATTERNS["email"], pii.PATTERNS["card"]):
        for x in pii.find(rows, ["row_id"], "text", pattern).collect():
            assert x.left == texts[x.row_id][max(x.start - 80, 0):x.start]


def test_licences(spark):
    rows = [("a/LICENSE", "This work is licensed under the GNU General Public License, version 3"), ("a/x/f.py", "print"), ("a/x/y/g.py", None), ("a/b/h.py", "code\nLicensed under the Apache License, Version 2.0.\n" + "word " * 50),
            ("b/i.py", "nothing of the kind"), ("a/x/COPYING", "Licensed under CC BY-NC 4.0."), ("top.txt", ""), (None, "text"), ("a/x/f.py", "print")]
    files = spark.createDataFrame([(*r, 1, "x") for r in rows], "path string, text string, score int, license string")
    got = sorted(((r.path or "~"), r.license, r.origin, r.inherited_from) for r in licenses.scan(files).collect())
    assert got == sorted([("a/LICENSE", "GPL-3.0", "file", None), ("a/x/f.py", "CC-BY-NC-4.0", "inherited", "a/x"), ("a/x/f.py", "CC-BY-NC-4.0", "inherited", "a/x"), ("a/x/y/g.py", "CC-BY-NC-4.0", "inherited", "a/x"),
                          ("a/b/h.py", "Apache-2.0", "header", None), ("b/i.py", None, None, None), ("a/x/COPYING", "CC-BY-NC-4.0", "file", None), ("top.txt", None, None, None), ("~", None, None, None)], key=lambda x: x)
    assert licenses.scan(files.limit(0)).count() == 0


def test_short_forms_and_full_licence_texts(spark):
    """A short declaration counts as its licence only by name; full texts stand for their directories."""
    full = lambda k: licenses.TEXTS[k].replace("<year> <copyright holders>", "2020 A. Person")
    code = "\n".join(f"value_{i} = {i}" for i in range(60))
    rows = [("s/a.py", "Released under the MIT License.\n" + code), ("s/b.py", "# Copyright 2021 Some Firm Inc. of Town, all rights reserved\n# SPDX-License-Identifier: BSD-3-Clause\n" + code), ("s/c.py", "Released under the Foo License.\n" + code),
            *[(f"{k}/LICENSE", full(k)) for k in licenses.TEXTS], *[(f"{k}/src/x.py", code) for k in licenses.TEXTS], ("s/d.py", full("MIT") + code * 9)]
    got = {r.path: (r.license, r.origin, r.inherited_from) for r in licenses.scan(spark.createDataFrame(rows, "path string, text string")).collect()}
    assert [got[f"s/{x}.py"] for x in "abcd"] == [("MIT", "header", None), ("BSD-3-Clause", "header", None), (None, None, None), ("MIT", "header", None)]
    for k in licenses.TEXTS:
        assert got[f"{k}/LICENSE"] == (k, "file", None) and got[f"{k}/src/x.py"] == (k, "inherited", k)


@functools.cache
def _plain_model(key):
    tok, out = PLAIN[key]
    part = {i: zlib.crc32(str("" if i is None else i).encode()) % 5 for i in tok}

    def model(docs):
        words, both = Counter(), Counter()
        for i in docs:
            words.update(tok[i])
            both.update(zip([None, *tok[i]], tok[i]))
        total = sum(words.values())
        level = lambda c: 0 if c <= 0 else max(1, min(lm.BUCKETS - 1, math.floor(math.log10(c / total)) + lm.BUCKETS))
        parts = lambda a, b: (both[a, b] / words[a] if words[a] else 0.0, words[b] / total, 1 / (len(words) + 1))
        return lambda a: level(words[a]), parts

    level, parts = model([i for i in tok if not out[i] and part[i]])
    weights = {k: [0.0, 0.8, 0.2] if k == 0 else [0.4, 0.4, 0.2] for k in range(lm.BUCKETS)}
    tune = Counter(p for i, ws in tok.items() if part[i] == 0 and not out[i] for p in zip([None, *ws], ws))
    last = None
    while True:
        sums, seen, ll = {}, Counter(), 0.0
        for (a, b), n in tune.items():
            k = level(a)
            each = [w * x for w, x in zip(weights[k], parts(a, b))]
            ll += n * math.log(sum(each))
            seen[k] += n
            sums[k] = [x + n * y / sum(each) for x, y in zip(sums.get(k, [0, 0, 0]), each)]
        for k, s in sums.items():
            w = [max(x / seen[k], y) for x, y in zip(s, (0, 0, 1e-6))]
            weights[k] = [x / sum(w) for x in w]
        gained = ll / max(sum(seen.values()), 1)
        if last is not None and gained - last < 1e-5:
            return *model([i for i in tok if not out[i]]), weights
        last = gained


PLAIN = {}


def plain_score(tok, out, i):
    """log10 of the model, from plain counts."""
    PLAIN.setdefault(id(tok), (tok, out))
    level, parts, weights = _plain_model(id(tok))
    return sum(math.log10(sum(w * x for w, x in zip(weights[level(a)], parts(a, b)))) for a, b in zip([None, *tok[i]], tok[i]))


def test_excluded_documents_change_no_other_score(make, corpus):
    held = F.col("doc_id") % 5 == 1
    one = {r.doc_id: r for r in lm.score(make(rows_of(corpus)), held).collect()}
    other = {r.doc_id: r for r in lm.score(make(rows_of([f"other text {i}" if i % 5 == 1 else t for i, t in enumerate(corpus)])), held).collect()}
    assert all((one[i].score, one[i].base_score) == pytest.approx((other[i].score, other[i].base_score)) for i in one if i % 5 != 1)


def test_batches_of_long_texts_are_bounded(spark, make, corpus):
    """Texts reach Python tasks in batches bounded by bytes, however few rows these are."""
    import pyarrow as pa

    from cohortloom.session import BATCH_BYTES

    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_pydict({"size": [b.nbytes]})

    for operator in (suffix_dedup.deduplicate, ngram_join.classes):
        spark.conf.unset("spark.sql.execution.arrow.maxBytesPerBatch")
        operator(make(rows_of(corpus[:20]))).count()
        long = spark.range(0, 300, 1, 1).selectExpr("repeat('x', 50000) AS text")
        assert 0 < max(r["size"] for r in long.mapInArrow(sizes, "size long").collect()) <= BATCH_BYTES + 60_000


def test_language_model(make, corpus):
    texts = corpus + corpus[:40]
    docs = make(rows_of(texts) + [(None, "the of and", None, None, 0, 0, "", "", 0, 0, 0, "")])
    held = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 5 == 1
    for heavy in (1e-6, 0.01):  # all words at hand, or most of them by the join
        got = {r.doc_id: r for r in lm.score(docs, held, heavy=heavy, pair_share=0.001).collect()}
        tok = {i: (t or "").encode().lower().split() + [None] for i, t in [*enumerate(texts), (None, "the of and")]}
        out = {i: zlib.crc32(str("" if i is None else i).encode()) % 5 == 1 for i in tok}
        c = Counter(w for i, ws in tok.items() if not out[i] for w in ws)
        n, v = sum(c.values()), len(c)
        for i, ws in tok.items():
            g = got[i]
            assert (g.held_out, g.n_tokens, g.n_known, g.train_tokens) == (out[i], len(ws), sum(c[w] > 0 for w in ws), n)
            assert g.base_score == pytest.approx(sum(math.log10((c[w] + 0.5) / (n + 0.5 * (v + 1))) for w in ws))
            assert g.score == pytest.approx(plain_score(tok, out, i), rel=1e-6)
    assert lm.score(make([]), held).count() == 0


def test_held_out_likelihood_on_texts_of_one_kind(make):
    """Words that follow each other by a rule: pairs help on documents that set neither counts nor weights."""
    r = random.Random(6)
    follow = {k: [r.randrange(60) for _ in range(4)] for k in range(60)}

    def text():
        words = [r.randrange(60)]
        while len(words) < 80:
            words.append(r.choice(follow[words[-1]]))
        return " ".join(f"w{k}" for k in words)

    got = lm.score(make(rows_of([text() for _ in range(80)])), F.col("doc_id") % 5 == 1).where("held_out").collect()
    assert len(got) == 16 and all(g.score > g.base_score for g in got)


def test_pairs_are_joined_in_shares(make, corpus, monkeypatch):
    """No pass joins half of the rows, and the passes together hold every open token once."""
    made, resolved = [], lm.resolved

    def counted(*args, rows, **options):
        out = resolved(*args, rows=rows, **options)
        if rows:
            made.append(out.agg(F.count("*"), F.sum("n")).first())
        return out

    monkeypatch.setattr(lm, "resolved", counted)
    got = lm.score(make(rows_of(corpus)), F.col("doc_id") % 5 == 1, pair_share=1.0).collect()
    assert sum(n for _, n in made) == sum(g.n_tokens for g in got)
    assert max(n for n, _ in made) < sum(n for n, _ in made) / 2


def test_counts_reach_the_driver_packed(spark):
    """Some dozens of bytes a word at the driver, also where the session does not turn rows into pandas by Arrow."""
    import tracemalloc

    n, name = 200_000, "spark.sql.execution.arrow.pyspark.enabled"
    counts = spark.range(0, n, 1, 4).selectExpr("id * 7919 - 500000 AS key", "id + 1 AS c")
    before = spark.conf.get(name)
    spark.conf.set(name, "false")
    try:
        lm._collected(counts.limit(10), "key")
        tracemalloc.start()
        found = lm._collected(counts, "key")
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
        spark.conf.set(name, before)
    asked = np.array([-500000, 7919 * 5 - 500000, 3], np.int64).view(np.uint64)
    assert found.find(asked).tolist() == [1, 6, 0] and len(found.keys) == n
    assert peak < 100 * n
    assert len(lm._collected(counts.limit(0), "key").keys) == 0


def test_table_finds_hashed_and_other_keys():
    """Keys spread over all bits are found by their leading bits, crowded ones by halves; both find all listed keys and no others."""
    r = np.random.default_rng(5)
    for listed in (r.integers(0, 1 << 63, 5000).astype(np.uint64) * np.uint64(2), np.arange(0, 10_000, 2, np.uint64), np.array([0, 1 << 63, (1 << 64) - 2], np.uint64), np.array([6], np.uint64), np.zeros(0, np.uint64)):
        listed = r.permutation(np.unique(listed))
        found = lm.Table(listed, np.arange(1, len(listed) + 1))
        assert found.find(listed).tolist() == list(range(1, len(listed) + 1))
        assert not found.find(np.concatenate([listed + np.uint64(1), np.array([(1 << 64) - 1, 3], np.uint64)])).any()
    assert lm.Table(np.arange(10_000, dtype=np.uint64), np.ones(10_000, np.int64)).index()[2] is False


def test_stretches_of_pairs_grow_with_the_tokens(make, corpus, monkeypatch):
    """Scores do not depend on the number of stretches, and twice the tokens make no larger stretches."""
    assert all(lm.BUCKET // 2 <= 10**k // lm.stretches(10**k) <= lm.BUCKET for k in range(7, 13))
    docs, held = make(rows_of(corpus + corpus[:40])), F.col("doc_id") % 5 == 1
    got = []
    for size in (lm.BUCKET, 50):
        monkeypatch.setattr(lm, "BUCKET", size)
        got.append({r.doc_id: r for r in lm.score(docs, held, heavy=0.01, pair_share=0.02).collect()})
    assert all((got[1][i].score, got[1][i].base_score, got[1][i].n_known) == pytest.approx((r.score, r.base_score, r.n_known)) for i, r in got[0].items())


def test_rare_pairs_count_in_the_model(make, corpus):
    """Scores do not depend on which words and pairs are sent whole, and a once-seen pair raises its token's probability."""
    docs = make(rows_of(corpus + corpus[:40]))
    held = F.col("doc_id") % 5 == 1
    got = [{r.doc_id: r for r in lm.score(docs, held, heavy=h, pair_share=p).collect()} for h, p in ((1e-9, 1e-9), (0.01, 0.02))]
    for i, r in got[0].items():
        assert got[1][i].score == pytest.approx(r.score, rel=1e-6) and got[1][i].base_score == pytest.approx(r.base_score) and got[1][i].n_known == r.n_known


def test_quality_counts(make, corpus):
    texts = corpus + ["a b c a b c d", "x\nx\n\n\n x\nx", "# $ %%"]
    got = {r.doc_id: r for r in quality.judge(make(rows_of(texts))).collect()}
    for i, t in enumerate(texts):
        t = t or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        windows = Counter(zip(words, words[1:], words[2:]))
        hit = {p + k for p, w in enumerate(zip(words, words[1:], words[2:])) if windows[w] > 1 for k in range(3)}
        lines, twice, seen = t.split("\n"), 0, set()
        for line in lines:
            twice += line in seen and bool(re.search(r"[^\x20\x09-\x0D]", line))
            seen.add(line)
        g = got[i]
        assert (g.n_words, g.word_chars, g.n_symbols, g.n_dup_lines, g.n_repeat_words) == (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", t)), twice, len(hit))
        assert g.base_failed == (len(words) < 50 or 100 * len(hit) > 50 * len(words))
        assert not (g.kept and g.base_failed)
    assert quality.judge(make([])).count() == 0


def test_quality_outliers(make):
    r = random.Random(8)
    word = lambda: "".join(r.choice("abcdefghij") for _ in range(r.randint(2, 9)))
    good = [" ".join(word() for _ in range(r.randint(60, 400))) + "." for _ in range(260)]
    bad = [" ".join(word().upper() + "!!" for _ in range(120)) for _ in range(40)] + [" | ".join(word() for _ in range(120)) for _ in range(20)]
    docs = make(rows_of(good + bad, "s1") + rows_of(good[:5], None, None, first=900))
    got = {x.doc_id: x.kept for x in quality.judge(docs).collect()}
    assert all(got[i] for i in range(260)) and not any(got[260 + i] for i in range(60)) and all(got[900 + i] for i in range(5))
    kept = quality.accept(docs)
    assert kept.columns == docs.columns and kept.count() == 265


@pytest.mark.parametrize("size", [400, 70, 30])
def test_triggers_of_texts_side_by_side_serve_every_window_once(size):
    """Texts without small hashes (one byte all along) and of one window are among them; each window has the trigger of its least hash."""
    r = random.Random(6)
    some = [bytes(r.choice(b"ab") for _ in range(n)) for n in (size, size + 1, 3000, size, 5000)] + [bytes([c]) * (size + 900) for c in range(97, 127)]
    s = suffix_dedup.sums(np.frombuffer(b"".join(some), np.uint8))
    at = np.cumsum([0, *map(len, some)])
    q, gram, lo, hi, of = suffix_dedup.triggers(s, at, size)
    k, down = size - min(64, size) + 1, suffix_dedup._powers.upto(len(s))[1]
    got = {w: int(p) for p, a, b in zip(q, lo, hi) for w in range(a, b + 1)}
    key = ((s[size - k + 1:] - s[:k - size - 1]) * down[:len(s) - size + k - 1] >> np.uint64(32)).tolist()
    assert got == {w: min(range(w, w + k), key=lambda p: (key[p], p)) for i in range(len(some)) for w in range(at[i], at[i + 1] - size + 1)}
    assert len(got) == (hi - lo + 1).sum() and (np.searchsorted(at, q, side="right") - 1 == of).all() and (gram == suffix_dedup.stretch(s, q, q + min(64, size))).all()


def test_marks_meet_their_texts_as_merged_runs(spark, make):
    """A text with thousands of repeated windows brings one pair of numbers to each of its copies."""
    r = random.Random(7)
    passage = "".join(r.choice("abcdefghij ") for _ in range(3000))
    docs = make(rows_of([passage + f" {i} " + passage for i in range(40)] * 3))
    found = suffix_dedup.merged(suffix_dedup.marks(docs, 30), 30).collect()
    assert len({x.text_key for x in found}) == len(found) == 40 and all(len(x.starts) == len(x.ends) <= 3 for x in found)
    marks = spark.createDataFrame([(1, 0, 5), (1, 3, 4), (1, 35, 35), (1, 100, 100), (2, 0, 0), (2, 29, 30)], "text_key long, lo long, hi long")
    assert sorted((x.text_key, x.starts, x.ends) for x in suffix_dedup.merged(marks, 30).collect()) == [(1, [0, 100], [65, 130]), (2, [0], [60])]
