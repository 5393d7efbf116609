"""Conversation repair against a plain search over all edit lists."""

import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from cohortloom.llm import repair

SF = "/root/testdata/sf0.001"
SCHEMA = "conv_id long, turn long, role string, text string, pos long, letter string, piece int, copies int, same string"


def plain_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        role = "user" if kind == 4 else role
        out += [(conv, turn, role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    return out


def plain(rows):
    """The report of one conversation: (gaps, blank, duplicate, truncated, illegal, cost, audit, sha)."""
    rows = sorted(((t, r, x) for _, t, r, x in rows), key=lambda t: (t[0] is not None, t[0] or 0, t[1], t[2]))
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    seen, state = set(), []
    for _, role, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]", text)
        state.append("blank" if not words else "duplicate" if (role, text) in seen else "truncated" if words[-1] not in ".!?" else "")
        seen.add((role, text))
    initials = [r[:1] for _, r, _ in rows]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))

    full, follow = {"u": "user", "a": "assistant"}, {"": "u", "s": "u", "u": "a", "a": "u"}

    def step(cost, letters, added, rest):
        return [(cost + c, letters + a, [*added, *t]) for c, a, t in rest]

    def least(found):
        return [min(found, key=lambda x: (x[0], x[1]))] if found else []

    # per row from the last one on: for what was last put out, the least (cost, audit, repaired rows) of the rest
    after = {}
    for i in range(len(rows), -1, -1):
        now = {}
        for at in follow:
            now[at] = [(0, "", [])] if i == len(rows) and at in ("", "a") else []
            if i < len(rows):
                (_, role, text), nxt, more = rows[i], follow[at], 3 * (state[i] == "truncated")
                now[at] += step(4, "D", [], after[at])
                if state[i] not in ("blank", "duplicate"):
                    now[at] += step(3 + more, "R", [(full[nxt], text)], after[nxt])
                    if role[:1] == nxt or (at == "" and role[:1] == "s"):
                        now[at] += step(more, "K", [(role, text)], after[role[:1]])
        after = {}
        for at, nxt in follow.items():
            one = step(3, "I", [(full[nxt], "")], now[nxt])
            two = step(6, "II", [(full[nxt], ""), (full[follow[nxt]], "")], now[follow[nxt]])
            after[at] = least(now[at] + one + two)
    cost, audit, text = after[""][0]
    body = "\n".join(f"{r}:{t}" for r, t in text)
    return gaps, state.count("blank"), state.count("duplicate"), state.count("truncated"), illegal, cost, audit, hashlib.sha256(body.encode()).hexdigest()


def expected(rows):
    by = {}
    for r in rows:
        by.setdefault(r[0], [])
    for r in plain_damage(rows):
        by[r[0]].append(r)
    return {k: plain(v) for k, v in by.items()}


NAMES = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def as_dict(df):
    rows = df.collect()
    out = {r.conv_id: tuple(r[n] for n in NAMES) for r in rows}
    assert len(out) == len(rows)
    return out


def random_rows(seed=7, conversations=60):
    r = random.Random(seed)
    rows = []
    for conv in [None, *range(conversations)]:
        n = r.choice([1, 2, 3, 5, 9, 14])
        for k in range(n):
            role = r.choice(["system", "user", "user", "assistant", "assistant", "tool", "", None])
            text = r.choice(["Yes.", "No!", "Why", "Wait ", "", " \n", None, "Well?\t", f"Part {r.randrange(9)}."])
            rows.append((conv, r.choice([k, k, k, k + 3, None]), role, text))
    rows += rows[:25]
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "x", 2, 3, "y") for r in rows], SCHEMA)


@pytest.mark.parametrize("bits", [12, 1])
def test_reports_equal_a_plain_search(spark, bits):
    rows = random_rows()
    hurt = repair.damage(frame(spark, rows))
    assert sorted(map(str, hurt.collect())) == sorted(map(str, spark.createDataFrame(plain_damage(rows), "conv_id long, turn long, role string, text string").collect()))
    want = {k: v for k, v in expected(rows).items() if any(r[0] == k for r in plain_damage(rows))}
    assert as_dict(repair.report(hurt, bits=bits)) == want


def test_one_long_conversation_spans_many_pieces(spark):
    r = random.Random(3)
    rows = [(1, k, r.choice(["user", "assistant", "system"]), r.choice(["A.", "b", f"Text {k}.", f"Text {k}"])) for k in range(700)]
    rows += [(2, 0, "user", "Same.")] * 300 + [(2, 1, "assistant", "Good.")]
    got = as_dict(repair.report(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"), bits=3))
    assert got == {1: plain([x for x in rows if x[0] == 1]), 2: plain([x for x in rows if x[0] == 2])}


def test_least_audit_by_hand(spark):
    rows = [(1, 0, "user", "Hi."), (1, 1, "user", "Hi there."), (2, 0, "assistant", "Done."), (3, 0, "system", "Rules."), (4, 0, "user", "")]
    got = as_dict(repair.report(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")))
    assert [got[k][5:7] for k in (1, 2, 3, 4)] == [(3, "KR"), (3, "IK"), (4, "D"), (4, "D")]


def test_repaired_rows_are_what_the_digest_is_of(spark):
    hurt = repair.damage(frame(spark, random_rows(9, 20)))
    by = {k: [] for k in as_dict(repair.report(hurt))}
    for r in sorted(repair.repaired(hurt).collect(), key=lambda r: r.nth):
        by[r.conv_id].append(f"{r.role}:{r.text}")
    assert {k: hashlib.sha256("\n".join(v).encode()).hexdigest() for k, v in by.items()} == {k: v[-1] for k, v in as_dict(repair.report(hurt)).items()}
    assert all(re.fullmatch("(s?(ua)+)?", "".join(x[0] for x in v)) for v in by.values())


def test_the_query_returns_every_conversation(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert as_dict(E.queries()["op13_conversation_repair"](spark, SF)) == expected(rows)


def test_dropped_and_empty(spark, tmp_path):
    gone = next(k for k in range(1000) if zlib.crc32(f"{k}:0".encode()) % 20 == 0)
    rows = frame(spark, [(gone, 0, "user", "Hello."), (gone + 1, None, None, None)])
    rows.write.parquet(f"{tmp_path}/conversations.parquet")
    got = as_dict(E.queries()["op13_conversation_repair"](spark, str(tmp_path)))
    assert got[gone] == (0, 0, 0, 0, 0, 0, "", repair.SHA_EMPTY)
    assert set(got) == {gone, gone + 1}
    none = repair.report(rows.where(F.lit(False)))
    assert none.count() == 0
