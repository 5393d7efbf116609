"""Cheapest repair of conversations: cost DP over role patterns, the least cheapest edit list by prefix-doubling ranks.

A sound conversation is empty, or an optional system row and then user and assistant rows in turn. Every row is kept (free), re-roled (3) or
deleted (4); empty user or assistant rows may be inserted anywhere (3 each); a row that is not deleted though its text breaks off costs 3 more.
Blank rows and repeated ones must go. The initials of the edits (D, I, K, R) are the audit.

Rows are range partitioned by conversation and turn and numbered in that order, equal rows as one line with a count. Lines are cut into pieces
of at most 2^`bits`, so that no task holds more of a conversation than that. A node is a place between lines with what the pattern may go on with
(nothing yet, after system, after user, after assistant). In each piece

1. costs to go are worked out from the end: per node the cheapest way to a sound end;
2. arcs that keep to those costs are the optimal ones. They are ranked by the first letter of the audit that starts with them, then by the
   first 2, 4, 8, ... letters: the rank over twice the length is that of the pair (rank here, rank where the pointer leads), and pointers double;
3. the least rank picks each node's arc, and the pointers, from the longest down, lead to all arcs of the least path.

Letters on the arcs of one node differ, so pointers are unique from the first round on. Conversations of several pieces pass 4 x 4 tables of costs,
then of ways through, from piece to piece: one small row per piece, folded per conversation. Repaired texts are then hashed as a sorted stream, so that
texts of a conversation are never held together; its digest and its audit are one value each, which is what bounds a conversation.

Defined cases: null roles and texts count as one space; null turns come first; rows of one turn stand in order of role, then text; a null conversation is
one of its own; an empty role, as any that does not start with s, u or a, fits nowhere; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from ..session import cut, uncut

#: ASCII white space, marks that end a text, costs of the edits.
WHITE = " \t\n\x0b\x0c\r"
MARKS = ".!?"
REROLE, DELETE, INSERT, BROKEN = 3, 4, 3, 3

LETTERS = b"DIKR"
ROLES = ("user", "assistant")
FAR = 1 << 40
#: What the pattern may go on with: nothing yet, after system, after user, after assistant. Where a new user or assistant leads from there.
NEXT = np.array([2, 2, 3, 2])
#: Where keeping a role with initial s, u, a or another one leads; -1: nowhere.
KEEP = np.array([[1, 2, -1, -1], [-1, 2, -1, -1], [-1, -1, 3, -1], [-1, 2, -1, -1]])
#: Cost of a sound end by inserts alone.
END = np.array([0, 2 * INSERT, INSERT, 0])
SOUND, SHORT, GO = 0, 1, 2  # a line's state: fine, breaks off, must be deleted
LINES = 1 << 17  # lines that a task works on at a time


def _steps() -> np.ndarray:
    """By code of a line (initial + 4 x state): cost from each node before it, through inserts, to each node after it."""
    insert = np.full((4, 4), FAR)
    for q in range(4):
        at, cost = q, 0
        while cost < insert[q, at]:
            insert[q, at] = cost
            at, cost = NEXT[at], cost + INSERT
    out = np.full((12, 4, 4), FAR)
    for code in range(12):
        initial, state = code % 4, code // 4
        for q in range(4):
            out[code, q, q] = DELETE
            if state != GO:
                more = BROKEN if state == SHORT else 0
                out[code, q, NEXT[q]] = min(out[code, q, NEXT[q]], REROLE + more)
                if KEEP[q, initial] >= 0:
                    out[code, q, KEEP[q, initial]] = min(out[code, q, KEEP[q, initial]], more)
    return (insert[None, :, :, None] + out[:, None, :, :]).min(axis=2)


STEPS = _steps()


def to_go(codes: np.ndarray, at: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Costs to go at every place of all pieces. at: where each piece's lines begin, and the end. right: per piece, node and wanted end.

    Piece j has a place before each line and one after the last: place of line i is i + j.
    """
    n = np.diff(at)
    costs = np.empty((len(codes) + len(n), *right.shape[1:]), np.int64)
    longest = np.argsort(-n, kind="stable")
    end, sizes = at[1:] + np.arange(len(n)), n[longest]
    costs[end] = right
    for back in range(1, int(n.max(initial=0)) + 1):
        live = longest[: np.searchsorted(-sizes, -back, side="right")]
        place = end[live] - back
        costs[place] = np.minimum((STEPS[codes[at[live + 1] - back]][:, :, :, None] + costs[place + 1][:, None]).min(axis=2), FAR)
    return costs


class Arcs:
    """The optimal arcs of some pieces, in order of node and letter."""

    def __init__(self, codes: np.ndarray, at: np.ndarray, costs: np.ndarray, last: np.ndarray):
        n = np.diff(at)
        place = np.arange(len(codes)) + np.repeat(np.arange(len(n)), n)
        flat = costs.reshape(-1)
        q = np.tile(np.arange(4), len(codes))
        node, code = np.repeat(place, 4) * 4 + q, np.repeat(codes, 4)
        more = np.where(code // 4 == SHORT, BROKEN, 0)
        may, keep = code // 4 != GO, KEEP[q, code % 4]
        end = (at[1:] + np.arange(len(n)))[last]
        end_node = (end[:, None] * 4 + np.arange(4)).reshape(-1)
        kinds = [
            (0, node, node + 4, np.full(len(node), DELETE), np.ones(len(node), bool)),
            (1, node, node - q + NEXT[q], np.full(len(node), INSERT), np.ones(len(node), bool)),
            (1, end_node, end_node - end_node % 4 + NEXT[end_node % 4], np.full(len(end_node), INSERT), np.ones(len(end_node), bool)),
            (2, node, node - q + 4 + keep, more, may & (keep >= 0)),
            (3, node, node - q + 4 + NEXT[q], REROLE + more, may),
        ]
        tails, heads, letters = [], [], []
        for letter, tail, head, cost, allowed in kinds:
            tight = np.flatnonzero(allowed)
            tight = tight[(flat[tail[tight]] == cost[tight] + flat[head[tight]]) & (flat[tail[tight]] < FAR)]
            tails.append(tail[tight])
            heads.append(head[tight])
            letters.append(np.full(len(tight), letter))
        tail, head, letter = (np.concatenate(x) for x in (tails, heads, letters))
        order = np.lexsort((letter, tail))
        self.tail, self.head, self.letter = tail[order], head[order], letter[order]
        self.nodes = len(flat)

    def _first(self, order: np.ndarray) -> np.ndarray:
        """The first arc of each node in the given order, or the number of arcs where there is none."""
        out = np.full(self.nodes, len(self.tail))
        out[self.tail[order][::-1]] = order[::-1]
        return out

    def rank(self) -> tuple[np.ndarray, list[np.ndarray]]:
        """The arc with the least audit of each node, and pointers over 1, 2, 4, ... letters; the number of arcs stands for the end."""
        m = len(self.tail)
        pointer = np.append(self._first(np.arange(m))[self.head], m)
        rank = np.append(self.letter + 1, 0)
        doubled = []
        while (pointer < m).any():
            doubled.append(pointer)
            pair = rank * (rank.max() + 1) + rank[pointer]
            rank = np.unique(pair, return_inverse=True)[1].reshape(-1)
            pointer = pointer[pointer]
        return self._first(np.lexsort((rank[:m], self.tail))), doubled

    def ends(self, start: np.ndarray) -> np.ndarray:
        """The node where the least path from each given node ends."""
        best, doubled = self.rank()
        arc = best[start]
        for pointer in doubled[::-1]:
            arc = np.where(pointer[arc] < len(self.tail), pointer[arc], arc)
        return np.append(self.head, -1)[arc]

    def paths(self, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Arcs of the least paths from the given nodes in order, and the path each belongs to."""
        best, doubled = self.rank()
        arc, path, step = best[start], np.arange(len(start)), np.zeros(len(start), np.int64)
        for k in range(len(doubled) - 1, -1, -1):
            ahead = doubled[k][arc]
            on = ahead < len(self.tail)
            arc, path, step = np.append(arc, ahead[on]), np.append(path, path[on]), np.append(step, step[on] + (1 << k))
        order = np.lexsort((step, path))
        return arc[order], path[order]


#: Roles of the inserts before a line by the number that `edits` makes of them.
BEFORE = np.array(["", "u", "a", "", "uu", "au", "", "ua", "aa"])


def edits(codes: np.ndarray, copies: np.ndarray, at: np.ndarray, right: np.ndarray, last: np.ndarray, entry: np.ndarray) -> tuple:
    """Per piece: audit and cost to go at its entry; per line: letter, new role (0: its own) and inserts before it; per piece: inserts after its last line."""
    costs = to_go(codes, at, right[:, :, None])[:, :, 0]
    arcs = Arcs(codes, at, costs, last)
    starts = (at[:-1] + np.arange(len(entry))) * 4 + entry
    arc, path = arcs.paths(starts)
    letter, place, q = arcs.letter[arc], arcs.tail[arc] // 4, arcs.tail[arc] % 4
    line = place - path
    insert = letter == 1
    again = np.zeros(len(arc), bool)
    again[1:] = insert[:-1] & insert[1:] & (place[:-1] == place[1:])
    before = np.zeros(len(codes) + len(entry), np.int64)
    np.add.at(before, place[insert], (NEXT[q[insert]] - 1) * np.where(again[insert], 3, 1))
    edit = ~insert
    letters, roles = np.zeros(len(codes), np.int8), np.zeros(len(codes), np.int8)
    letters[line[edit]] = letter[edit]
    roles[line[edit]] = np.where(letter[edit] == 3, NEXT[q[edit]] - 1, 0)
    width = np.ones(len(arc), np.int64)
    width[edit] = copies[line[edit]]
    text = np.full(int(width.sum()), LETTERS[0], np.uint8)
    text[np.cumsum(width) - width] = np.frombuffer(LETTERS, np.uint8)[letter]
    edge = np.concatenate([[0], np.cumsum(width)])[np.searchsorted(path, np.arange(len(entry) + 1))]
    audit = [text[a:b].tobytes().decode() for a, b in zip(edge[:-1], edge[1:])]
    own = np.arange(len(codes)) + np.repeat(np.arange(len(entry)), np.diff(at))
    return audit, costs.reshape(-1)[starts], letters, roles, BEFORE[before[own]], BEFORE[before[at[1:] + np.arange(len(entry))]]


LEGAL = np.zeros((4, 4), bool)
LEGAL[[0, 1, 2], [1, 2, 1]] = True  # su, ua, au


def _pieces(it: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Some pieces at a time: their rows, codes of all their lines, and where each piece's lines begin."""
    for batch in it:
        if not batch.num_rows:
            continue
        size = np.diff(batch.column("code").offsets.to_numpy())
        first = 0
        while first < batch.num_rows:
            n = max(1, int(np.searchsorted(np.cumsum(size[first:]), LINES, side="right")))
            part = batch.slice(first, n)
            yield part, part.column("code").flatten().to_numpy().astype(np.int64), np.concatenate([[0], np.cumsum(size[first:first + n])])
            first += n


def _lists(column: pa.Array) -> np.ndarray:
    return np.array(column.to_pylist(), dtype=np.int64).reshape(len(column), 4)


def _tables(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The cost of each way through a piece, and its outer lines."""
    for part, codes, at in _pieces(it):
        unit = np.where(np.eye(4, dtype=bool), 0, FAR)
        costs = to_go(codes, at, np.repeat(unit[None], part.num_rows, axis=0))[at[:-1] + np.arange(part.num_rows)]
        yield pa.record_batch([part.column("conv_id"), part.column("piece"), pa.array(costs.reshape(-1, 16).tolist(), pa.list_(pa.int64())), pa.array(codes[at[:-1]] % 4), pa.array(codes[at[1:] - 1] % 4)], ["conv_id", "piece", "costs", "head", "foot"])


def _fold_costs(g: pd.DataFrame) -> pd.DataFrame:
    g = g.sort_values("piece", ignore_index=True)
    right, out = END, []
    for c in g.costs[::-1]:
        out.append(right.tolist())
        right = np.minimum((np.asarray(c).reshape(4, 4) + right[None]).min(axis=1), FAR)
    seam = [False, *(not LEGAL[a, b] for a, b in zip(g.foot[:-1], g["head"][1:]))]
    return pd.DataFrame({"conv_id": g.conv_id, "piece": g.piece, "right": out[::-1], "seam": np.array(seam, np.int64), "last": g.index == len(g) - 1, "start": g.index == 0})


def _ways(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The node where the least path through a piece ends, for each node it may start from."""
    for part, codes, at in _pieces(it):
        last = part.column("last").to_numpy(zero_copy_only=False)
        costs = to_go(codes, at, _lists(part.column("right"))[:, :, None])
        starts = ((at[:-1] + np.arange(part.num_rows))[:, None] * 4 + np.arange(4)).reshape(-1)
        ends = Arcs(codes, at, costs, last).ends(starts).reshape(-1, 4) % 4
        yield pa.record_batch([part.column("conv_id"), part.column("piece"), pa.array(ends.tolist(), pa.list_(pa.int64()))], ["conv_id", "piece", "ends"])


def _fold_ways(g: pd.DataFrame) -> pd.DataFrame:
    g = g.sort_values("piece", ignore_index=True)
    entry, out = 0, []
    for ends in g.ends:
        out.append(entry)
        entry = int(ends[entry])
    return pd.DataFrame({"conv_id": g.conv_id, "piece": g.piece, "entry": out})


def _solve(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part, codes, at in _pieces(it):
        copies = part.column("copies").flatten().to_numpy()
        column = lambda name: part.column(name).to_numpy(zero_copy_only=False)
        audit, cost, letters, roles, before, after = edits(codes, copies, at, _lists(part.column("right")), column("last"), column("entry"))
        wrong = copies - 1
        extra = np.add.reduceat(wrong, at[:-1])
        wrong[1:] += ~LEGAL[codes[:-1] % 4, codes[1:] % 4]
        wrong[at[:-1]] = copies[at[:-1]] - 1
        illegal = np.add.reduceat(wrong, at[:-1]) + column("seam")
        total = np.where(column("start"), cost, 0) + DELETE * extra
        lines = [pa.array(letters), pa.array(roles), pa.array(before, pa.string())]
        offsets = pa.array(at, pa.int32())
        yield pa.record_batch(
            [part.column("conv_id"), part.column("piece"), part.column("pos"), *(pa.ListArray.from_arrays(offsets, x) for x in lines), pa.array(after, pa.string()), pa.array(audit), pa.array(total, pa.int64()), pa.array(illegal, pa.int64())],
            ["conv_id", "piece", "pos", "letter", "new_role", "before", "after", "audit", "cost", "illegal"])


def damage(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, text of the rows with seeded faults: a row of 20 each dropped, emptied, without end marks, repeated, made a user's."""
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat_ws(":", blank("conv_id"), blank("turn")).cast("binary")) % 20
    text = F.when(kind == 1, "").when(kind == 2, F.regexp_replace(blank("text"), f"[{MARKS}]", "")).otherwise(blank("text"))
    hurt = rows.where(kind != 0).select("conv_id", "turn", F.when(kind == 4, "user").otherwise(blank("role")).alias("role"), text.alias("text"), F.when(kind == 3, 2).otherwise(1).alias("times"))
    return hurt.select("conv_id", "turn", "role", "text", F.explode(F.array_repeat(F.lit(0), F.col("times")))).drop("col")


def _is_blank(text: Column) -> Column:
    return F.length(F.trim(text, F.lit(WHITE))) == 0


def ordered(rows: DataFrame) -> DataFrame:
    """Lines of equal rows with their number in the order of conversation, turn, role and text, written."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(" ")).alias("text")
    lines = rows.select("conv_id", F.col("turn").cast("long").alias("turn"), F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"), text)
    lines = lines.groupBy("conv_id", "turn", "role", "text").agg(F.count(F.lit(1)).alias("copies"))
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    by = [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), F.col("role")]
    return cut(lines.repartitionByRange(parts, *by, F.left("text", F.lit(64))).sortWithinPartitions(*by, "text").withColumn("pos", F.monotonically_increasing_id()))


def faults(lines: DataFrame) -> DataFrame:
    """Each line without its text: conv_id, turn, pos, copies, blank, duplicate and truncated rows, and its code."""
    same = F.md5(F.to_json(F.struct("conv_id", "role", "text")).cast("binary"))
    ending = F.right(F.rtrim("text", F.lit(WHITE)), F.lit(1))
    d = lines.select("conv_id", "turn", "pos", "copies", same.alias("same"), F.left("role", F.lit(1)).alias("initial"), _is_blank(F.col("text")).alias("blank"), (~ending.isin(*MARKS)).alias("short"))
    seen = d.groupBy("same").agg(F.min("pos").alias("first"), F.count(F.lit(1)).alias("k")).where("k > 1").drop("k")
    d = d.join(seen, "same", "left").withColumn("again", F.coalesce(F.col("pos") > F.col("first"), F.lit(False)))
    go = F.col("blank") | F.col("again")
    state = F.when(go, GO).when(F.col("short"), SHORT).otherwise(SOUND)
    initial = F.when(F.col("initial") == "s", 0).when(F.col("initial") == "u", 1).when(F.col("initial") == "a", 2).otherwise(3)
    count = lambda c: F.when(c, F.col("copies")).otherwise(0).cast("long")
    return d.select(
        "conv_id", "turn", "pos", "copies", (initial + 4 * state).cast("int").alias("code"), count(F.col("blank")).alias("blank"),
        F.when(F.col("blank"), 0).when(F.col("again"), F.col("copies")).otherwise(F.col("copies") - 1).cast("long").alias("duplicate"),
        F.when(~go & F.col("short"), 1).otherwise(0).cast("long").alias("truncated"))


def solve(marks: DataFrame, bits: int = 12) -> DataFrame:
    """Each piece's edits: conv_id, piece, per line pos, letter, new_role and before, and after, audit, cost, illegal."""
    kind = dict(marks.dtypes)["conv_id"]
    key = f"conv_id {kind}, piece long"
    piece = F.shiftright("pos", bits).alias("piece")
    lists = F.array_sort(F.collect_list(F.struct("pos", "code", "copies")))
    pieces = marks.groupBy("conv_id", piece).agg(lists.alias("l")).select("conv_id", "piece", F.col("l.pos").alias("pos"), F.col("l.code").alias("code"), F.col("l.copies").alias("copies"))
    pieces = cut(pieces)
    short = {"right": F.array(*(F.lit(int(v)).cast("long") for v in END)), "seam": F.lit(0).cast("long"), "last": F.lit(True), "start": F.lit(True), "entry": F.lit(0).cast("long")}
    several = cut(pieces.groupBy("conv_id").agg(F.count(F.lit(1)).alias("k")).where("k > 1").select("conv_id"))
    if several.isEmpty():
        whole = pieces.withColumns(short)
    else:
        alike = lambda a, b, *names: [a[n].eqNullSafe(b[n]) for n in names]
        long = pieces.join(several, alike(pieces, several, "conv_id"), "left_semi")
        tables = long.select("conv_id", "piece", "code").mapInArrow(_tables, f"{key}, costs array<long>, head long, foot long")
        rights = cut(tables.groupBy("conv_id").applyInPandas(_fold_costs, f"{key}, right array<long>, seam long, last boolean, start boolean"))
        long = long.join(rights.withColumnRenamed("conv_id", "c"), "piece").where("conv_id <=> c").drop("c")
        ways = long.select("conv_id", "piece", "code", "right", "last").mapInArrow(_ways, f"{key}, ends array<long>")
        entries = ways.groupBy("conv_id").applyInPandas(_fold_ways, f"{key}, entry long")
        long = long.join(entries.withColumnRenamed("conv_id", "c"), "piece").where("conv_id <=> c").drop("c")
        whole = pieces.join(several, alike(pieces, several, "conv_id"), "left_anti").withColumns(short).unionByName(long)
    columns = ["conv_id", "piece", "pos", "code", "copies", "right", "seam", "last", "start", "entry"]
    return cut(whole.select(*columns).mapInArrow(_solve, f"{key}, pos array<long>, letter array<tinyint>, new_role array<tinyint>, before array<string>, after string, audit string, cost long, illegal long"))


def _stream(lines: DataFrame, solved: DataFrame) -> DataFrame:
    """Edits, each followed by the text it is for, in the order of their conversation, which is in one partition.

    Texts and edits are told apart by `text` and meet by sorting, so texts cross the network once.
    """
    zipped = F.posexplode(F.arrays_zip("pos", "letter", "new_role", "before")).alias("i", "l")
    at = solved.select("conv_id", "piece", F.size("pos").alias("k"), "after", zipped)
    acts = at.select("conv_id", F.col("l.pos").alias("pos"), F.col("l.letter").alias("letter"), F.col("l.new_role").alias("new_role"), F.col("l.before").alias("before"), F.when(F.col("i") == F.col("k") - 1, F.col("after")).otherwise("").alias("after"))
    none = lambda t: F.lit(None).cast(t)
    both = acts.select("*", none("string").alias("role"), none("string").alias("text")).unionByName(lines.select("conv_id", "pos", "role", "text"), allowMissingColumns=True)
    return both.repartition("conv_id").sortWithinPartitions("conv_id", "pos", F.col("text").isNotNull())


SHA_EMPTY = hashlib.sha256(b"").hexdigest()
FULL = {"u": ROLES[0], "a": ROLES[1]}


def _read(it: Iterator[pa.RecordBatch]) -> Iterator[tuple[object, str, str]]:
    """(conversation, role, text) of repaired rows from the sorted stream of edits and texts; each conversation also once with no role."""
    act = None
    for batch in it:
        rows = zip(*(batch.column(c).to_pylist() for c in ("conv_id", "letter", "new_role", "before", "after", "role", "text")))
        for conv, letter, new_role, before, after, role, text in rows:
            if text is None:
                act = (letter, new_role, before, after)
                continue
            letter, new_role, before, after = act
            yield conv, None, ""
            for x in before:
                yield conv, FULL[x], ""
            if letter:
                yield conv, ROLES[new_role - 1] if new_role else role, text
            for x in after:
                yield conv, FULL[x], ""


def _rows(kind: pa.DataType):
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, of, nth, out = ["conv_id", "nth", "role", "text"], object(), 0, []
        table = lambda: pa.record_batch([pa.array(list(c), t) for c, t in zip(zip(*out), (kind, pa.int64(), pa.string(), pa.string()))], names)
        for conv, role, text in _read(it):
            nth = nth if conv == of else 0
            of = conv
            if role is not None:
                out.append((conv, nth, role, text))
                nth += 1
            if len(out) >= 1_000:
                yield table()
                out = []
        if out:
            yield table()

    return run


def repaired(rows: DataFrame, bits: int = 12) -> DataFrame:
    """The mended conversations: conv_id, nth (from 0), role, text."""
    lines = ordered(rows)
    kind = rows.schema["conv_id"].dataType
    return _stream(lines, solve(cut(faults(lines)), bits)).mapInArrow(_rows(to_arrow_type(kind)), f"conv_id {kind.simpleString()}, nth long, role string, text string")


def _digest(kind: pa.DataType):
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, digests, sums = [], [], None

        def flush():
            out = pa.record_batch([pa.array(ids, kind), pa.array(digests, pa.string())], ["conv_id", "repaired_sha256"])
            ids.clear(), digests.clear()
            return out

        for conv, role, text in _read(it):
            if sums is None or conv != ids[-1]:
                if sums is not None:
                    digests.append(sums.hexdigest())
                    if len(ids) >= 10_000:
                        yield flush()
                ids.append(conv)
                sums, lines = hashlib.sha256(), 0
            if role is not None:
                sums.update(f"{chr(10) if lines else ''}{role}:{text}".encode())
                lines += 1
        if sums is not None:
            digests.append(sums.hexdigest())
            yield flush()

    return run


def report(rows: DataFrame, bits: int = 12) -> DataFrame:
    """One row per conversation of `rows`: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256."""
    lines = ordered(rows)
    marks = cut(faults(lines))
    solved = solve(marks, bits)
    wide = lambda c: c.cast("decimal(38,0)")
    gaps = F.coalesce((wide(F.max("turn")) - wide(F.min("turn")) + 1 - F.count_distinct("turn")).cast("long"), F.lit(0).cast("long"))
    facts = marks.groupBy("conv_id").agg(gaps.alias("gaps"), *(F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated")))
    audit = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("piece", "audit"))), lambda p: p.audit), "")
    ways = solved.groupBy("conv_id").agg(F.sum("illegal").alias("illegal"), F.sum("cost").alias("cost"), audit.alias("audit"))
    kind = rows.schema["conv_id"].dataType
    hashed = _stream(lines, solved).mapInArrow(_digest(to_arrow_type(kind)), f"conv_id {kind.simpleString()}, repaired_sha256 string")
    out = facts
    for side in (ways, hashed):
        side = side.withColumnRenamed("conv_id", "c")
        out = out.join(side, out.conv_id.eqNullSafe(side.c)).drop("c")
    done = cut(out)
    for spent in (lines, marks, solved):
        uncut(spent)
    return done
