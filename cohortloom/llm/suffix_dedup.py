"""Removal of long strings that occur more than once, by prefix-free parsing.

A rolling hash of 64 bytes runs over every text; within each 400-byte window the position of the least hash (the leftmost of equal ones)
is its trigger. Triggers cut the texts into phrases, some 170 bytes apart and never more than a window, and equal windows have their triggers
at the same place, so that repeated strings are parsed alike wherever they stand. The dictionary is the set of distinct phrase
contexts: a trigger's bytes from the first to the last window that it serves. Ranks are names: a context's place in the suffix order of the
dictionary is only ever compared for equality of 400 leading bytes, so hashes of the same bytes take the place of sorted ranks, and
no suffix of the corpus is shuffled.

* A context that occurs twice repeats all windows of its trigger: one row per trigger decides long repeats.
* Triggers whose 64 bytes recur in unlike contexts (the ends of a repeated passage) name their windows in blocks of 16: the whole block, and the core
  that all of its windows share. A whole met in two contexts repeats the block. Only blocks whose core recurs in unlike wholes name each
  window, and a window named in two of them is repeated.
* Which triggers and cores these are goes to the tasks as bitmaps of fixed size; a shared bit only names more than need be.

Defined cases: a null text is empty; texts under 400 bytes keep everything; copies of a text share their marks, which are kept by a 64-bit hash
of the text, merged to runs before they meet the texts; a hot text is counted within each batch first; overlapping repeats within one text count; an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import bounded_batches, cut, uncut
from .arrays import _powers, mixed, stretch, sums, texts
from .common import text_key
from .ngram_join import _set_bits, bitmap

GRAM = 64
PIECE = 1 << 18  # bytes of texts that are parsed at once, a longer text by itself


def _candidates(key: np.ndarray, at: np.ndarray, last: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Places that the least hash of any k places of a text may have, and the text of each: small hashes, and all places of stretches without any."""
    share = 24 / k
    cand = np.flatnonzero(key < np.uint64(share * 2.0**64)) if share < 1 else np.arange(len(key))
    of = np.searchsorted(at, cand, side="right") - 1
    inside = cand <= last[of]
    cand, of = cand[inside], of[inside]
    head = np.searchsorted(of, np.arange(len(last))) + np.arange(len(last))
    before = np.insert(cand, head - np.arange(len(last)), at[:-1] - 1)
    after = np.append(before[1:], 0)
    after[np.append(head[1:], len(before)) - 1] = last + 1
    wide = np.flatnonzero(after - before > k)
    if len(wide):
        many = after[wide] - before[wide] - 1
        more = np.repeat(before[wide] + 1, many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
        cand = np.sort(np.concatenate([cand, more]))
        of = np.searchsorted(at, cand, side="right") - 1
    return cand, of


def _next_less(place: np.ndarray, value: np.ndarray, reach: np.ndarray) -> np.ndarray:
    """The first place after each one that has a smaller value, or its reach if there is none before that."""
    place, n = np.append(place, np.iinfo(np.int64).max), len(place)
    value, to = np.append(value, np.uint64(0)), np.arange(1, n + 1)
    at = np.arange(n)
    while len(at):
        j = to[at]
        at = at[(place[j] < reach[at]) & (value[j] > value[at])]
        to[at] = to[to[at]]
    return np.minimum(place[to], reach)


def triggers(s: np.ndarray, at: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of texts that lie side by side from at[i] to at[i + 1], none shorter than a window: position, hash of its 64 bytes, first and last window served, and
    text, of every trigger. Positions count from the first text's first byte."""
    gram = min(GRAM, size)
    k = size - gram + 1  # places of a window at which a trigger may stand
    _, down = _powers.upto(len(s))
    key = (s[gram:] - s[:-gram]) * down[: len(s) - gram]
    last = at[1:] - gram
    place, of = _candidates(key, at, last, k)
    h = key[place]
    value = (h & np.uint64(0xFFFFFFFF00000000)) | place.astype(np.uint64)
    right = _next_less(place, value, np.minimum(place + k, last[of] + 1))
    left = -_next_less(-place[::-1], value[::-1], np.minimum(k - place, 1 - at[of])[::-1])[::-1]
    lo, hi = left + 1, right - k
    some = lo <= hi
    return place[some], mixed(h[some]), lo[some], hi[some], of[some]


def contexts(s: np.ndarray, q: np.ndarray, lo: np.ndarray, hi: np.ndarray, size: int) -> np.ndarray:
    """Names of the contexts: their bytes, their length and where the trigger stands in them."""
    shape = ((hi - lo).astype(np.uint64) << np.uint64(32)) | (q - lo).astype(np.uint64)
    return mixed(stretch(s, lo, hi + size) + mixed(shape))


def _texts(b: pa.RecordBatch, size: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Distinct texts of a batch that have windows, some at a time: keys, copies, prefix sums of their bytes side by side, and where each text begins and the last one ends."""
    keys, first, copies = np.unique(b.column("text_key").to_numpy(), return_index=True, return_counts=True)
    raw, at = texts(b.column("text"))
    many = at[first + 1] - at[first]
    some = np.flatnonzero(many >= size)
    piece = np.cumsum(many[some]) // PIECE
    for part in np.split(some, np.flatnonzero(np.diff(piece)) + 1):
        if len(part):
            data = np.concatenate([raw[x:y] for x, y in zip(at[first[part]].tolist(), at[first[part] + 1].tolist())])
            yield keys[part], copies[part], sums(data), np.concatenate([[0], np.cumsum(many[part])])


def _rows(cols: list[np.ndarray], names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c.view(np.int64) if c.dtype == np.uint64 else c.astype(np.int64)) for c in cols], names=names)


def _flushed(found: Iterator[list[np.ndarray]], names: list[str], rows: int = 50_000) -> Iterator[pa.RecordBatch]:
    held, n = [], 0
    for cols in found:
        held.append(cols)
        n += len(cols[0])
        if n >= rows:
            yield _rows([np.concatenate(c) for c in zip(*held)], names)
            held, n = [], 0
    if held:
        yield _rows([np.concatenate(c) for c in zip(*held)], names)


def parse(docs: DataFrame, size: int) -> DataFrame:
    """Phrases: gram, context, text_key, lo, hi, copies."""
    names = ["gram", "context", "text_key", "lo", "hi", "copies"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def each():
            for b in batches:
                for keys, copies, s, at in _texts(b, size):
                    q, gram, lo, hi, of = triggers(s, at, size)
                    yield [gram, contexts(s, q, lo, hi, size), keys[of], lo - at[of], hi - at[of], copies[of]]

        yield from _flushed(each(), names)

    return docs.mapInArrow(run, ", ".join(f"{x} long" for x in names))


def _picked(docs: DataFrame, mixed: np.ndarray, size: int, names: list[str], rows_of) -> DataFrame:
    """Rows of the triggers whose gram is in the bitmap. A context counts once in a batch: met twice, all its windows are repeated anyway."""
    spread = docs.sparkSession.sparkContext.broadcast(mixed)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = spread.value

        def each():
            for b in batches:
                seen = np.empty(0, np.uint64)
                for keys, _, s, at in _texts(b, size):
                    q, gram, lo, hi, of = triggers(s, at, size)
                    pick = np.flatnonzero(_set_bits(bits, gram))
                    context, first = np.unique(contexts(s, q[pick], lo[pick], hi[pick], size), return_index=True)
                    new = np.isin(context, seen, assume_unique=True, invert=True)
                    seen = np.concatenate([seen, context[new]])
                    pick = pick[np.sort(first[new])]
                    context = contexts(s, q[pick], lo[pick], hi[pick], size)
                    _, down = _powers.upto(len(s))
                    for mine in np.split(np.arange(len(pick)), np.flatnonzero(np.diff(of[pick])) + 1):
                        if len(mine):
                            i = of[pick[mine[0]]]
                            a, own = at[i], pick[mine]
                            yield from rows_of(keys[i], (s[a:at[i + 1] + 1] - s[a]) * down[a], q[own] - a, lo[own] - a, hi[own] - a, context[mine])

        yield from _flushed(each(), names)

    return docs.mapInArrow(run, ", ".join(f"{x} long" for x in names))


def _blocks(s, q, lo, hi, size: int, block: int):
    """Windows of the triggers in blocks of their distance to the trigger: trigger, first and last window, names of core and whole.

    The core is what all windows of a full block share, so equal windows have equal cores however the blocks are clipped.
    """
    near, far = (q - hi) // block, (q - lo) // block
    many = far - near + 1
    of = np.repeat(np.arange(len(q)), many)
    b = np.repeat(near, many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
    first, last = np.maximum(q[of] - b * block - block + 1, lo[of]), np.minimum(q[of] - b * block, hi[of])
    start = q[of] - b * block
    names = stretch(s, np.concatenate([start, first]), np.concatenate([start - block + 1, last]) + size)
    shape = ((q[of] - first).astype(np.uint64) << np.uint64(32)) | (last - first).astype(np.uint64)
    n = len(of)
    names[:n] += b.astype(np.uint64)
    names[n:] += mixed(shape)
    names = mixed(names)
    return of, first, last, names[:n], names[n:]


def named_blocks(docs: DataFrame, grams: np.ndarray, size: int, block: int) -> DataFrame:
    """core, whole, context, text_key, lo, hi of every block of the triggers in the bitmap."""
    def rows(key, s, q, lo, hi, context):
        of, first, last, core, whole = _blocks(s, q, lo, hi, size, block)
        yield [core, whole, context[of], np.full(len(of), key), first, last]

    return _picked(docs, grams, size, ["core", "whole", "context", "text_key", "lo", "hi"], rows)


def named_windows(docs: DataFrame, grams: np.ndarray, cores: np.ndarray, size: int, block: int) -> DataFrame:
    """name, whole, text_key, lo of every window of the blocks whose core is in the second bitmap."""
    spread = docs.sparkSession.sparkContext.broadcast(cores)

    def rows(key, s, q, lo, hi, context):
        _, first, last, core, whole = _blocks(s, q, lo, hi, size, block)
        pick = np.flatnonzero(_set_bits(spread.value, core))
        if len(pick):
            many = last[pick] - first[pick] + 1
            at = np.repeat(first[pick], many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
            yield [stretch(s, at, at + size), np.repeat(whole[pick], many), np.full(len(at), key), at]

    return _picked(docs, grams, size, ["name", "whole", "text_key", "lo"], rows)


def _unlike(rows: DataFrame, key: str, other: str) -> DataFrame:
    """Values of key that stand with two values of other or more; min and max combine on the map side. Written, so that a join with them is
    dealt by itself and the rows of a frequent value are split."""
    return cut(_mixed_keys(rows, key, other))


def _mixed_keys(rows: DataFrame, key: str, other: str) -> DataFrame:
    return rows.groupBy(key).agg(F.min(other).alias("a"), F.max(other).alias("b")).where("a <> b").select(key)


def marks(docs: DataFrame, size: int = 400, block: int = 16) -> DataFrame:
    """Repeated windows of each distinct text: text_key, lo, hi (first and last start of a row of them)."""
    block = min(block, size)
    d = docs.select(text_key().alias("text_key"), F.col("text").cast("string").alias("text"))
    phrases = cut(parse(d, size))
    grams = phrases.groupBy("gram").agg(F.sum("copies").alias("times"), F.min("context").alias("a"), F.max("context").alias("b")).where("times > 1")
    grams = cut(grams.select("gram", (F.col("a") != F.col("b")).alias("mixed")))
    shared = phrases.join(grams, "gram")
    alike = shared.where("not mixed").select("text_key", "lo", "hi")
    unlike = cut(shared.where("mixed").select("context", "text_key", "lo", "hi", "copies"))
    twice = cut(unlike.groupBy("context").agg(F.sum("copies").alias("times")).where("times > 1").select("context"))
    again = unlike.join(twice, "context").select("text_key", "lo", "hi")
    found = cut(alike.unionByName(again))
    uncut(phrases)
    uncut(unlike)
    gram_bits = bitmap(grams.where("mixed"), "gram")
    blocks = cut(named_blocks(d, gram_bits, size, block))
    core_bits = bitmap(_mixed_keys(blocks, "core", "whole"), "core")
    in_blocks = cut(blocks.join(_unlike(blocks, "whole", "context"), "whole").select("text_key", "lo", "hi"))
    uncut(blocks)
    windows = cut(named_windows(d, gram_bits, core_bits, size, block))
    singles = cut(windows.join(_unlike(windows, "name", "whole"), "name").select("text_key", "lo", F.col("lo").alias("hi")))
    uncut(windows)
    return found.unionByName(in_blocks).unionByName(singles)


def merged(found: DataFrame, size: int) -> DataFrame:
    """One row per text of `marks`: text_key, starts and ends of its runs of repeated bytes; touching ones are one."""
    far = 1 << 40

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.empty(0, np.int64)] * 3  # runs of the last text, which may go on

        def rows(key, start, end) -> pa.RecordBatch:
            first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
            offsets = pa.array(np.append(first, len(key)), pa.int32())
            return pa.record_batch([pa.array(key[first]), *(pa.ListArray.from_arrays(offsets, pa.array(x)) for x in (start, end))], ["text_key", "starts", "ends"])

        for b in batches:
            key, lo, hi = (np.concatenate([h, b.column(c).to_numpy() + more]) for h, c, more in zip(held, ("text_key", "lo", "hi"), (0, 0, size)))
            if not len(key):
                continue
            nth = np.cumsum(np.concatenate([[0], key[1:] != key[:-1]])) * far  # texts lie one after the other
            end = np.maximum.accumulate(hi + nth)
            first = np.flatnonzero(np.concatenate([[True], lo[1:] + nth[1:] > end[:-1]]))
            last = np.append(first[1:], len(key)) - 1
            key, start, end = key[first], lo[first], end[last] - nth[last]
            goes_on = int(np.flatnonzero(key == key[-1])[0])
            if goes_on:
                yield rows(key[:goes_on], start[:goes_on], end[:goes_on])
            held = [key[goes_on:], start[goes_on:], end[goes_on:]]
        if len(held[0]):
            yield rows(*held)

    return found.repartition("text_key").sortWithinPartitions("text_key", "lo").mapInArrow(run, "text_key long, starts array<long>, ends array<long>")


def deduplicate(docs: DataFrame, size: int = 400) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept (the remaining bytes), starts and ends of the removed runs.

    Only texts whose key is in the bitmap of marked ones are joined with their marks; the others pass straight through.
    """
    bounded_batches(docs.sparkSession)
    found = cut(merged(marks(docs, size), size))
    spread = docs.sparkSession.sparkContext.broadcast(bitmap(found, "text_key"))
    d = docs.select("doc_id", text_key().alias("text_key"), F.col("text").cast("string").alias("text"))
    kind = dict(d.dtypes)["doc_id"]
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept", "starts", "ends"]
    schema = f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept binary, starts array<long>, ends array<long>"
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int64())]

    def chosen(b: pa.RecordBatch, marked: bool) -> pa.RecordBatch:
        keys = b.column("text_key").to_numpy(zero_copy_only=False).view(np.uint64)
        return b.filter(pa.array(_set_bits(spread.value, keys) == marked))

    def batch(part: pa.RecordBatch, rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([part.column("doc_id"), *[pa.array(c, t) for c, t in zip(zip(*rows) if rows else [()] * 6, kinds)]], names=names)

    def data(text) -> bytes:
        return text.as_buffer().to_pybytes() if text.is_valid else b""

    def untouched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k in range(0, b.num_rows, 1000):
                part = chosen(b.slice(k, 1000), False)
                yield batch(part, [(len(raw), 0, 0, raw, [], []) for raw in map(data, part.column("text"))])

    def touched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield chosen(b, True)

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k in range(0, b.num_rows, 500):
                part = b.slice(k, 500)
                rows = []
                for text, s, e in zip(part.column("text"), part.column("starts"), part.column("ends")):
                    raw = data(text)
                    s, e = (x.values.to_pylist() if x.is_valid else [] for x in (s, e))
                    kept = b"".join(raw[x:y] for x, y in zip([0, *e], [*s, len(raw)]))
                    rows.append((len(raw), len(raw) - len(kept), len(s), kept, s, e))
                yield batch(part, rows)

    with_marks = d.mapInArrow(touched, f"doc_id {kind}, text_key long, text string").join(found, "text_key", "left")
    return d.mapInArrow(untouched, schema).unionByName(with_marks.select("doc_id", "text", "starts", "ends").mapInArrow(remove, schema))
