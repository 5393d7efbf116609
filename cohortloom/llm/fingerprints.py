"""Digests of improbable features: rare byte windows in chained Bloom filters, compared by bits in common.

Every window of `WINDOW` bytes has the Shannon entropy of its bytes, in thousandths of the largest one. One pass over all texts counts the windows per
entropy; the less often an entropy occurs, the more improbable its windows. Windows of hardly any entropy (one byte over and over) are never taken. In every stretch of
`AROUND` neighbouring windows the most improbable one, the first of equals, gets a vote; windows with `VOTES` or more are the text's features. Their hashes go
into a chain of Bloom filters in text order, a new filter after `FILL` features, each feature once. As a choice depends on at most
`2 * AROUND` windows around it, texts with a passage in common choose the same features in it.

Two filters are as like as the bits they share exceed what chance explains (the expected number and three standard deviations), over the most they could
share beyond that. A text's likeness to another is the mean, by features, of its filters' best matches, seen from the one with fewer features.

A fingerprint is text: per filter its number of features, a dot, and the bits in base64, joined by commas. Entropies of a block of bytes come from
counts of equal bytes at each distance, as whole arrays of integers, so memory does not follow the length of a text.

`beside_next` compares each document with its neighbour in descending order of doc_id. Rows are dealt to buckets by bounds taken from a sample of keys (which
sets the size of the buckets and nothing else); a bucket also gets the first row of the next one, and tasks stream over sorted buckets, so texts cross the network once.

Defined cases: a null text is empty; an empty text has an empty fingerprint, which is alike (1) to an empty one and not (0) to others; a text without
features, such as one shorter than a window, has the hash of the whole text as its one feature; equal texts have equal fingerprints. Null ids come after all
others, rows of one id in order of a hash of the text; a repeated row is a row of its own; a lone document is its own neighbour; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from .arrays import mixed, texts as raw_texts
from .common import whole

WINDOW, AROUND, VOTES = 32, 32, 8  # AROUND is at most WINDOW: windows across two texts then keep the texts apart
BITS, HASHES, FILL = 2048, 5, 160
LEVELS, LEAST = 1000, 100  # entropies, and the least that counts
BLOCK = 1 << 20  # windows worked on at a time
GROUP = 4 << 20  # bytes of texts that are digested together
BUCKET, MOST = 16 << 20, 20_000  # bytes aimed at per bucket, and the number of buckets that the driver keeps bounds of
NEVER = 1023

#: c * log2(c) in 4096ths for c equal bytes; sums over a window of one byte alone reach WHOLE.
WEIGHT = np.round(np.arange(WINDOW + 1) * np.log2(np.maximum(np.arange(WINDOW + 1), 1)) * 4096).astype(np.int32)
WHOLE = int(WEIGHT[WINDOW])
LOSS, GAIN = np.append(0, WEIGHT[:-1] - WEIGHT[1:]).astype(np.int32), (WEIGHT[1:] - WEIGHT[:-1]).astype(np.int32)


def entropies(raw: np.ndarray) -> np.ndarray:
    """Entropy of each window of the bytes, 0 to LEVELS."""
    n = len(raw) - WINDOW + 1
    if n < 1:
        return np.zeros(0, np.int32)
    ahead, behind = np.ones(len(raw), np.uint8), np.zeros(len(raw), np.uint8)
    for d in range(1, WINDOW):
        same = (raw[d:] == raw[:-d]).view(np.uint8)
        ahead[:-d] += same
        behind[d:] += same
    sums = np.empty(n, np.int32)
    sums[0] = WEIGHT[np.bincount(raw[:WINDOW])].sum()
    sums[1:] = LOSS[ahead[:n - 1]] + GAIN[behind[WINDOW:]]
    return (WHOLE - np.cumsum(sums, dtype=np.int32)) * LEVELS // WHOLE


def _sound(at: np.ndarray, lo: int, hi: int) -> np.ndarray:
    """Which windows from lo to hi lie in one text."""
    step = np.zeros(hi - lo + 1, np.int32)
    begin, end = np.maximum(at[:-1], lo), np.minimum(at[1:] - WINDOW + 1, hi)
    some = begin < end
    np.add.at(step, begin[some] - lo, 1)
    np.add.at(step, end[some] - lo, -1)
    return np.cumsum(step[:-1]) > 0


def histogram(raw: np.ndarray, at: np.ndarray) -> np.ndarray:
    """How many windows of the texts have each entropy."""
    out = np.zeros(LEVELS + 1, np.int64)
    base, size = int(at[0]), int(at[-1] - at[0])
    for lo in range(0, size - WINDOW + 1, BLOCK):
        hi = min(lo + BLOCK, size - WINDOW + 1)
        e = entropies(raw[base + lo:base + hi + WINDOW - 1])
        out += np.bincount(e[_sound(at - base, lo, hi)], minlength=LEVELS + 1)
    return out


def features(raw: np.ndarray, at: np.ndarray, ranks: np.ndarray) -> np.ndarray:
    """First bytes of the chosen windows of all texts, in order. at: where each text begins, and the end, from 0 on."""
    out, size = [np.zeros(0, np.int64)], len(raw) - WINDOW + 1
    for start in range(0, size, BLOCK):
        stop = min(start + BLOCK, size)
        lo, hi = max(0, start - AROUND + 1), min(size, stop + AROUND - 1)
        rank = ranks[entropies(raw[lo:hi + WINDOW - 1])]
        rank[~_sound(at, lo, hi)] = NEVER
        key = np.full(hi - lo + 2 * (AROUND - 1), NEVER << 21, np.uint32)
        key[AROUND - 1:AROUND - 1 + hi - lo] = (rank << 21) | np.arange(hi - lo, dtype=np.uint32)
        span = 1
        while span < AROUND:
            key = np.minimum(key[:-span], key[span:])
            span *= 2
        votes = np.bincount(key[key < (NEVER << 21)] & ((1 << 21) - 1), minlength=hi - lo)[start - lo:stop - lo]
        out.append(np.flatnonzero(votes >= VOTES) + start)
    return np.concatenate(out)


class Digests(NamedTuple):
    """Filters of several texts: packed bits, features per filter, and where each text's filters begin, and the end."""

    bits: np.ndarray
    count: np.ndarray
    at: np.ndarray


def digest(data: list[bytes], ranks: np.ndarray) -> Digests:
    at = np.concatenate([[0], np.cumsum([len(d) for d in data])]).astype(np.int64)
    raw = np.frombuffer(b"".join(data), np.uint8)
    pos = features(raw, at, ranks)
    hashes = np.full(len(pos), 0x9E3779B97F4A7C15, np.uint64)
    words = np.ascontiguousarray(raw[pos[:, None] + np.arange(WINDOW)]).view("<u8").reshape(len(pos), WINDOW // 8)
    for j in range(WINDOW // 8):
        hashes = mixed(hashes ^ words[:, j])
    text = np.searchsorted(at, pos, side="right") - 1
    found = np.bincount(text, minlength=len(data))
    plain = [i for i in np.flatnonzero(found == 0) if data[i]]
    if plain:
        text = np.append(text, plain)
        hashes = np.append(hashes, np.array([int.from_bytes(hashlib.blake2b(data[i], digest_size=8).digest(), "little") for i in plain], np.uint64))
    order = np.lexsort((hashes, text))  # stable: of equal features of a text the first stays first
    new = np.ones(len(order), bool)
    new[1:] = (text[order][1:] != text[order][:-1]) | (hashes[order][1:] != hashes[order][:-1])
    keep = np.sort(order[new])
    keep = keep[np.argsort(text[keep], kind="stable")]
    text, hashes = text[keep], hashes[keep]
    n = np.bincount(text, minlength=len(data))
    filters = -(-n // FILL)
    first = np.concatenate([[0], np.cumsum(filters)])
    own = np.arange(len(text)) - (np.cumsum(n) - n)[text]
    row = first[text] + own // FILL
    bits = np.zeros((int(first[-1]), BITS), bool)
    width = BITS.bit_length() - 1
    for j in range(HASHES):
        bits[row, (hashes >> np.uint64(j * width)) & np.uint64(BITS - 1)] = True
    return Digests(np.packbits(bits, axis=1), np.bincount(row, minlength=int(first[-1])), first)


def written(d: Digests) -> list[str]:
    one = [f"{n}.{base64.b64encode(b.tobytes()).decode()}" for n, b in zip(d.count, d.bits)]
    return [",".join(one[a:b]) for a, b in zip(d.at[:-1], d.at[1:])]


def read(fingerprints: list[str]) -> Digests:
    parts = [[p.split(".") for p in f.split(",")] if f else [] for f in fingerprints]
    flat = [p for ps in parts for p in ps]
    bits = np.frombuffer(b"".join(base64.b64decode(b) for _, b in flat), np.uint8).reshape(len(flat), BITS // 8)
    return Digests(bits, np.array([int(n) for n, _ in flat], np.int64), np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int64))


PAIRS = 1 << 16  # filter pairs compared at a time


def likeness(a: Digests, i: np.ndarray, b: Digests, j: np.ndarray) -> np.ndarray:
    """Likeness of text i of a and text j of b, for all given pairs, 0 to 1."""
    total = lambda d: np.concatenate([[0], np.cumsum(d.count)])[d.at[1:]] - np.concatenate([[0], np.cumsum(d.count)])[d.at[:-1]]
    swap = total(a)[i] > total(b)[j]
    bits = np.concatenate([a.bits, b.bits]).view(np.uint64).reshape(-1, BITS // 64)
    count, set_bits = np.concatenate([a.count, b.count]), np.bitwise_count(bits).sum(axis=1).astype(np.float64)
    spans = lambda d, k, base: (d.at[k] + base, d.at[k + 1] - d.at[k])
    (a0, an), (b0, bn) = spans(a, i, 0), spans(b, j, len(a.bits))
    f0, fn = np.where(swap, b0, a0), np.where(swap, bn, an)
    g0, gn = np.where(swap, a0, b0), np.where(swap, an, bn)
    row = np.repeat(f0 - (np.cumsum(fn) - fn), fn) + np.arange(fn.sum())  # filters of the side with fewer features
    pair = np.repeat(np.arange(len(i)), fn)
    best = np.zeros(len(row))
    width = gn[pair]
    edges = np.cumsum(width)
    lo = 0
    while lo < len(row):
        hi = max(lo + 1, int(np.searchsorted(edges, (edges[lo - 1] if lo else 0) + PAIRS, side="right")))
        w = width[lo:hi]
        x = np.repeat(row[lo:hi], w)
        y = np.repeat(g0[pair[lo:hi]] - (np.cumsum(w) - w), w) + np.arange(w.sum())
        shared = np.bitwise_count(bits[x] & bits[y]).sum(axis=1)
        most, share = np.minimum(set_bits[x], set_bits[y]), np.maximum(set_bits[x], set_bits[y]) / BITS
        chance = np.minimum(most * share + 3 * np.sqrt(most * share * (1 - share)), most - 0.5)
        score = np.clip((shared - chance) / (most - chance), 0, 1)
        full = np.flatnonzero(w)
        if len(full):
            best[lo:hi][full] = np.maximum.reduceat(score, (np.cumsum(w) - w)[full])
        lo = hi
    weighted = np.bincount(pair, best * count[row], minlength=len(i))
    out = weighted / np.maximum(np.bincount(pair, count[row], minlength=len(i)), 1)
    return np.where((fn == 0) & (gn == 0), 1.0, np.where((fn == 0) | (gn == 0), 0.0, np.minimum(out, 1.0)))


def rarity(docs: DataFrame) -> tuple[np.ndarray, int]:
    """Rank of each entropy, the least frequent first, over all windows of all texts; and the bytes of all texts."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, size = np.zeros(LEVELS + 1, np.int64), 0
        for batch in it:
            raw, at = raw_texts(batch.column("text"))
            counts += histogram(raw, at)
            size += int(at[-1] - at[0])
        level = np.append(np.flatnonzero(counts), -1)
        yield pa.record_batch([pa.array(level, pa.int32()), pa.array(np.append(counts[level[:-1]], size), pa.int64())], ["level", "n"])

    found = docs.select(F.col("text").cast("string").alias("text")).mapInArrow(run, "level int, n long").groupBy("level").agg(F.sum("n").alias("n")).collect()  # LEVELS + 2 rows
    counts = {r.level: r.n for r in found}
    n = np.array([counts.get(k, 0) for k in range(LEVELS + 1)], object)
    ranks = np.full(LEVELS + 1, NEVER, np.uint32)
    order = sorted(range(LEAST, LEVELS + 1), key=lambda k: (n[k], k))
    ranks[order] = np.arange(len(order))
    return ranks, int(counts.get(-1, 0))


def fingerprint(docs: DataFrame, ranks: np.ndarray | None = None) -> DataFrame:
    """doc_id, n_chars and fingerprint of every document."""
    ranks = rarity(docs)[0] if ranks is None else ranks

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            for ids, data in _groups(batch):
                chars = [len(d.decode()) for d in data]
                yield pa.record_batch([ids, pa.array(chars, pa.int64()), pa.array(written(digest(data, ranks)))], ["doc_id", "n_chars", "fingerprint"])

    kind = dict(docs.dtypes)["doc_id"]
    return docs.select("doc_id", whole().alias("text")).mapInArrow(run, f"doc_id {kind}, n_chars long, fingerprint string")


def _groups(batch: pa.RecordBatch) -> Iterator[tuple[pa.Array, list[bytes]]]:
    data = batch.column("text").cast(pa.large_binary())
    sizes = np.cumsum(pc.binary_length(data).to_numpy(zero_copy_only=False))
    first = 0
    while first < len(data):
        last = max(first + 1, int(np.searchsorted(sizes, (sizes[first - 1] if first else 0) + GROUP, side="right")))
        yield batch.column("doc_id").slice(first, last - first), data.slice(first, last - first).to_pylist()
        first = last


@F.pandas_udf(DoubleType())
def alike(a: pd.Series, b: pd.Series) -> pd.Series:
    """Likeness of two columns of fingerprints."""
    every = np.arange(len(a))
    return pd.Series(likeness(read(a.tolist()), every, read(b.tolist()), every))


def _bucket(bounds: list[tuple[int, int]]) -> Column:
    """Number of bounds up to (k, h)."""
    k0, h0 = (np.array([b[i] for b in bounds], np.int64) for i in (0, 1))

    @F.pandas_udf("int")
    def number(k: pd.Series, h: pd.Series) -> pd.Series:
        k, h = k.to_numpy(), h.to_numpy()
        lo, hi = np.searchsorted(k0, k, side="left"), np.searchsorted(k0, k, side="right")
        out = lo.copy()
        for at in np.unique(lo[lo < hi]):  # bounds that share the id
            rows = np.flatnonzero((lo == at) & (hi > lo))
            out[rows] = at + np.searchsorted(h0[at:hi[rows[0]]], h[rows], side="right")
        return pd.Series(out.astype(np.int32))

    return number("k", "h")


def bucketed(docs: DataFrame, size: int) -> DataFrame:
    """doc_id, text, bucket and border, buckets sorted and each in one partition; the last row of a bucket, the border, is a copy of the row after it."""
    keys = [F.bitwise_not(F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63)).cast("long"))).alias("k"), F.xxhash64(whole()).alias("h")]
    d = docs.select("doc_id", whole().alias("text"), *keys)
    parts = max(1, min(MOST, -(-size // BUCKET)))
    bounds = []
    if parts > 1:
        rows = docs.count()
        some = sorted(tuple(r) for r in docs.select(*keys).sample(False, min(1.0, 40 * parts / max(rows, 1)), seed=12).collect())  # 40 a bucket
        bounds = sorted({some[len(some) * p // parts] for p in range(1, parts)}) if some else []
    d = d.withColumn("bucket", _bucket(bounds) if bounds else F.lit(0))
    firsts = sorted((r.bucket, r.f.k, r.f.h) for r in d.groupBy("bucket").agg(F.min(F.struct("k", "h")).alias("f")).collect())  # a row per bucket
    before = [(k, h, firsts[n - 1][0]) for n, (_, k, h) in enumerate(firsts)]
    borders = docs.select("doc_id", whole().alias("text"), *keys).join(F.broadcast(docs.sparkSession.createDataFrame(before, "k long, h long, bucket int")), ["k", "h"])
    borders = borders.groupBy("bucket").agg(F.first(F.struct("doc_id", "text", "k", "h")).alias("r")).select("r.*", "bucket")
    both = d.withColumn("border", F.lit(False)).unionByName(borders.withColumn("border", F.lit(True)))
    return both.repartitionById(parts, "bucket").sortWithinPartitions("bucket", "border", "k", "h").select("doc_id", "text", "border")


def edit(text: str, other: str) -> str:
    """The text whose second half is replaced by the start of the other one."""
    half = len(text) // 2
    return text[:len(text) - half] + other[:half]


def beside_next(docs: DataFrame) -> DataFrame:
    """Each document and its neighbour in descending order of doc_id: doc_id, n_chars, edited (the text with its second half replaced by the neighbour's start, as
    SHA-256), fingerprint, edited_fingerprint, near_edited, near_next."""
    ranks, size = rarity(docs)
    kind = dict(docs.dtypes)["doc_id"]

    def group(rows: list[tuple], ids: pa.DataType) -> pa.RecordBatch:
        """All rows but the last, which is the neighbour of the one before it; borders only serve as neighbours."""
        text = [r[1] for r in rows]
        mine = [n for n in range(len(rows) - 1) if not rows[n][2]]
        edited = [edit(text[n], text[n + 1]).encode() for n in mine]
        own, other = digest([t.encode() for t in text], ranks), digest(edited, ranks)
        at = np.array(mine, np.int64)
        prints = written(own)
        return pa.record_batch(
            [pa.array([rows[n][0] for n in mine], ids), pa.array([len(text[n]) for n in mine], pa.int64()), pa.array([hashlib.sha256(e).hexdigest() for e in edited], pa.string()),
             pa.array([prints[n] for n in mine], pa.string()), pa.array(written(other), pa.string()), pa.array(likeness(own, at, other, np.arange(len(mine)))), pa.array(likeness(own, at, own, at + 1))],
            ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, held, ids = [], 0, None
        for batch in it:
            ids = batch.schema.field("doc_id").type
            for row in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "border"))):
                rows.append(row)
                held += len(row[1])
                if held > GROUP and len(rows) > 1:
                    yield group(rows, ids)
                    rows, held = rows[-1:], len(rows[-1][1])
        if len(rows) > 1:
            yield group(rows, ids)

    return bucketed(docs, size).mapInArrow(run, f"doc_id {kind}, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")
