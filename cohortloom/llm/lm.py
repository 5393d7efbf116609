"""Language-model scores by deleted interpolation.

A token's probability mixes three maximum-likelihood estimates: after its predecessor (count of the two / count of the predecessor), by itself
(count / all tokens), and uniform over the vocabulary and one unseen token. The weights depend on how frequent the predecessor is,
one set per bucket, and are learned by expectation-maximisation on held-out counts: a fifth of the training documents is deleted from the counts while
the weights are learned on it, and is counted again in the model. Documents that are not for training set nothing.

All words and all pairs of words are counted, over all training documents. The most frequent words (WORDS of them at most, or those with at least `heavy`
of the tokens) and pairs with at least `pair_share` (at most 1 / pair_share) go to every task as sorted arrays. All others stay tables: tokens that
need one of them leave their task, added up by row and pair, and are joined by shuffle, in SHARES passes by the pair's hash, each of which drops its
shuffle files before the next. Pairs and these tokens travel as packed arrays, one row for each stretch of hashes (BUCKET training tokens or fewer on average; their number
grows with the input): within a task a stretch's counts come first and its tokens stream past them. Tokens with words that are not at hand get these by a join of their own, once
for all passes. No single pair of training documents makes more than those shares of the training tokens. Each predecessor's pair counts add up to its own count but
for the batches' edges.

Rows are numbered in each of the passes over the documents, which must therefore be a table read from files.

Defined cases: a null text is empty and scores its end alone; the token before the first is the end; without training documents all
counts are 0 and every token has the uniform probability; words are told apart by 64-bit hashes; repeated rows count each time; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import bounded_batches, cut, uncut
from . import arrays

BUCKETS = 8
SHARES = 4  # passes over the pairs that are joined, by hash: a power of two
WORDS = 1 << 20  # words that go to every task at most
BUCKET = 1 << 18  # training tokens of a stretch of pairs' hashes, about
_END = np.uint64(0x243F6A8885A308D3)


def tokens(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All tokens of the texts, each text's end included, as 64-bit hashes; number of tokens of each text."""
    hashes, counts = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    for _, h, at in arrays.words(column):
        hashes.append(h)
        counts.append(np.diff(at))
    n = np.concatenate(counts) + 1
    out = np.full(int(n.sum()), _END, np.uint64)
    own = np.ones(len(out), bool)
    own[np.cumsum(n) - 1] = False
    out[own] = np.concatenate(hashes)
    return out, n


def before(tok: np.ndarray) -> np.ndarray:
    """The token before each: texts end in the end token, so that a first token follows one as well."""
    return np.concatenate([np.array([_END]), tok[:-1]])


def pair(prev: np.ndarray, tok: np.ndarray) -> np.ndarray:
    return arrays.mixed(prev * np.uint64(0x9E3779B97F4A7C15) + tok)


class Table:
    """Counts by sorted key. Keys are hashes, so that their leading bits lead to a few keys each; where they don't, the search is by halves."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray):
        order = np.argsort(keys)
        self.keys, self.counts, self._index = keys[order], counts[order], None

    def __getstate__(self):
        return self.__dict__ | {"_index": None}  # each task's process makes its own

    def index(self) -> tuple[np.uint64, np.ndarray, bool]:
        """Shift to the leading bits, where each value of them begins, and whether no value has many keys."""
        if self._index is None:
            bits = len(self.keys).bit_length()
            shift = np.uint64(64 - bits)
            starts = np.zeros((1 << bits) + 1, np.int32)
            np.cumsum(np.bincount((self.keys >> shift).astype(np.int64), minlength=1 << bits), out=starts[1:])
            self._index = shift, starts, bool(np.diff(starts).max() <= 64)
        return self._index

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Counts, 0 where the key is not listed."""
        out = np.zeros(len(keys), np.int64)
        if not len(self.keys):
            return out
        shift, starts, even = self.index()
        if not even:
            at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
            return np.where(self.keys[at] == keys, self.counts[at], 0)
        lead = (keys >> shift).astype(np.int64)
        at, end = starts[lead], starts[lead + 1]
        todo = np.flatnonzero(at < end)
        at, end, keys = at[todo], end[todo], keys[todo]
        while len(todo):
            hit = self.keys[at] == keys
            out[todo[hit]] = self.counts[at[hit]]
            at = at + 1
            more = ~hit & (at < end)
            todo, at, end, keys = todo[more], at[more], end[more], keys[more]
        return out


def _packed(starts: np.ndarray, *columns: np.ndarray) -> list[pa.Array]:
    """Whole numbers of 64 bits as bytes: one value from each start to the next, the last start being the end."""
    at = pa.py_buffer((starts * 8).astype(np.int32))
    return [pa.Array.from_buffers(pa.binary(), len(starts) - 1, [None, at, pa.py_buffer(np.ascontiguousarray(c).view(np.int64).astype("<i8"))]) for c in columns]


def _unpacked(column: pa.Array) -> np.ndarray:
    """All numbers of a column of _packed."""
    column = column.cast(pa.large_binary())
    _, offsets, data = column.buffers()
    if not len(column) or data is None:
        return np.zeros(0, np.int64)
    at = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    return np.frombuffer(data, np.uint8)[at[0]:at[-1]].view("<i8")


def _gathered(packed: DataFrame) -> Table:
    """The table of packed keys and c; its bound is in the callers."""
    found = packed.collect()
    keys, counts = (np.frombuffer(b"".join(r[k] for r in found), "<i8") for k in (0, 1))
    return Table(keys.view(np.uint64), counts)


def _collected(df: DataFrame, key: str) -> Table:
    """The table's rows, which the tasks pack into bytes, so that the driver holds no objects for them."""
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                yield pa.RecordBatch.from_arrays(_packed(np.array([0, b.num_rows]), *[c.to_numpy(zero_copy_only=False) for c in b.columns]), names=["keys", "c"])

    return _gathered(df.select(key, "c").mapInArrow(pack, "keys binary, c binary"))


def _collected_pairs(pairs: DataFrame, column: str, least: float) -> Table:
    """Pairs whose count in this column of pair_counts is `least` or more."""
    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            c = _unpacked(b.column(column))
            at = np.flatnonzero(c >= max(least, 1))
            if len(at):
                yield pa.RecordBatch.from_arrays(_packed(np.array([0, len(at)]), _unpacked(b.column("keys"))[at], c[at]), names=["keys", "c"])

    return _gathered(pairs.select("keys", column).mapInArrow(pick, "keys binary, c binary"))


def _counted(df: DataFrame, keys_of) -> DataFrame:
    """key, c and, of these, away in documents with `tune`: counted within each batch, then over all."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            tok, n = tokens(b.column("text"))
            key, at, c = np.unique(keys_of(tok), return_inverse=True, return_counts=True)
            tune = np.repeat(b.column("tune").to_numpy(zero_copy_only=False).astype(np.int64), n)
            away = np.bincount(at.reshape(-1), tune, len(key)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(c.astype(np.int64)), pa.array(away)], names=["key", "c", "away"])

    return df.select("text", "tune").mapInArrow(run, "key long, c long, away long").groupBy("key").agg(F.sum("c").alias("c"), F.sum("away").alias("away"))


def stretches(total: int) -> int:
    """Number of stretches of the pairs' hashes: a power of two, as many in each of the SHARES passes."""
    return SHARES << max(0, (max(total, 1) // (SHARES * BUCKET)).bit_length())


def _edges(sorted_pairs: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The stretches, of n, that these pairs are in, and where each begins, with the end."""
    of = (sorted_pairs >> np.uint64(64 - n.bit_length() + 1)).astype(np.int64)
    starts = np.flatnonzero(np.concatenate([[True], of[1:] != of[:-1]])) if len(of) else np.zeros(0, np.int64)
    return of[starts], np.append(starts, len(of))


def _chunks(n: int, most: int = 1 << 22) -> Iterator[slice]:
    for k in range(0, n, most):
        yield slice(k, k + most)


def pair_counts(train: DataFrame, n: int) -> DataFrame:
    """One row for each stretch of pairs: stretch, and packed the pairs in order (keys), their counts (c) and those without documents with `tune` (rest)."""
    schema, names = "stretch long, keys binary, c binary, rest binary", ["stretch", "keys", "c", "rest"]

    def added(keys: np.ndarray, *columns: np.ndarray) -> list[np.ndarray]:
        order = np.argsort(keys)
        keys = keys[order]
        starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        return [keys[starts], *[np.add.reduceat(c[order], starts) for c in columns]]

    def rows(keys: np.ndarray, *columns: np.ndarray) -> list[pa.Array]:
        of, starts = _edges(keys, n)
        return [pa.array(of), *_packed(starts, keys, *columns)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            tok, many = tokens(b.column("text"))
            two = pair(before(tok), tok)
            kept = np.repeat(~b.column("tune").to_numpy(zero_copy_only=False).astype(bool), many).astype(np.int64)
            for k in _chunks(len(two)):
                yield pa.RecordBatch.from_arrays(rows(*added(two[k], np.ones(len(two[k]), np.int64), kept[k])), names=names)

    def merged(t: pa.Table) -> pa.Table:
        keys, *columns = [np.concatenate([_unpacked(c) for c in t.column(x).chunks]) for x in names[1:]]
        return pa.Table.from_arrays(rows(*added(keys.view(np.uint64), *columns)), names=names)

    return train.select("text", "tune").mapInArrow(run, schema).groupBy("stretch").applyInArrow(merged, schema)


def _pieces(batches: Iterator[pa.RecordBatch], rows: int = 1000) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for k in range(0, b.num_rows, rows):
            yield b.slice(k, rows)


def bucket_of(c: np.ndarray, total: int) -> np.ndarray:
    """0 for predecessors that are not in the training documents, then by powers of ten of the relative frequency, rare to frequent."""
    with np.errstate(divide="ignore"):
        return np.clip(np.floor(np.log10(np.maximum(c, 1) / max(total, 1))) + BUCKETS, 1, BUCKETS - 1).astype(np.int64) * (c > 0)


class Model:
    """What a task needs: counts of heavy words and pairs, totals, weights per bucket."""

    def __init__(self, words: Table, pairs: Table, total: int, distinct: int):
        self.words, self.pairs, self.total, self.distinct = words, pairs, total, distinct
        self.weights = np.tile([0.4, 0.4, 0.2], (BUCKETS, 1))
        self.weights[0] = [0.0, 0.8, 0.2]

    def look_up(self, tok: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Count of the word, of its predecessor and of both; 0: not heavy."""
        return *self.counts(tok), self.pairs.find(pair(before(tok), tok))

    def counts(self, tok: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Count of the word and of its predecessor."""
        key, at = np.unique(tok, return_inverse=True)
        c = self.words.find(key)[at.reshape(-1)]
        return c, np.concatenate([self.words.find(np.array([_END])), c[:-1]])


def grouped(row: np.ndarray, two: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first place of each pair of a row, by pair, and how often it is there; rows are in order."""
    order = np.argsort(two, kind="stable")
    row, two = row[order], two[order]
    starts = np.flatnonzero(np.concatenate([[True], (two[1:] != two[:-1]) | (row[1:] != row[:-1])])) if len(row) else np.zeros(0, np.int64)
    return order[starts], np.diff(np.append(starts, len(row)))


def far_tokens(docs: DataFrame, spread, unigrams: DataFrame, rows: bool) -> DataFrame:
    """Tokens with a word, their own or the one before, that is not at hand: row_id (0 unless `rows`), two, c, prev, n, asked (c was not at hand)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = spread.value
        for b in _pieces(batches):
            tok, many = tokens(b.column("text"))
            c, prev = m.counts(tok)
            at = np.flatnonzero((c == 0) | (prev == 0))
            ahead, row = before(tok)[at], np.repeat(b.column("row_id").to_numpy() if rows else np.zeros(len(many), np.int64), many)[at]
            tok, c, prev = tok[at], c[at], prev[at]
            two = pair(ahead, tok)
            at, n = grouped(row, two)
            key = lambda k, known: pa.array(k[at].view(np.int64), mask=known[at] > 0)
            yield pa.RecordBatch.from_arrays([pa.array(row[at]), key(tok, c), key(ahead, prev), pa.array(two[at].view(np.int64)), pa.array(c[at]), pa.array(prev[at]), pa.array(n)], names=names)

    def fill(t: DataFrame, key: str, column: str) -> DataFrame:
        """A word that is not asked for is replaced by its pair, which spreads the rows; its match is not used."""
        known = unigrams.select(F.col("key").alias("k"), F.col("c").alias("found"))
        filled = F.when(F.col(key).isNull(), F.col(column)).otherwise(F.coalesce("found", F.lit(0)))
        return t.withColumn("at", F.coalesce(key, "two")).join(known, F.col("at") == F.col("k"), "left").withColumn(column, filled).drop("at", "k", "found")

    names = ["row_id", "word", "ahead", "two", "c", "prev", "n"]
    found = docs.select(*(["row_id"] if rows else []), "text").mapInArrow(run, ", ".join(f"{x} long" for x in names))
    return fill(fill(found, "word", "c"), "ahead", "prev").select("row_id", "two", "c", "prev", "n", F.col("word").isNotNull().alias("asked"))


PACKED = "stretch long, kind int, two binary, n binary, row_id binary, c binary, prev binary, asked binary"


def open_tokens(docs: DataFrame, far: DataFrame, spread, n: int, rows: bool, share: int) -> DataFrame:
    """PACKED, kind 1, of one share of the tokens whose pairs are not at hand."""
    names = [x.split()[0] for x in PACKED.split(", ")]

    def packed(two: np.ndarray, *columns: np.ndarray) -> pa.RecordBatch:
        of, starts = _edges(two, n)
        return pa.RecordBatch.from_arrays([pa.array(of), pa.array(np.ones(len(of), np.int32)), *_packed(starts, two, *columns)], names=names)

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = spread.value
        for b in batches:
            tok, many = tokens(b.column("text"))
            two = pair(before(tok), tok)
            at = np.flatnonzero(two >> np.uint64(65 - SHARES.bit_length()) == np.uint64(share))
            row = np.repeat(b.column("row_id").to_numpy() if rows else np.zeros(len(many), np.int64), many)[at]
            two, tok, ahead = two[at], tok[at], before(tok)[at]
            for k in _chunks(len(two)):
                first, times = grouped(row[k], two[k])
                r, t, c, prev = row[k][first], two[k][first], m.words.find(tok[k][first]), m.words.find(ahead[k][first])
                keep = np.flatnonzero((c > 0) & (prev > 0) & ((m.pairs.find(t) == 0) | (not rows)))
                yield packed(t[keep], times[keep], r[keep], c[keep], prev[keep], np.zeros(len(keep), np.int64))

    def ordered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            two, *columns = [b.column(x).cast(pa.int64()).to_numpy() for x in names[2:]]
            order = np.argsort(two.view(np.uint64))
            yield packed(two.view(np.uint64)[order], *[c[order] for c in columns])

    far = far.where(F.shiftrightunsigned("two", 65 - SHARES.bit_length()) == share).select(*names[2:])
    return docs.select(*(["row_id"] if rows else []), "text").mapInArrow(near, PACKED).unionByName(far.mapInArrow(ordered, PACKED))


def resolved(docs: DataFrame, far: DataFrame, spread, pairs: DataFrame, n: int, rows: bool, share: int) -> DataFrame:
    """Of one share of the open tokens: with `rows` row_id, n, and the sums more (words asked for and known), base_more and score_more; else how many tokens (n) there are by
    bucket, count of the pair, of the word before (0 where the pair has none) and of the word."""
    def added(keys: list[np.ndarray], sums: list[np.ndarray], names: list[str]) -> pa.RecordBatch:
        order = np.lexsort(keys)
        keys = [k[order] for k in keys]
        starts = np.flatnonzero(np.concatenate([[True], np.any([k[1:] != k[:-1] for k in keys], axis=0)]))
        return pa.RecordBatch.from_arrays([pa.array(k[starts]) for k in keys] + [pa.array(np.add.reduceat(x[order], starts)) for x in sums], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = spread.value
        floor = m.total + 0.5 * (m.distinct + 1)
        last, keys, counts = -1, np.zeros(0, np.uint64), np.zeros(0, np.int64)
        for b in batches:
            # stretches come in order, a stretch's counts before its tokens, so that the counts' keys are in order as well
            known = b.filter(pa.array(b.column("kind").to_numpy() == 0))
            if known.num_rows:
                if last != b.column("stretch")[0].as_py():
                    keys, counts = keys[:0], counts[:0]
                keys, counts = np.concatenate([keys, _unpacked(known.column("two")).view(np.uint64)]), np.concatenate([counts, _unpacked(known.column("n"))])
            asking = b.filter(pa.array(b.column("kind").to_numpy() == 1))
            two, times, row, c, prev, asked = [_unpacked(asking.column(x)) for x in names]
            if len(two):
                both = np.zeros(len(two), np.int64)
                if len(keys):
                    at = np.minimum(np.searchsorted(keys, two.view(np.uint64)), len(keys) - 1)
                    both = np.where(keys[at] == two.view(np.uint64), counts[at], 0)
                level = bucket_of(prev, m.total)
                if rows:
                    w = m.weights[level]
                    p = w[:, 0] * both / np.maximum(prev, 1) + w[:, 1] * c / max(m.total, 1) + w[:, 2] / (m.distinct + 1)
                    yield added([row], [times, times * asked * (c > 0), times * asked * np.log10((c + 0.5) / floor), times * np.log10(p)], ["row_id", "n", "more", "base_more", "score_more"])
                else:
                    yield added([level, both, np.where(both > 0, prev, 0), c], [times], ["bucket", "pair", "prev", "c", "n"])
            last = b.column("stretch")[b.num_rows - 1].as_py() if b.num_rows else last
            edge = np.searchsorted(keys, np.uint64(max(last, 0) << (65 - n.bit_length())))
            keys, counts = keys[edge:], counts[edge:]

    names = [x.split()[0] for x in PACKED.split(", ")][2:]
    none = F.lit(b"").alias
    per = n // SHARES
    given = pairs.where((F.col("stretch") >= share * per) & (F.col("stretch") < (share + 1) * per))
    given = given.select("stretch", F.lit(0).alias("kind"), F.col("keys").alias("two"), F.col("c" if rows else "rest").alias("n"), *map(none, names[2:]))
    every = given.unionByName(open_tokens(docs, far, spread, n, rows, share)).repartition("stretch").sortWithinPartitions("stretch", "kind")
    return every.mapInArrow(run, "row_id long, n long, more long, base_more double, score_more double" if rows else "bucket long, pair long, prev long, c long, n long")


def least(words: DataFrame) -> int:
    """The least power of two that at most WORDS words reach."""
    levels = words.groupBy(F.floor(F.log2("c")).alias("level")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("level")).collect()  # 63 rows at most
    above, level = 0, 62
    for row in levels:
        above += row.n
        if above > WORDS:
            break
        level = row.level
    return 1 << level


def fit(train: DataFrame, heavy: float | None, pair_share: float) -> tuple[Model, DataFrame, DataFrame, int]:
    """The model, the counts of all words (key, c), pair_counts, and the number of stretches."""
    train = train.withColumn("tune", F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 5 == 0)
    unigrams = cut(_counted(train, lambda t: t), drop_shuffles=True)
    sizes = lambda words: words.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.lit(1))).first()
    n = stretches(sizes(unigrams)[0])
    pairs = cut(pair_counts(train, n), drop_shuffles=True)

    def made(words: DataFrame, column: str) -> Model:
        total, distinct = sizes(words)
        return Model(_collected(words.where(F.col("c") >= (least(words) if heavy is None else heavy * total)), "key"), _collected_pairs(pairs, column, pair_share * total), total, distinct)

    rest = unigrams.select("key", (F.col("c") - F.col("away")).alias("c")).where("c > 0")
    model = made(unigrams, "c")
    model.weights = learn(made(rest, "rest"), train.where("tune"), rest, pairs, n).weights
    return model, unigrams, pairs, n


def learn(model: Model, tune: DataFrame, unigrams: DataFrame, pairs: DataFrame, n: int) -> Model:
    """Weights by expectation-maximisation over the tokens of documents that are not in the counts, grouped by bucket and counts; ends when a round gains under
    1e-5 a token."""
    spread = tune.sparkSession.sparkContext.broadcast(model)
    tune = cut(tune.select("text"))  # read in each pass, without the others
    far = cut(far_tokens(tune, spread, unigrams, rows=False), drop_shuffles=True)

    def level(share: int) -> DataFrame:
        return cut(resolved(tune, far, spread, pairs, n, rows=False, share=share).groupBy("bucket", "pair", "prev", "c").agg(F.sum("n").alias("n")), drop_shuffles=True)

    hist = reduce(DataFrame.unionByName, [level(k) for k in range(SHARES)])
    spread.destroy()  # the tables of `hist` are written
    uncut(far)
    uncut(tune)
    parts = [F.when(F.col("prev") > 0, F.col("pair") / F.col("prev")).otherwise(0.0), F.col("c") / max(model.total, 1), F.lit(1 / (model.distinct + 1))]
    last = None
    while True:
        weight = lambda k: F.element_at(F.array(*[F.lit(float(x)) for x in model.weights[:, k]]), (F.col("bucket") + 1).cast("int"))
        share = [weight(k) * p for k, p in enumerate(parts)]
        prob = share[0] + share[1] + share[2]
        rows = hist.groupBy("bucket").agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.log(prob)).alias("ll"), *[F.sum(F.col("n") * s / prob).alias(f"w{k}") for k, s in enumerate(share)]).collect()  # a row per bucket
        tokens_seen = sum(r.n for r in rows)
        gained = sum(r.ll for r in rows) / max(tokens_seen, 1)
        for r in rows:
            w = np.maximum(np.array([r.w0, r.w1, r.w2]) / r.n, [0.0, 0.0, 1e-6])  # unseen words keep a chance
            model.weights[r.bucket] = w / w.sum()
        if last is not None and gained - last < 1e-5 or not tokens_seen:
            return model
        last = gained


def score(docs: DataFrame, is_held, heavy: float | None = None, pair_share: float = 1e-5) -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score (smoothed single counts), score (log10 of the model)."""
    bounded_batches(docs.sparkSession)
    d = docs.select("doc_id", is_held.alias("held_out"), F.monotonically_increasing_id().alias("row_id"), F.col("text").cast("string").alias("text"))
    model, unigrams, pairs, n_stretches = fit(d.where("not held_out"), heavy, pair_share)
    spread = docs.sparkSession.sparkContext.broadcast(model)
    total, distinct = model.total, model.distinct
    floor = total + 0.5 * (distinct + 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = spread.value
        for b in _pieces(batches):
            tok, n = tokens(b.column("text"))
            c, prev, both = m.look_up(tok)
            w = m.weights[bucket_of(prev, total)]
            known = c > 0
            done = known & (prev > 0) & (both > 0)
            p = np.where(done, w[:, 0] * both / np.maximum(prev, 1) + w[:, 1] * c / max(total, 1) + w[:, 2] / (distinct + 1), 1.0)
            row = np.repeat(np.arange(len(n)), n)
            add = lambda x: np.bincount(row, x, len(n))
            yield pa.RecordBatch.from_arrays([
                b.column("row_id"), b.column("doc_id"), b.column("held_out"), pa.array(n),
                pa.array(add(known).astype(np.int64)), pa.array(add(np.where(known, np.log10((c + 0.5) / floor), 0.0))), pa.array(add(np.log10(p))),
            ], names=["row_id", "doc_id", "held_out", "n_tokens", "n_known", "base", "score"])

    kind = dict(docs.select("doc_id").dtypes)["doc_id"]
    whole = d.mapInArrow(run, f"row_id long, doc_id {kind}, held_out boolean, n_tokens long, n_known long, base double, score double")
    far = cut(far_tokens(d, spread, unigrams, rows=True), drop_shuffles=True)
    uncut(unigrams)

    def added(share: int) -> DataFrame:
        sums = resolved(d, far, spread, pairs, n_stretches, rows=True, share=share)
        return cut(sums.groupBy("row_id").agg(*[F.sum(x).alias(x) for x in ("more", "base_more", "score_more")]), drop_shuffles=True)

    rest = reduce(DataFrame.unionByName, [added(k) for k in range(SHARES)]).groupBy("row_id").agg(*[F.sum(x).alias(x) for x in ("more", "base_more", "score_more")])
    uncut(far)
    uncut(pairs)
    out = whole.join(rest, "row_id", "left")
    plus = lambda a, b: F.col(a) + F.coalesce(b, F.lit(0))
    return out.select("doc_id", "held_out", "n_tokens", plus("n_known", "more").alias("n_known"), F.lit(total).cast("long").alias("train_tokens"), plus("base", "base_more").alias("base_score"), plus("score", "score_more").alias("score"))
