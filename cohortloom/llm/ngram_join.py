"""Jaccard join of word-shingle sets with token-combination prefixes.

A set's tokens are its distinct shingles, 64-bit hashes of five words. All tokens are ordered by class, rare before frequent, then by
hash. With n tokens and at most d = floor(n / 4) of them missing from a partner, two linked sets share their first common token within the
first d + 1 of each, and their first two within the extended prefix of d + 2. If the first common token is rare, the index of
single rare tokens finds the pair; if it is frequent, so are all common tokens, and the index of two-token combinations of frequent
tokens finds it. Sets above `pair_size` tokens would have too many combinations; there the first common token is indexed by itself, and
sets just below index both, so that no pair falls between. Length and position bounds drop pairs that cannot reach the threshold.

Tokens are counted over all sets where their hash lies in the first 3/8 of its range, in which the prefixes of most sets end. Sets with too many
frequent tokens there are open: their prefixes go on into the rest of the range, in which tokens are counted over open sets alone, as no other
set indexes them. Frequent means a count above D; D is, for either range, the least power of two from `rare` on that leaves at most one token for
eight bits of a bitmap of fixed size, which is what goes to the tasks: a token that shares a bit with a frequent one of its range only changes its
place in the order, not the result. Second bitmaps tell tokens that occur once; nothing can share them, so they are not indexed (where bits are
shared, more is indexed than need be).

Equal sets are one node. A first round compares every member of an index entry with the entry's leader only; entries whose members are
then in one component are finished, so a group of thousands of near copies costs its size, not its square. A second round compares what is still
apart within an entry: members outside of its largest component with all members of other components. Linked sets differ in at most a seventh of
their sizes' sum, and each token that only one holds turns the parity of one hash class at most, so pairs of large entries with more unlike
parities never become rows. Pairs whose token counts by 256 hash classes cannot add up to the overlap they need are dropped next; all others are compared exactly on
the hashes of their whole sets.

Defined cases: texts without words and null texts have no tokens and stand alone; fewer than five words are one token; a class is
named by its least doc_id, rows with a null id take the least id of their class; repeated rows are copies; an empty table gives an empty
result; other columns are ignored by `classes` and kept by `one_per_class`, which tells rows apart by id and text and lets the least id of a class stay,
a null id last, and of one id's texts the least by hash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.graph import component_labels
from ..session import bounded_batches, cut, spent
from . import arrays
from .common import having, text_key

WORDS = 5
PLACE = arrays.mixed(np.arange(1001, 1001 + WORDS, dtype=np.uint64)) | np.uint64(1)  # a factor for each place of a word
BITS = 26  # of the bitmaps: 8 MB each
COUNTED = np.uint64(3 << 61)  # tokens below are counted
CLASSES = 256
FINE = 1024  # classes whose parities are kept
PARITIES = [f"odd{k}" for k in range(FINE // 64)]  # 64 in a number
FEW = 16  # entries of more members compare parities


def shingles(column: pa.Array) -> Iterator[np.ndarray]:
    """Sorted distinct token hashes of each text."""
    for _, h, at in arrays.words(column):
        whole = np.zeros(max(len(h) - WORDS + 1, 0), np.uint64)
        for i in range(WORDS):
            whole += h[i:len(h) - WORDS + 1 + i] * PLACE[i]
        whole = arrays.mixed(whole)
        for a, b in zip(at[:-1].tolist(), at[1:].tolist()):
            if b - a >= WORDS:
                yield np.unique(whole[a:b - WORDS + 1])
            else:  # a short text is one token, or none
                yield arrays.mixed((h[a:b] * PLACE[:b - a]).sum(dtype=np.uint64, keepdims=True) + np.uint64(b - a)) if b > a else h[:0]


def node_of(tokens: np.ndarray) -> int | None:
    return int.from_bytes(hashlib.blake2b(tokens.tobytes(), digest_size=8).digest(), "little", signed=True) if len(tokens) else None


def _sets(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray]]:
    """Distinct sets of a batch: copies within it count once from here on."""
    seen = set()
    for tokens in shingles(batch.column("text")):
        node = node_of(tokens)
        if node is not None and node not in seen:
            seen.add(node)
            yield node, tokens


def nodes(docs: DataFrame) -> DataFrame:
    """doc_id, text_key, node (null without words), n, classes (tokens per hash class as 16-bit numbers; null where one would not fit), PARITIES."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for k in range(0, whole.num_rows, 1000):
                b = whole.slice(k, 1000)
                node, n, classes, odd = [], [], [], []
                for x in shingles(b.column("text")):
                    node.append(node_of(x))
                    n.append(len(x))
                    fine = np.bincount((x & np.uint64(FINE - 1)).astype(np.int64), minlength=FINE)
                    c = fine.reshape(-1, CLASSES).sum(axis=0)
                    classes.append(c.astype(np.uint16).tobytes() if c.max() < 1 << 16 else None)
                    odd.append(np.packbits((fine & 1).astype(np.uint8)).view(np.int64))
                columns = [b.column("doc_id"), b.column("text_key"), pa.array(node, pa.int64()), pa.array(n, pa.int64()), pa.array(classes, pa.binary()), *map(pa.array, np.array(odd).T.copy())]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "text_key", "node", "n", "classes", *PARITIES])

    rows = docs.select("doc_id", text_key().alias("text_key"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, f"doc_id {dict(docs.dtypes)['doc_id']}, text_key long, node long, n long, classes binary, {', '.join(f'{p} long' for p in PARITIES)}")


def bitmap(df: DataFrame, column: str) -> np.ndarray:
    """Bits set at the values' low bits, packed in pieces of 64 KB by the executors."""
    piece = 19

    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        bits = np.zeros(1 << piece, np.uint8)
        bits[pdf["bit"].to_numpy() & ((1 << piece) - 1)] = 1
        return pd.DataFrame({"piece": pdf["piece"].iloc[:1], "packed": [np.packbits(bits).tobytes()]})

    bit = F.col(column).bitwiseAND(F.lit((1 << BITS) - 1))
    places = df.select(bit.alias("bit")).distinct().select("bit", F.shiftright("bit", piece).alias("piece"))
    out = np.zeros(1 << BITS >> 3, np.uint8)
    size = (1 << piece) >> 3
    for row in places.groupBy("piece").applyInPandas(pack, "piece long, packed binary").toLocalIterator():
        out[row.piece * size:(row.piece + 1) * size] = np.frombuffer(row.packed, np.uint8)
    return out


def _set_bits(bits: np.ndarray, h: np.ndarray) -> np.ndarray:
    at = h & np.uint64((1 << BITS) - 1)
    return (bits[at >> np.uint64(3)] >> (np.uint8(7) - (at & np.uint64(7)).astype(np.uint8))) & np.uint8(1) > 0


def _repeated(found: DataFrame) -> DataFrame:
    return cut(found.groupBy("token").agg(F.sum("n").alias("n")).where("n > 1"))


def _counted(parts: list[np.ndarray]) -> pa.RecordBatch:
    token, n = np.unique(np.concatenate(parts) if parts else np.empty(0, np.uint64), return_counts=True)
    return pa.RecordBatch.from_arrays([pa.array(token.view(np.int64)), pa.array(n, pa.int32())], names=["token", "n"])


def repeated_tokens(docs: DataFrame) -> DataFrame:
    """Tokens of the counted range that more than one set holds (or one set in copies that met in no batch): token, n."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield _counted([x[: np.searchsorted(x, COUNTED)] for _, x in _sets(b)])

    return _repeated(docs.select(F.col("text").cast("string").alias("text")).mapInArrow(run, "token long, n int"))


def repeated_in_open(open_sets: DataFrame) -> DataFrame:
    """Tokens beyond the counted range that more than one open set holds: token, n."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sets = [np.frombuffer(x.as_buffer(), np.uint64) for x in b.column("tokens")]
            yield _counted([x[np.searchsorted(x, COUNTED):] for x in sets])

    return _repeated(open_sets.select("tokens").mapInArrow(run, "token long, n int"))


def frequent_tokens(counts: DataFrame, rare: int) -> DataFrame:
    counts = counts.where(F.col("n") > rare)
    levels = counts.groupBy(F.floor(F.log2("n")).alias("level")).agg(F.count(F.lit(1)).alias("c")).orderBy(F.desc("level")).collect()  # 63 rows at most
    above, d = 0, None
    for row in levels:
        above += row.c
        if above > 1 << BITS >> 3:
            d = 1 << (row.level + 1)
            break
    return counts if d is None else counts.where(F.col("n") >= d)


class Order:
    """Class of every token, frequent or not, and whether sets share it; bitmaps for the counted range and for the rest."""

    def __init__(self, frequent: np.ndarray, repeated: np.ndarray, frequent_beyond: np.ndarray | None = None, repeated_beyond: np.ndarray | None = None):
        self.frequent, self.repeated = (frequent, frequent_beyond), (repeated, repeated_beyond)

    @staticmethod
    def _look(maps: tuple[np.ndarray, np.ndarray | None], tokens: np.ndarray) -> np.ndarray:
        """Of sorted tokens; what is beyond the counted range and not known yet has no bit."""
        k = np.searchsorted(tokens, COUNTED)
        beyond = np.zeros(len(tokens) - k, bool) if maps[1] is None else _set_bits(maps[1], tokens[k:])
        return np.concatenate([_set_bits(maps[0], tokens[:k]), beyond])

    def often(self, tokens: np.ndarray) -> np.ndarray:
        return self._look(self.frequent, tokens)

    def shared(self, tokens: np.ndarray) -> np.ndarray:
        return self._look(self.repeated, tokens)


def _is_open(tokens: np.ndarray, often: np.ndarray) -> bool:
    k = int(np.searchsorted(tokens, COUNTED))
    return k - int(often[:k].sum()) < len(tokens) // 4 + 2


def _entries(tokens: np.ndarray, order: Order, often: np.ndarray, pair_size: int) -> tuple[np.ndarray, np.ndarray, int]:
    n = len(tokens)
    d = n // 4
    shared = order.shared(tokens)
    lone = int((~shared[: np.searchsorted(tokens, COUNTED)]).sum())
    at = np.concatenate([np.flatnonzero(~often), np.flatnonzero(often)])[: d + 2]
    prefix = tokens[at]
    n_rare = min(n - int(often.sum()), d + 1)
    keep = np.flatnonzero(shared[at[:n_rare]])
    sig, pos = [prefix[keep] & ~np.uint64(1)], [keep + 1]
    first = np.arange(n_rare, min(d + 1, n))  # places of frequent tokens in the prefix
    if len(first) and 4 * n >= 3 * pair_size:
        sig.append(arrays.mixed(prefix[first] + np.uint64(1)) | np.uint64(1))
        pos.append(first + 1)
    if len(first) and n <= pair_size:
        i, j = np.triu_indices(len(prefix) - n_rare, 1)
        i, j = i + n_rare, j + n_rare
        sig.append(arrays.mixed(arrays.mixed(prefix[i] + np.uint64(2)) + prefix[j]) | np.uint64(1))
        pos.append(i + 1)
    return np.concatenate(sig), np.concatenate(pos), lone


ENTRY = "sig long, node long, n int, pos int, lone int"


def _entry_columns(rows: list[tuple[int, int, np.ndarray, np.ndarray, int]]) -> list[pa.Array]:
    """Columns of ENTRY for rows of node, n, signatures, places, lone."""
    many = [len(r[2]) for r in rows]
    each = lambda k, kind: np.repeat(np.array([r[k] for r in rows], kind), many)
    all_of = lambda k, kind: np.concatenate([np.empty(0, kind), *[r[k].astype(kind) for r in rows]])
    return [pa.array(all_of(2, np.uint64).view(np.int64)), pa.array(each(0, np.int64)), pa.array(each(1, np.int32)), pa.array(all_of(3, np.int32)), pa.array(each(4, np.int32))]


def index(docs: DataFrame, order: Order, pair_size: int) -> DataFrame:
    """Index entries of all sets but open ones: sig, node, n, pos, lone (counted tokens that no other set holds); of open sets node and tokens.

    Entries of single rare tokens have even signatures, those of frequent tokens odd ones."""
    spread = docs.sparkSession.sparkContext.broadcast(order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for k in range(0, whole.num_rows, 500):
                done, left = [], []
                for node, x in _sets(whole.slice(k, 500)):
                    often = spread.value.often(x)
                    if _is_open(x, often):
                        left.append((node, x.tobytes()))
                    else:
                        done.append((node, len(x), *_entries(x, spread.value, often, pair_size)))
                cols = _entry_columns(done)
                yield pa.RecordBatch.from_arrays([*cols, pa.nulls(len(cols[0]), pa.binary())], names=["sig", "node", "n", "pos", "lone", "tokens"])
                none = [pa.nulls(len(left), t) for t in (pa.int64(), pa.int32(), pa.int32(), pa.int32())]
                yield pa.RecordBatch.from_arrays([none[0], pa.array([r[0] for r in left], pa.int64()), *none[1:], pa.array([r[1] for r in left], pa.binary())], names=["sig", "node", "n", "pos", "lone", "tokens"])

    return docs.select(F.col("text").cast("string").alias("text")).mapInArrow(run, f"{ENTRY}, tokens binary")


def index_open(open_sets: DataFrame, order: Order, pair_size: int) -> DataFrame:
    """Index entries of the open sets, with tokens of the whole range in their classes."""
    spread = open_sets.sparkSession.sparkContext.broadcast(order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for k in range(0, whole.num_rows, 500):
                b = whole.slice(k, 500)
                rows = []
                for node, x in zip(b.column("node").to_pylist(), b.column("tokens")):
                    x = np.frombuffer(x.as_buffer(), np.uint64)
                    rows.append((node, len(x), *_entries(x, spread.value, spread.value.often(x), pair_size)))
                yield pa.RecordBatch.from_arrays(_entry_columns(rows), names=["sig", "node", "n", "pos", "lone"])

    return open_sets.select("node", "tokens").mapInArrow(run, ENTRY)


def shared_entries(rows: DataFrame) -> DataFrame:
    """The entries of two nodes or more. Counted with map-side combine, then joined, so that a hot signature is split by the skew join."""
    least = rows.groupBy("sig").agg(F.min("node").alias("lo"), F.max("node").alias("hi")).where("lo <> hi").select("sig")
    return rows.join(least, "sig").select("sig", "node", "n", "pos", "lone")


def _possible(a: str, b: str):
    """Length and position bounds of a pair at 3/4: overlap >= 3/7 of both sizes together."""
    n, m = F.col(f"{a}.n"), F.col(f"{b}.n")
    left = F.least(n - F.col(f"{a}.pos"), m - F.col(f"{b}.pos")) + 1
    return (4 * n >= 3 * m) & (4 * m >= 3 * n) & (7 * left >= 3 * (n + m))


def _alike(a: str, b: str):
    """Few enough unlike parities: at most a seventh of both sizes together; true where they are not at hand."""
    unlike = sum(F.bit_count(F.col(f"{a}.{p}").bitwiseXOR(F.col(f"{b}.{p}"))) for p in PARITIES)
    return F.coalesce(7 * unlike <= F.col(f"{a}.n") + F.col(f"{b}.n"), F.lit(True))


def _pairs(found: DataFrame) -> DataFrame:
    return found.select(F.least("x.node", "y.node").alias("u"), F.greatest("x.node", "y.node").alias("v")).distinct()


def star_pairs(members: DataFrame) -> DataFrame:
    """Every member with the leader of its entry: the set with the fewest tokens of its own, which edited copies of one text have in common."""
    leaders = members.groupBy("sig").agg(F.min(F.struct("lone", "n", "node", "pos")).alias("l")).select("sig", "l.*")
    found = members.alias("x").join(leaders.alias("y"), F.expr("x.sig = y.sig AND x.node <> y.node") & _possible("x", "y"))
    return _pairs(found)


def remaining_pairs(members: DataFrame, labels: DataFrame, sketches: DataFrame) -> DataFrame:
    """Pairs within an entry that are in different components: those outside of its largest component against all others."""
    placed = members.join(labels.select(F.col("iid").alias("node"), "component"), "node", "left").withColumn("component", F.coalesce("component", "node"))
    placed = cut(placed.select("sig", "node", "n", "pos", "component"))
    parts = placed.groupBy("sig", "component").agg(F.count(F.lit(1)).alias("c"))
    main = parts.groupBy("sig").agg(F.max(F.struct("c", "component")).alias("m"), F.count(F.lit(1)).alias("parts"), F.sum("c").alias("size")).where("parts > 1").select("sig", "size", F.col("m.component").alias("main"))
    apart = cut(placed.join(main, "sig"))
    few = apart.where(F.col("size") <= FEW).select("*", *[F.lit(None).cast("long").alias(p) for p in PARITIES])
    apart = few.unionByName(apart.where(F.col("size") > FEW).join(sketches.select("node", *PARITIES), "node"))
    return _pairs(apart.where("component <> main").alias("x").join(apart.alias("y"), F.expr("x.sig = y.sig AND x.component <> y.component") & _possible("x", "y") & _alike("x", "y")))


def able(pairs: DataFrame, sketches: DataFrame) -> DataFrame:
    """The pairs whose overlap can reach 3/4: the lesser counts of their classes, summed, bound it from above."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keep = []
            for x, y, n, m in zip(b.column("x"), b.column("y"), b.column("n_x").to_pylist(), b.column("n_y").to_pylist()):
                if x.is_valid and y.is_valid:
                    most = int(np.minimum(np.frombuffer(x.as_buffer(), np.uint16), np.frombuffer(y.as_buffer(), np.uint16)).sum())
                    keep.append(7 * most >= 3 * (n + m))
                else:
                    keep.append(True)
            yield b.select(["u", "v"]).filter(pa.array(keep, pa.bool_()))

    x = sketches.select(F.col("node").alias("u"), F.col("classes").alias("x"), F.col("n").alias("n_x"))
    y = sketches.select(F.col("node").alias("v"), F.col("classes").alias("y"), F.col("n").alias("n_y"))
    return pairs.join(x, "u").join(y, "v").select("u", "v", "x", "y", "n_x", "n_y").mapInArrow(run, "u long, v long")


def verified(docs: DataFrame, pairs: DataFrame) -> DataFrame:
    """u, v, overlap, n_u, n_v of the pairs, from their whole sets; only sets that occur in a pair are gathered."""
    wanted = docs.sparkSession.sparkContext.broadcast(bitmap(pairs.select("u").unionByName(pairs.select(F.col("v").alias("u"))), "u"))

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = wanted.value
        for b in batches:
            got = [(k, x.tobytes()) for k, x in _sets(b) if _set_bits(bits, np.array([k], np.int64).view(np.uint64))[0]]
            for i in range(0, len(got), 500):
                yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in got[i:i + 500]], pa.int64()), pa.array([x for _, x in got[i:i + 500]], pa.binary())], names=["node", "tokens"])

    def overlap(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            both = []
            for x, y in zip(b.column("x"), b.column("y")):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                both.append((len(np.intersect1d(x, y, assume_unique=True)), len(x), len(y)))
            cols = list(zip(*both)) or [(), (), ()]
            yield pa.RecordBatch.from_arrays([b.column("u"), b.column("v"), *[pa.array(c, pa.int64()) for c in cols]], names=["u", "v", "overlap", "n_u", "n_v"])

    sets = docs.select(F.col("text").cast("string").alias("text")).mapInArrow(gather, "node long, tokens binary")
    # copies in different batches are gathered once each; one of them goes on
    sets = cut(sets.join(pairs.select(F.col("u").alias("node")).unionByName(pairs.select(F.col("v").alias("node"))).distinct(), "node", "left_semi").groupBy("node").agg(F.first("tokens").alias("tokens")))
    x = sets.select(F.col("node").alias("u"), F.col("tokens").alias("x"))
    y = sets.select(F.col("node").alias("v"), F.col("tokens").alias("y"))
    return pairs.join(x, "u").join(y, "v").select("u", "v", "x", "y").mapInArrow(overlap, "u long, v long, overlap long, n_u long, n_v long")


def indexed(docs: DataFrame, rare: int, pair_size: int) -> DataFrame:
    """The shared entries of all sets. Sets are made once for the counts and once for the index; open ones go on from a table."""
    counts = repeated_tokens(docs)
    maps = bitmap(frequent_tokens(counts, rare), "token"), bitmap(counts, "token")
    made = cut(index(docs, Order(*maps), pair_size))
    open_sets = made.where("tokens is not null")
    beyond = repeated_in_open(open_sets)
    order = Order(*maps, bitmap(frequent_tokens(beyond, rare), "token"), bitmap(beyond, "token"))
    rest = cut(index_open(open_sets, order, pair_size))
    return cut(shared_entries(made.where("tokens is null").select(rest.columns).unionByName(rest)))


def links(docs: DataFrame, all_nodes: DataFrame, rare: int = 16, pair_size: int = 64) -> tuple[DataFrame, DataFrame]:
    """Node pairs of similarity 3/4 or more, enough of them to connect every class, and the label of every linked node."""
    with spent(keep=(keep := [])):
        members = indexed(docs, rare, pair_size)
        keep.append(members)
    # one sketch per node that an entry holds; copies have equal ones
    sketches = cut(all_nodes.join(members.select("node").distinct(), "node", "left_semi").groupBy("node").agg(F.first("n").alias("n"), F.first("classes").alias("classes"), *[F.first(p).alias(p) for p in PARITIES]))
    linked = F.expr("100 * overlap >= 75 * (n_u + n_v - overlap)")
    star = cut(star_pairs(members))
    edges = cut(verified(docs, cut(able(star, sketches))).where(linked).select("u", "v"))
    labels = cut(component_labels(edges, "u", "v"))
    second = cut(able(remaining_pairs(members, labels, sketches).join(star, ["u", "v"], "left_anti"), sketches))
    if not second.isEmpty():
        edges = cut(edges.unionByName(verified(docs, second).where(linked).select("u", "v")))
        labels = cut(component_labels(edges, "u", "v"))
    return edges, labels


def placed_rows(docs: DataFrame, **options) -> tuple[DataFrame, DataFrame]:
    """Rows with words (doc_id, text_key, n, component) and rows without (doc_id, text_key)."""
    bounded_batches(docs.sparkSession)
    all_nodes = cut(nodes(docs))
    _, labels = links(docs, all_nodes, **options)
    named = labels.select(F.col("iid").alias("node"), "component")
    placed = all_nodes.where("node is not null").join(named, "node", "left").select("doc_id", "text_key", "n", F.coalesce("component", "node").alias("component"))
    return placed, all_nodes.where("node is null").select("doc_id", "text_key")


def classes(docs: DataFrame, **options) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id."""
    placed, alone = placed_rows(docs, **options)
    least = placed.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    out = placed.join(least, "component").select("doc_id", F.col("n").alias("n_shingles"), "component_id")
    return out.unionByName(alone.select("doc_id", F.lit(0).cast("long").alias("n_shingles"), F.col("doc_id").alias("component_id")))


def one_per_class(docs: DataFrame, **options) -> DataFrame:
    """The first document of each class by id (null last) and text key, all columns kept; of rows equal in id and text one stays.

    Rows without words stand alone: those with an id stay once per id and text, those without an id all stay.
    """
    with spent(keep=(keep := [])):
        placed, alone = placed_rows(docs, **options)
        placed = cut(placed)
        first = placed.groupBy("component").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key")).alias("f"))
        judged = cut(placed.join(first, "component").select("doc_id", "text_key", (F.col("doc_id").eqNullSafe(F.col("f.doc_id")) & (F.col("text_key") == F.col("f.text_key"))).alias("stays")))
        gone = cut(judged.where("not stays").select("doc_id", "text_key").distinct())
        rows = judged.where("stays").select("doc_id", "text_key").unionByName(alone.where("doc_id is not null"))
        twice = cut(rows.groupBy("doc_id", "text_key").count().where("count > 1").select("doc_id", "text_key"))
        keep += [gone, twice]
    kept = having(docs, gone, "left_anti")
    if twice.isEmpty():
        return kept
    return having(kept, twice, "left_anti").unionByName(having(kept, twice, "left_semi").dropDuplicates(["doc_id", "text"]))
