"""Token ids as length-delimited binary records with masked checksums and a separate offset index.

Documents are range partitioned and sorted by id, then every task encodes its part and writes two files: `part-N.rec`, one record per document,
and `part-N.idx`, one (offset, length) pair per record, from which readers fetch any record in any order. A record is framed as

    length u64 | masked crc32 of the length u32 | payload | masked crc32 of the payload u32       (little endian)

and its payload is the id's presence byte, the id (i64), the width of a token (2 or 4 bytes) and the tokens, the end id last. Files are written
under an attempt's own name and renamed when complete: a lost task leaves nothing that is read, a repeated one writes the same bytes.

Texts are cut where ASCII white space follows other characters, which a byte-level pre-tokenizer never joins, and each distinct piece (told
apart by a 64-bit hash of its bytes and length) goes through the tokenizer once per worker; ids are put together by whole arrays; texts with one of the tokenizer's added tokens, and tokenizers of other kinds, take the plain way.

Defined cases: a null text is empty and yields the end id alone; null ids sort first; rows with the same id are ordered by a hash of the
text, so that a frequent id is spread over parts; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import json
import os
import struct
import uuid
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut, scratch_path
from . import arrays
from .common import text_key

#: UTF-8 of white space beyond ASCII, and the mask of the framing's checksums.
_WIDE = [int.from_bytes(chr(c).encode()) for c in (0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)]
MASK_DELTA = 0xA282EAD8
HEAD = "<BqB"
CACHE = 1_000_000  # pieces a worker remembers before it starts anew


def starts(raw: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Where the pieces of the texts begin: at each text that is not empty, and at ASCII white space after anything but white space."""
    space = arrays.SPACE[raw]
    begin = space & ~np.append(False, space[:-1])
    p = np.flatnonzero(begin[1:]) + 1
    wide = p[raw[p - 1] >= 0x80]
    last = [raw[np.maximum(wide - k, 0)].astype(np.int64) for k in (1, 2, 3)]
    white = np.isin(last[1] << 8 | last[0], _WIDE) | np.isin(last[2] << 16 | last[1] << 8 | last[0], _WIDE)
    begin[wide[white]] = False
    begin[0:1] = False
    begin[at[:-1][at[:-1] < at[1:]]] = True
    return np.flatnonzero(begin)


def masked(data: bytes) -> int:
    c = zlib.crc32(data)
    return ((c >> 15 | c << 17) + MASK_DELTA) & 0xFFFFFFFF


def frame(payload: bytes) -> bytes:
    size = struct.pack("<Q", len(payload))
    return b"".join((size, struct.pack("<I", masked(size)), payload, struct.pack("<I", masked(payload))))


def unframe(stream) -> bytes | None:
    """The next payload, None at the end; damaged records raise."""
    head = stream.read(12)
    if not head:
        return None
    if len(head) < 12 or masked(head[:8]) != struct.unpack("<I", head[8:])[0]:
        raise ValueError("damaged record length")
    n = struct.unpack("<Q", head[:8])[0]
    payload, check = stream.read(n), stream.read(4)
    if len(payload) < n or len(check) < 4 or masked(payload) != struct.unpack("<I", check)[0]:
        raise ValueError("damaged record")
    return payload


class Encoder:
    """Texts to ids."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # tasks fill the cores already
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        spec = json.loads(self.tokenizer.to_str())
        pre = spec.get("pre_tokenizer") or {}
        self.by_piece = pre.get("type") == "ByteLevel" and not pre.get("add_prefix_space") and pre.get("use_regex", True) and not spec.get("normalizer")
        self.added = [x["content"] for x in spec.get("added_tokens", [])]
        self._forget()

    def _forget(self) -> None:
        self.known, self.at, self.size, self.pool = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, "<u4")

    def _ids(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, keys: np.ndarray, pieces: list[str]) -> None:
        """Adds pieces by their sorted keys."""
        ids = self._ids(pieces)
        size = np.array([len(x) for x in ids], np.int64)
        place = np.searchsorted(self.known, keys)
        self.at = np.insert(self.at, place, len(self.pool) + np.cumsum(size) - size)
        self.size = np.insert(self.size, place, size)
        self.known = np.insert(self.known, place, keys)
        self.pool = np.concatenate([self.pool, np.fromiter(chain.from_iterable(ids), "<u4", int(size.sum()))])

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian 32-bit ids of each text."""
        return [x.tobytes() for x in self.encode_column(pa.array(texts, pa.string()))]

    def encode_column(self, column: pa.Array) -> list[np.ndarray]:
        """Ids of each text; null texts are empty."""
        if not self.by_piece:
            return [np.array(x, "<u4") for x in self._ids([t or "" for t in column.to_pylist()])]
        raw, at = arrays.texts(column)
        raw, at = raw[at[0]:at[-1]], at - at[0]
        start = starts(raw, at)
        end = np.append(start[1:], len(raw))
        key, first, of = np.unique(arrays.mixed(arrays.stretch(arrays.sums(raw), start, end) + (end - start).astype(np.uint64)), return_index=True, return_inverse=True)
        if len(self.known) > CACHE:
            self._forget()
        place = np.searchsorted(self.known, key)
        there = place < len(self.known)
        there[there] = self.known[place[there]] == key[there]
        new = np.flatnonzero(~there)
        if len(new):
            self._learn(key[new], [raw[a:b].tobytes().decode() for a, b in zip(start[first[new]].tolist(), end[first[new]].tolist())])
        place = np.searchsorted(self.known, key)[of]
        size = self.size[place]
        total = np.append(0, np.cumsum(size))
        ids = self.pool[np.repeat(self.at[place] - total[:-1], size) + np.arange(total[-1])]
        edge = total[np.searchsorted(start, at)]
        out = [ids[a:b] for a, b in zip(edge[:-1].tolist(), edge[1:].tolist())]
        for a in self.added:
            for k in np.flatnonzero(pc.match_substring(column, a).fill_null(False).to_numpy(zero_copy_only=False)).tolist():
                out[k] = np.array(self._ids([column[k].as_py()])[0], "<u4")
        return out


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def pack(doc_id: int | None, ids: bytes) -> bytes:
    a = np.frombuffer(ids, "<u4")
    width = 2 if a.max() < 1 << 16 else 4
    return struct.pack(HEAD, doc_id is not None, doc_id or 0, width) + (a.astype("<u2").tobytes() if width == 2 else ids)


def unpack(payload: bytes) -> tuple[int | None, np.ndarray]:
    there, doc_id, width = struct.unpack_from(HEAD, payload)
    return doc_id if there else None, np.frombuffer(payload, f"<u{width}", offset=struct.calcsize(HEAD)).astype("<u4")


def write(docs: DataFrame, folder: str, tokenizer: str, end_id: int = 2, parts: int | None = None) -> DataFrame:
    """Writes the files and returns their list: part, n_records, n_tokens."""
    parts = parts or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), text_key().alias("k"))
    ordered = ordered.repartitionByRange(parts, F.col("doc_id").asc_nulls_first(), "k").sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "k")
    end = struct.pack("<I", end_id)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = fs.FileSystem.from_uri(folder)
        store.create_dir(base, recursive=True)
        part = TaskContext.get().partitionId()
        name, own = f"{base}/part-{part:06d}", f"{base}/_{uuid.uuid4().hex}"
        offset = records = tokens = 0
        with store.open_output_stream(f"{own}.rec") as rec, store.open_output_stream(f"{own}.idx") as idx:
            for b in batches:
                for k in range(0, b.num_rows, 500):
                    piece = b.slice(k, 500)
                    for doc_id, ids in zip(piece.column("doc_id").to_pylist(), encoder(tokenizer).encode_column(piece.column("text"))):
                        data = frame(pack(doc_id, ids.tobytes() + end))
                        rec.write(data)
                        idx.write(struct.pack("<QQ", offset, len(data)))
                        offset, records, tokens = offset + len(data), records + 1, tokens + len(ids) + 1
        for kind in ("rec", "idx"):
            store.move(f"{own}.{kind}", f"{name}.{kind}")
        yield pa.RecordBatch.from_pydict({"part": [part], "n_records": [records], "n_tokens": [tokens]}, pa.schema([("part", pa.int32()), ("n_records", pa.int64()), ("n_tokens", pa.int64())]))

    return cut(ordered.drop("k").mapInArrow(run, "part int, n_records long, n_tokens long"))


def read(listing: DataFrame, folder: str) -> DataFrame:
    """Every record of the listed files in their order: part, row, doc_id, before (tokens of the part's earlier records), n_tokens, ids_crc32."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = fs.FileSystem.from_uri(folder)
        for b in batches:
            for part in b.column("part").to_pylist():
                with store.open_input_stream(f"{base}/part-{part:06d}.rec", buffer_size=1 << 20) as stream:
                    rows, before, n = [], 0, 0
                    while (payload := unframe(stream)) is not None:
                        doc_id, ids = unpack(payload)
                        rows.append((part, n, doc_id, before, len(ids), zlib.crc32(ids.tobytes())))
                        before, n = before + len(ids), n + 1
                        if len(rows) == 10_000:
                            yield _batch(rows)
                            rows = []
                    if rows:
                        yield _batch(rows)

    spread = listing.select("part").repartition(max(1, listing.count()), "part")
    return spread.mapInArrow(run, "part int, row long, doc_id long, before long, n_tokens long, ids_crc32 long")


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int32()] + [pa.int64()] * 5
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=["part", "row", "doc_id", "before", "n_tokens", "ids_crc32"])


def fetch(wanted: DataFrame, folder: str) -> DataFrame:
    """Records at (part, row) in any order by way of the offset index: part, row, doc_id, ids."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = fs.FileSystem.from_uri(folder)
        for b in batches:
            out = []
            for part, row in zip(b.column("part").to_pylist(), b.column("row").to_pylist()):
                with store.open_input_file(f"{base}/part-{part:06d}.idx") as idx:
                    offset, size = struct.unpack("<QQ", idx.read_at(16, 16 * row))
                with store.open_input_file(f"{base}/part-{part:06d}.rec") as rec:
                    doc_id, ids = unpack(unframe(pa.BufferReader(rec.read_at(size, offset))))
                out.append((part, row, doc_id, ids.astype(np.int64).tolist()))
            kinds = [pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int64())]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out) if out else [()] * 4, kinds)], names=["part", "row", "doc_id", "ids"])

    return wanted.select("part", "row").mapInArrow(run, "part int, row long, doc_id long, ids array<long>")


def positions(listing: DataFrame, records: DataFrame) -> DataFrame:
    """Adds start: the tokens of all records before, over all files. One row per file is summed up."""
    base = listing.select("part", (F.sum("n_tokens").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("n_tokens")).alias("base"))
    return records.join(F.broadcast(base), "part").withColumn("start", F.col("base") + F.col("before")).drop("base")


def round_trip(docs: DataFrame, tokenizer: str, end_id: int = 2, folder: str | None = None) -> DataFrame:
    folder = folder or scratch_path(docs.sparkSession, "records")
    listing = write(docs, folder, tokenizer, end_id)
    return positions(listing, read(listing, folder))
