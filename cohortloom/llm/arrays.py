"""Hashes of bytes and words by whole arrays, for use inside tasks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_BASE = 0x9E3779B97F4A7C15


def mixed(h: np.ndarray) -> np.ndarray:
    """A one-to-one scrambling of 64-bit numbers."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


#: A number for every byte; the second table gives A-Z those of a-z.
BYTE = mixed(np.arange(1, 257, dtype=np.uint64))
LOWER_BYTE = BYTE.copy()
LOWER_BYTE[65:91] = BYTE[97:123]
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True


class _Powers:
    """Powers of the base and of its inverse, as far as the longest stretch so far needs."""

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            run = lambda b: np.multiply.accumulate(np.concatenate([np.ones(1, np.uint64), np.full(n + n // 4, b, np.uint64)]))
            self.up, self.down = run(_BASE), run(pow(_BASE, -1, 1 << 64))
        return self.up, self.down


_powers = _Powers()


def sums(raw: np.ndarray, table: np.ndarray = BYTE) -> np.ndarray:
    """Prefix sums from which the hash of any stretch of the bytes is read."""
    up, _ = _powers.upto(len(raw) + 1)
    out = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(table[raw] * up[: len(raw)], out=out[1:])
    return out


def stretch(s: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of the bytes from start to end, wherever they stand."""
    _, down = _powers.upto(len(s))
    return mixed((s[end] - s[start]) * down[start])


def texts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All UTF-8 bytes of a string column, and where each text begins and the last one ends; null texts are empty."""
    column = column.cast(pa.large_string()).fill_null("")
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw, at


def words(column: pa.Array, piece: int = 1 << 20) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Lower-cased words as hashes, some texts at a time: first text, hashes of their words, and the place of each text's first word.

    Words are what ASCII white space separates; only A-Z are lower-cased. Pieces end with a text, so a long text makes a long piece.
    """
    raw, at = texts(column)
    first, n = 0, len(at) - 1
    while first < n:
        last = max(first + 1, int(np.searchsorted(at, at[first] + piece, side="right")) - 1)
        part = raw[at[first]:at[last]]
        edge = at[first:last + 1] - at[first]
        if len(part):
            space = SPACE[part]
            cut = np.zeros(len(part) + 1, bool)
            cut[edge] = True
            starts = np.flatnonzero(~space & (cut[:-1] | np.concatenate([[True], space[:-1]])))
            ends = np.flatnonzero(~space & (cut[1:] | np.concatenate([space[1:], [True]]))) + 1
            s = sums(part, LOWER_BYTE)
            yield first, stretch(s, starts, ends), np.searchsorted(starts, edge)
        else:
            yield first, np.zeros(0, np.uint64), np.zeros(last - first + 1, np.int64)
        first = last
