"""Hashes of words and of runs of words, vectorised inside tasks."""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import pyarrow as pa
import xxhash

_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
_INVERSE = pow(_BASE, -1, 2**64)
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]

#: A hash counts as frequent if it stands in so large a share of the rows surveyed together, and in three at least.
FREQUENT_SHARE = 1 / 400
#: At most so many frequent hashes are sent to the tasks; the others are treated as any hash.
FREQUENT_MOST = 1 << 18


def words(text: str | None, lower: bool = False) -> list[bytes]:
    """UTF-8 words between blanks; `lower` changes A-Z only."""
    b = (text or "").encode("utf-8", "surrogatepass")
    return (b.lower() if lower else b).split()


def word_hashes(ws: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, ws), np.uint64, len(ws))


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        size = 1 << (n - 1).bit_length()
        for i, base in enumerate((_BASE, _INVERSE)):
            p = np.full(size, base, np.uint64)
            p[0] = 1
            _powers[i] = np.multiply.accumulate(p)
    return _powers[0][:n], _powers[1][:n]


def runs(h: np.ndarray, k: int) -> np.ndarray:
    """64-bit hashes of the runs of `k` words, from prefix sums of h[i] * base ** i."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    up, down = _power(len(h))
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(h * up, dtype=np.uint64)])
    x = (total[k:] - total[:n]) * down[:n]
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(text: str | None, k: int = 5) -> np.ndarray:
    """Sorted distinct hashes of the k-word shingles of the lower-cased text; with fewer words, of all of
    them as one; without words, empty."""
    h = word_hashes(words(text, lower=True))
    if not len(h):
        return h
    return np.unique(runs(h, min(k, len(h))))


#: Rows that are surveyed together for frequent hashes.
SURVEY_ROWS = 4096


class Survey:
    """Hashes that many of some thousand rows hold, with their counts; `add` and `rest` return them as
    they are found."""

    def __init__(self):
        self.parts: list[np.ndarray] = []
        self.rows = 0

    def add(self, parts: Iterable[np.ndarray], rows: int) -> tuple[np.ndarray, np.ndarray]:
        self.parts += [p for p in parts if len(p)]
        self.rows += rows
        return self.rest() if self.rows >= SURVEY_ROWS else (np.zeros(0, np.uint64), np.zeros(0, np.int64))

    def rest(self) -> tuple[np.ndarray, np.ndarray]:
        parts, rows, self.parts, self.rows = self.parts, self.rows, [], 0
        if not parts:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        h, n = np.unique(np.concatenate(parts), return_counts=True)
        often = n >= max(3, rows * FREQUENT_SHARE)
        return h[often], n[often]


def is_in(x: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Membership of each of `x` in the sorted `table`."""
    if not len(table):
        return np.zeros(len(x), bool)
    at = np.minimum(np.searchsorted(table, x), len(table) - 1)
    return table[at] == x


def longs(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64) if x.dtype == np.uint64 else x.astype(np.int64), pa.int64())


def column(batches: list[pa.RecordBatch], i: int) -> np.ndarray:
    return np.concatenate([b.column(i).to_numpy(zero_copy_only=False) for b in batches])


def batch_of(schema: pa.Schema, *columns: np.ndarray | list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)
