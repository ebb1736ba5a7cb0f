"""Vectorised work on whole texts inside Arrow tasks.

Texts arrive as Arrow string columns; words are found and hashed with numpy
directly on the UTF-8 bytes, so no Python object is made per word. A word is a
run of characters other than space and tab..carriage return (0x20, 0x09-0x0D).
Long inputs are walked in slices of whole documents, so memory follows the
slice (or one single document), not the batch.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from ..functions.reuse import materialize
from ..session import ensure_checkpoint_dir

#: Bytes of text handled at once (a longer document is a slice of its own).
SLICE_BYTES = 2 << 20
_P = 0x9E3779B97F4A7C15 | 1
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def written(df: DataFrame) -> DataFrame:
    """A table written (as Parquet, so compressed) to the shared checkpoint folder and reread."""
    path = f"{ensure_checkpoint_dir(df.sparkSession).rstrip('/')}/table-{uuid.uuid4()}"
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def lookup_table(df: DataFrame) -> DataFrame:
    """A written table to join large tables with. It forgets how its rows were
    dealt, so that a join deals both sides and adaptive execution can
    broadcast it if it is small, or split the other side at a hot key."""
    return materialize(df.hint("rebalance"))


def mix(x: np.ndarray) -> np.ndarray:
    """SplitMix64 finaliser (bijective 64-bit mixing)."""
    x = np.asarray(x, dtype=np.uint64)
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def uniform(x: np.ndarray) -> np.ndarray:
    """Hashes to doubles in [0, 1)."""
    return (x >> np.uint64(11)).astype(np.float64) * 2.0 ** -53


def _powers(n: int, base: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64, by doubling."""
    out = np.ones(max(n, 1), dtype=np.uint64)
    k, step = 1, base & 0xFFFFFFFFFFFFFFFF
    while k < n:
        m = min(k, n - k)
        out[k:k + m] = out[:m] * np.uint64(step)
        k, step = k + m, (step * step) & 0xFFFFFFFFFFFFFFFF
    return out


class ByteHash:
    """64-bit hash of any byte range through prefix sums of a polynomial with
    random byte values; `lower` makes A-Z hash as a-z."""

    def __init__(self, lower: bool = False):
        table = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_P))
        if lower:
            table[65:91] = table[97:123]
        self.table, self.n = table, 0

    def prefix(self, data: np.ndarray) -> np.ndarray:
        if len(data) + 1 > self.n:
            self.n = max(len(data) + 1, 2 * self.n)
            self.pow, self.inv = _powers(self.n, _P), _powers(self.n, pow(_P, -1, 1 << 64))
        out = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum(self.table[data] * self.pow[:len(data)], out=out[1:])
        return out

    def ranges(self, prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hash of data[start:end] for each range; never 0."""
        return mix((prefix[end] - prefix[start]) * self.inv[start] + (end - start).astype(np.uint64)) | np.uint64(1)


@dataclass
class Slice:
    """Some whole documents: rows [lo, hi) of the batch and their bytes."""

    lo: int
    hi: int
    data: np.ndarray     # uint8
    offsets: np.ndarray  # int64, hi - lo + 1

    def text(self, start: int, end: int) -> str:
        return self.data[start:end].tobytes().decode("utf-8", "replace")


def slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[Slice]:
    """Walk a string column in slices of whole texts; a null text is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    n = len(column)
    if n == 0:
        return
    _, off, raw = column.buffers()
    offsets = np.frombuffer(off, dtype=np.int64)[column.offset:column.offset + n + 1]
    data = np.frombuffer(raw, dtype=np.uint8) if raw is not None else np.zeros(0, np.uint8)
    lo = 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + limit, side="right")) - 1)
        hi = min(hi, n)
        yield Slice(lo, hi, data[offsets[lo]:offsets[hi]], (offsets[lo:hi + 1] - offsets[lo]).astype(np.int64))
        lo = hi


_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def words(s: Slice, breaks: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end (byte positions) and document index of every word of a slice.

    ``breaks`` marks further positions where a new word starts."""
    inside = ~_SPACE[s.data]
    n = len(inside)
    if n == 0:
        z = np.zeros(0, np.int64)
        return z, z, z
    first = np.zeros(n + 1, dtype=bool)
    first[s.offsets] = True            # a document starts here
    if breaks is not None:
        first[:n] |= breaks
    start = np.flatnonzero(inside & (first[:n] | np.concatenate(([True], ~inside[:-1]))))
    end = np.flatnonzero(inside & (first[1:] | np.concatenate((~inside[1:], [True])))) + 1
    doc = np.searchsorted(s.offsets, start, side="right") - 1
    return start, end, doc


def window_hashes(h: np.ndarray, doc: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every window of k consecutive words of one document, and the
    index of its first word."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    ok = np.flatnonzero(doc[:n] == doc[k - 1:k - 1 + n])
    out = np.zeros(n, dtype=np.uint64)
    for j in range(k):
        out = (out + h[j:j + n]) * np.uint64(_P + 2 * j)
        out ^= out >> np.uint64(29)
    return mix(out[ok]), ok


def bounds(doc: np.ndarray, n_docs: int) -> np.ndarray:
    """Positions at which each document's words start (n_docs + 1)."""
    return np.searchsorted(doc, np.arange(n_docs + 1))
