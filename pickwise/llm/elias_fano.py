"""Elias-Fano coding of monotone sequences, and a two-level n-gram trie on it,
both queried for whole arrays at once.

A sequence of n values below u keeps l = log2(u / n) low bits of each value as they
are and the high parts in unary in one bit vector (element i with high part h is
the one at position h + i). A small directory counts the zeros before every
64-bit word, which gives both select operations and, from them, access to an
element and the successor of a value.
"""

from __future__ import annotations

from pathlib import Path

import numpy as np

_ONES = np.array([bin(i).count("1") for i in range(256)], dtype=np.uint8)
#: _NTH[byte, k]: position of the k-th one in a byte.
_NTH = np.array([([j for j in range(8) if i >> j & 1] + [8] * 8)[:8] for i in range(256)], dtype=np.uint8)
U = np.uint64


def _select_in_word(word: np.ndarray, k: np.ndarray) -> np.ndarray:
    """Position of the k-th one (from 0) in each 64-bit word."""
    b = word.view(np.uint8).reshape(-1, 8)
    upto = np.cumsum(_ONES[b], axis=1, dtype=np.uint8)
    byte = (upto <= k[:, None].astype(np.uint8)).sum(axis=1)
    row = np.arange(len(b))
    before = np.where(byte > 0, upto[row, np.maximum(byte - 1, 0)], 0)
    return byte * 8 + _NTH[b[row, np.minimum(byte, 7)], (k - before).astype(np.int64) & 7]


class EliasFano:
    """A monotone (non-decreasing) sequence of uint64 values."""

    def __init__(self, n: int, low_bits: int, high: np.ndarray, zeros: np.ndarray, low: np.ndarray):
        self.n, self.low_bits, self.high, self.zeros, self.low = n, low_bits, high, zeros, low

    @classmethod
    def build(cls, values: np.ndarray, universe: int) -> EliasFano:
        values = np.asarray(values, dtype=np.uint64)
        n = len(values)
        bits = max(0, (universe // max(n, 1)).bit_length() - 1)
        part = values >> U(bits)
        top = int(part[-1]) if n else 0
        mark = np.zeros((n + top + 1 + 64) // 64 * 64, dtype=np.uint8)
        mark[part.astype(np.int64) + np.arange(n)] = 1
        high = np.packbits(mark, bitorder="little").view(np.uint64)
        ones = np.add.reduceat(mark, np.arange(0, len(mark), 64), dtype=np.int64)
        zeros = np.concatenate(([0], np.cumsum(64 - ones))).astype(np.uint32 if len(mark) < 1 << 32 else np.uint64)
        low = np.zeros((n * bits + 63) // 64 + 1, dtype=np.uint64)
        if bits:
            rest = values & U((1 << bits) - 1)
            at = np.arange(n, dtype=np.uint64) * U(bits)
            word, off = (at >> U(6)).astype(np.int64), at & U(63)
            np.bitwise_or.at(low, word, rest << off)
            over = np.flatnonzero(off + U(bits) > U(64))
            np.bitwise_or.at(low, word[over] + 1, rest[over] >> (U(64) - off[over]))
        return cls(n, bits, high, zeros, low)

    def _low(self, i: np.ndarray) -> np.ndarray:
        if not self.low_bits:
            return np.zeros(len(i), dtype=np.uint64)
        at = i.astype(np.uint64) * U(self.low_bits)
        word, off = (at >> U(6)).astype(np.int64), at & U(63)
        x = self.low[word] >> off
        over = np.flatnonzero(off + U(self.low_bits) > U(64))
        x[over] |= self.low[word[over] + 1] << (U(64) - off[over])
        return x & U((1 << self.low_bits) - 1)

    def _select0(self, k: np.ndarray) -> np.ndarray:
        """Position of the k-th zero; the end of the vector if there are fewer."""
        w = np.searchsorted(self.zeros, k.astype(self.zeros.dtype), side="right") - 1
        inside = w < len(self.high)
        out = np.full(len(k), len(self.high) * 64, dtype=np.int64)
        w = w[inside]
        out[inside] = w * 64 + _select_in_word(~self.high[w], k[inside] - self.zeros[w].astype(np.int64))
        return out

    def access(self, i: np.ndarray) -> np.ndarray:
        """Values of elements i."""
        ones = np.arange(len(self.zeros), dtype=np.int64) * 64 - self.zeros.astype(np.int64)
        w = np.searchsorted(ones, i, side="right") - 1
        at = w * 64 + _select_in_word(self.high[w], i - ones[w])
        return (at - i).astype(np.uint64) << U(self.low_bits) | self._low(i)

    def successor(self, x: np.ndarray, begin: np.ndarray | None = None, end: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Index of the first element in [begin, end) that is at least x, and whether it equals x.
        begin and end, where given, must hold all elements equal to x."""
        x = np.asarray(x, dtype=np.uint64)
        h = (x >> U(self.low_bits)).astype(np.int64)
        beyond = h >= len(self.high) * 64
        h = np.where(beyond, 0, h)
        lo = np.where(h > 0, self._select0(np.maximum(h - 1, 0)) - (h - 1), 0)
        hi = self._select0(h) - h
        lo, hi = np.minimum(lo, self.n), np.minimum(hi, self.n)
        if begin is not None:
            lo, hi = np.maximum(lo, begin), np.minimum(hi, end)
        lo, hi = np.where(beyond, self.n, lo), np.where(beyond, self.n, hi)
        stop = hi.copy()
        want = x & U((1 << self.low_bits) - 1)
        live = np.flatnonzero(lo < hi)
        while len(live):
            mid = (lo[live] + hi[live]) >> 1
            less = self._low(mid) < want[live]
            lo[live[less]] = mid[less] + 1
            hi[live[~less]] = mid[~less]
            live = live[lo[live] < hi[live]]
        equal = np.zeros(len(x), dtype=bool)
        inside = np.flatnonzero(lo < stop)
        equal[inside] = self._low(lo[inside]) == want[inside]
        return lo, equal

    def save(self, folder: Path, name: str) -> None:
        for part in ("high", "zeros", "low"):
            np.save(folder / f"{name}.{part}.npy", getattr(self, part))
        np.save(folder / f"{name}.size.npy", np.array([self.n, self.low_bits]))

    @classmethod
    def load(cls, folder: Path, name: str) -> EliasFano:
        n, bits = np.load(folder / f"{name}.size.npy").tolist()
        return cls(n, bits, *(np.load(folder / f"{name}.{p}.npy", mmap_mode="r") for p in ("high", "zeros", "low")))


#: Bits of a successor's hash kept relative to its context.
RELATIVE_BITS = 40
#: Steps of a quantised log10 probability.
STEPS = 4096.0


def quantise(log10: np.ndarray) -> np.ndarray:
    return np.clip(np.rint(-log10 * STEPS), 0, 65535).astype(np.uint16)


class BigramTrie:
    """Level one: the contexts (hash), with a monotone pointer to their successors
    and a quantised backoff weight. Level two: the successors of each context,
    relative to it, with a quantised smoothed probability. Levels lie in files
    that are memory-mapped."""

    def __init__(self, folder: Path):
        self.contexts, self.pointers, self.successors = (EliasFano.load(folder, n) for n in ("contexts", "pointers", "successors"))
        self.backoff, self.prob = (np.load(folder / f"{n}.npy", mmap_mode="r") for n in ("backoff", "prob"))

    @staticmethod
    def write(folder: Path, h1: np.ndarray, h2: np.ndarray, log_prob: np.ndarray, contexts: np.ndarray, log_backoff: np.ndarray) -> None:
        """h1, h2 sorted; contexts the distinct h1 in order."""
        which = np.searchsorted(contexts, h1)
        EliasFano.build(contexts, 1 << 64).save(folder, "contexts")
        EliasFano.build(np.searchsorted(h1, contexts, side="left").astype(np.uint64), len(h1) + 1).save(folder, "pointers")
        relative = which.astype(np.uint64) << U(RELATIVE_BITS) | h2 >> U(64 - RELATIVE_BITS)
        EliasFano.build(relative, len(contexts) + 1 << RELATIVE_BITS).save(folder, "successors")
        np.save(folder / "backoff.npy", quantise(log_backoff))
        np.save(folder / "prob.npy", quantise(log_prob))

    def context(self, h1: np.ndarray) -> np.ndarray:
        """Index of each context, -1 if it is unknown."""
        at, known = self.contexts.successor(h1)
        return np.where(known, at, -1)

    def ranges(self, context: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First successor of each known context and the end of its successors."""
        last = context + 1 >= self.pointers.n
        end = self.pointers.access(np.where(last, context, context + 1)).astype(np.int64)
        return self.pointers.access(context).astype(np.int64), np.where(last, self.successors.n, end)

    def log_prob(self, context: np.ndarray, runs: np.ndarray, h2: np.ndarray) -> np.ndarray:
        """log10 probability of each h2 after its known context (runs[i] of them after
        context[i], in order); nan where it was not seen there."""
        begin, end = (np.repeat(x, runs) for x in self.ranges(context))
        relative = np.repeat(context.astype(np.uint64), runs) << U(RELATIVE_BITS) | h2 >> U(64 - RELATIVE_BITS)
        at, seen = self.successors.successor(relative, begin, end)
        out = np.full(len(h2), np.nan)
        out[seen] = self.prob[at[seen]] / -STEPS
        return out

    def log_backoff(self, context: np.ndarray) -> np.ndarray:
        return self.backoff[context] / -STEPS
