"""Op 9: packing documents into sequences by first-fit decreasing.

Every document becomes its token ids (``word_bpe_49k.json``) and the end id 2.
Full stretches of ``length`` ids are sequences of their own; what remains of each
document is a piece. Pieces are dealt at random into groups of about
``group_tokens`` ids, and each group packs its pieces alone: largest first, each
into the first sequence with room, found in a tournament tree over the room
left (a node holds the most room below it).

Tokenising: white space and borders between letters and ASCII punctuation always
separate the tokens of this vocabulary, so texts are cut into such units; a unit
is tokenised once per task and found by its hash afterwards. Only piece rows
(no ids) are shuffled.

Nulls and edges: a null, empty or blank text is the end id alone; a null doc_id
is allowed; repeated rows are packed each; extra columns are ignored; an empty
table gives no rows.
"""

from __future__ import annotations

import os
import unicodedata
import zlib
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.reuse import materialize
from .text import ByteHash, Slice, bounds, slices, words

VOCABULARY = "word_bpe_49k.json"
END_ID = 2
LENGTH = 4096
#: Ids of remaining pieces in a group (one task's work).
GROUP_TOKENS = 4_000_000
#: Bytes of text tokenised at once; a worker's memory follows it.
TOKEN_BYTES = 512 << 10

_LETTER = np.zeros(256, dtype=bool)
_LETTER[65:91] = _LETTER[97:123] = True
#: ASCII punctuation; the apostrophe may start a contraction and stays inside.
_PUNCT = np.zeros(256, dtype=bool)
_PUNCT[[*range(0x21, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x7F)]] = True
_PUNCT[0x27] = False


def unit_breaks(data: np.ndarray) -> np.ndarray:
    """Positions where a new unit starts inside a word: between a letter (ASCII,
    or two-byte Latin-1) and ASCII punctuation, either way round."""
    out = np.zeros(len(data), dtype=bool)
    if len(data) < 2:
        return out
    latin = np.zeros(len(data), dtype=bool)        # last byte of a Latin-1 letter
    latin[1:] = (data[:-1] == 0xC3) & (data[1:] != 0x97) & (data[1:] != 0xB7)
    lead = np.zeros(len(data), dtype=bool)         # first byte of one
    lead[:-1] = latin[1:]
    letter, punct = _LETTER[data], _PUNCT[data]
    out[1:] = ((letter | latin)[:-1] & punct[1:]) | (punct[:-1] & (letter | lead)[1:])
    return out


class UnitTokens:
    """Token ids of units, kept by the hash of their lower-cased bytes."""

    LIMIT = 2_000_000

    def __init__(self, vocabulary: str):
        # A task has one core; the threads of a tokenizer pool would each keep their own memory.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(vocabulary)
        self.tokenizer.encode_special_tokens = True     # their strings in a text are ordinary text
        vocab = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocab.values()) + 1, dtype=bool)
        self.ends[[i for t, i in vocab.items() if t.endswith("</w>")]] = True
        self.clear()

    def clear(self) -> None:
        self.hashes, self.at, self.size = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.uint32)

    @staticmethod
    def plain(unit: str) -> bool:
        """One run of letters that no normalisation changes: exactly one token run."""
        return unit.isalpha() and unit.lower().isalpha() and (unit.isascii() or unicodedata.is_normalized("NFC", unit))

    def tokenise(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all units in order, and how many each has. Letter runs are
        tokenised many at a time; each ends with an end-of-word token."""
        easy = np.array([self.plain(u) for u in units], dtype=bool)
        size = np.zeros(len(units), dtype=np.int64)
        parts: dict[int, list[int]] = {}
        which = np.flatnonzero(easy)
        runs = [which[i:i + 256] for i in range(0, len(which), 256)]
        joined = self.tokenizer.encode_batch_fast([" ".join(units[i] for i in run) for run in runs], add_special_tokens=False)
        flat = []
        for run, e in zip(runs, joined):
            ids = np.array(e.ids, dtype=np.uint32)
            cut = np.flatnonzero(self.ends[ids]) + 1
            if len(cut) != len(run):        # never seen; one by one then
                easy[run] = False
                continue
            size[run] = np.diff(cut, prepend=0)
            flat.append(ids)
        hard = np.flatnonzero(~easy)
        for i, e in zip(hard, self.tokenizer.encode_batch_fast([units[i] for i in hard], add_special_tokens=False)):
            parts[i] = e.ids
            size[i] = len(e.ids)
        at = np.cumsum(size) - size
        out = np.zeros(int(size.sum()), dtype=np.uint32)
        mask = np.repeat(easy, size)
        if flat:
            out[mask] = np.concatenate(flat)
        for i, ids in parts.items():
            out[at[i]:at[i] + size[i]] = ids
        return out, size

    def lookup(self, s: Slice, h: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Row of every unit, after tokenising those not met before."""
        uniq, first, inverse = np.unique(h, return_index=True, return_inverse=True)
        at = np.searchsorted(self.hashes, uniq)
        known = at < len(self.hashes)
        known[known] = self.hashes[at[known]] == uniq[known]
        new = np.flatnonzero(~known)
        if len(new):
            if len(self.hashes) + len(new) > self.LIMIT:
                self.clear()
                new = np.arange(len(uniq))
            raw = s.data.tobytes()
            units = [raw[a:b].decode("utf-8", "replace") for a, b in zip(start[first[new]].tolist(), end[first[new]].tolist())]
            ids, size = self.tokenise(units)
            every = np.concatenate((self.hashes, uniq[new]))
            order = np.argsort(every, kind="stable")
            self.at = np.concatenate((self.at, np.cumsum(size) - size + len(self.ids)))[order]
            self.size = np.concatenate((self.size, size))[order]
            self.ids = np.concatenate((self.ids, ids))
            self.hashes = every[order]
            at = np.searchsorted(self.hashes, uniq)
        return at[inverse]


def vocabulary_file(folder: str | None) -> str:
    if folder:
        return str(Path(folder) / VOCABULARY)
    import public_tokenizers
    return public_tokenizers.path(VOCABULARY)


def token_slices(column: pa.Array, units: UnitTokens, hasher: ByteHash) -> Iterator[tuple[Slice, np.ndarray, np.ndarray]]:
    """Per slice: its ids (each document's followed by the end id) and where each document starts."""
    for s in slices(column, TOKEN_BYTES):
        n = s.hi - s.lo
        start, end, doc = words(s, unit_breaks(s.data))
        row = units.lookup(s, hasher.ranges(hasher.prefix(s.data), start, end), start, end)
        size = units.size[row]
        upto = np.cumsum(size)
        at = np.repeat(units.at[row] - (upto - size), size) + np.arange(int(size.sum()))
        ids = units.ids[at]
        first = np.concatenate(([0], upto))[bounds(doc, n)]      # ids before each document, without end ids
        out = np.full(len(ids) + n, END_ID, dtype="<u4")
        out[np.arange(len(ids)) + np.repeat(np.arange(n), np.diff(first))] = ids
        yield s, out, first + np.arange(n + 1)


def piece_batches(folder: str | None, length: int, with_ids: bool):
    """mapInArrow function: (doc_id, text) -> one row per piece of at most length ids."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, units = ByteHash(lower=True), None
        for b in batches:
            units = units or UnitTokens(vocabulary_file(folder))
            docs = b.column("doc_id")
            for s, ids, first in token_slices(b.column("text"), units, hasher):
                total = np.diff(first)
                count = (total + length - 1) // length
                own = np.repeat(np.arange(len(total)), count)
                nth = np.arange(len(own)) - np.repeat(np.cumsum(count) - count, count)
                start = nth * length
                size = np.minimum(total[own] - start, length)
                at = first[own] + start
                raw = memoryview(ids.tobytes())
                crc = np.fromiter((zlib.crc32(raw[4 * a:4 * (a + n)]) for a, n in zip(at.tolist(), size.tolist())),
                                  dtype=np.int64, count=len(own))
                out = {"doc_id": docs.take(pa.array(own + s.lo)), "start": start, "length": size, "ids_crc32": crc,
                       "doc_tokens": total[own]}
                if with_ids:
                    out["ids"] = pa.array([ids[a:a + n].astype(np.int32) for a, n in zip(at, size)], pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays([x if isinstance(x, pa.Array) else pa.array(x) for x in out.values()], names=list(out))
    return run


class Tournament:
    """Tournament tree over the room of sequences: finds the first with enough."""

    def __init__(self, n: int, length: int):
        self.leaves = 1
        while self.leaves < n:
            self.leaves *= 2
        self.room = [length] * (2 * self.leaves)

    def place(self, size: int) -> int:
        """Put a piece into the first sequence with room; returns the sequence."""
        room, i = self.room, 1
        while i < self.leaves:
            i *= 2
            if room[i] < size:
                i += 1
        leaf = i - self.leaves
        room[i] -= size
        while i > 1:
            i //= 2
            room[i] = room[2 * i] if room[2 * i] >= room[2 * i + 1] else room[2 * i + 1]
        return leaf


def first_fit_decreasing(sizes: np.ndarray, length: int) -> list[list[int]]:
    """Pieces (indices) of each sequence."""
    tree, bins = Tournament(len(sizes), length), []
    for i in np.argsort(-sizes, kind="stable").tolist():
        b = tree.place(int(sizes[i]))
        if b == len(bins):
            bins.append([])
        bins[b].append(i)
    return bins


def group_packer(length: int):
    """applyInPandas function: the remaining pieces of one group -> placed pieces."""
    def run(key, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["length", "doc_id", "uid"], ascending=[False, True, True], ignore_index=True)
        sizes = pdf["length"].to_numpy()
        bins = first_fit_decreasing(sizes, length)
        order = np.array([i for b in bins for i in b], dtype=np.int64)
        count = np.array([len(b) for b in bins], dtype=np.int64)
        seq = np.repeat(np.arange(len(bins)), count)
        upto = np.cumsum(sizes[order])
        before = upto - sizes[order]
        out = pdf.iloc[order].drop(columns=["uid", "grp"])
        out["sequence_id"] = (int(key[0]) << 32) + seq
        out["offset"] = before - np.repeat(before[np.cumsum(count) - count], count)
        return out
    return run


PIECE = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


def pack(docs: DataFrame, folder: str | None = None, length: int = LENGTH, group_tokens: int = GROUP_TOKENS,
         with_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens,
    sequence_id, offset (and the ids themselves, if asked for)."""
    schema = PIECE + (", ids array<int>" if with_ids else "")
    pieces = docs.select("doc_id", "text").mapInArrow(piece_batches(folder, length, with_ids), schema)
    pieces = materialize(pieces.withColumn("uid", F.monotonically_increasing_id()))
    # A full piece is a sequence of its own; its id is negative.
    full = pieces.filter(F.col("length") == length).select(
        *[c for c in pieces.columns if c != "uid"], (-1 - F.col("uid")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    rest = pieces.filter(F.col("length") < length)
    tokens = rest.agg(F.sum("length")).first()[0] or 0
    groups = max(1, -(-tokens // group_tokens))
    rest = rest.withColumn("grp", F.pmod(F.xxhash64("doc_id", "uid", "ids_crc32"), F.lit(groups)))
    packed = rest.groupBy("grp").applyInPandas(group_packer(length), f"{schema}, sequence_id long, offset long")
    return full.unionByName(packed)
