"""Op 6: quality rules with tokeniser fertility.

Base rules count words and repeats; the method's verdict comes from public
vocabularies: how many characters a token of each vocabulary holds (fertility),
which share of the tokens of the byte-fallback vocabulary are single bytes, and
the entropy of its tokens. Wide limits per script (the script of most letters)
reject what is no text at all. Inside them every script and language has
rejection bands of its own, taken from all documents that pass the base rules:
fertility may lie SPREADS median absolute deviations from the median, where a
deviation counts times the root of the text's tokens (the mean of a short text
strays further), entropy ENTROPY_SPREADS times as far below the median as the
lower quartile. Medians are exact on rounded values: counts per value are
partially aggregated, so neither a hot language nor the order of rows matters.

Words are hashed on their bytes and only words that a task has not met yet are
tokenised, so a word costs its tokenisation once per task, not once per use.
White space never lies inside a token of these vocabularies, so a text's tokens
are those of its words. Files are found by ``public_tokenizers.path`` or in the
folder given.

Nulls and edges: a null or wordless text has no words, fails the base rules and
is not kept; fewer than ``MIN_TOKENS`` tokens give no entropy verdict; a null
language is one of its own; a language of fewer than ``LEAST_DOCS`` documents that pass
the base rules and the limits has the limits alone; rows come one for one
(repeated rows alike); extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from ..functions.reuse import materialize
from .text import ByteHash, Slice, slices, window_hashes, words, written

PIECES, BYTES = "piece_bpe_32k.model", "byte_bpe_50k.tiktoken"
MIN_TOKENS = 64
#: Bytes of text measured at once: some 60 bytes of arrays per byte of text.
RULE_BYTES = 512 << 10
WINDOW = 8
SYMBOLS = np.zeros(256, dtype=bool)
SYMBOLS[list(b"#*$%&|<>")] = True

#: A text outside [low, high] is rejected, whatever the corpus holds. chars_piece and chars_byte
#: are characters per token of the two vocabularies, bytes the byte-fallback
#: share, entropy bits per token (relative to the most its length allows).
LIMITS = {
    "latin": {"chars_piece": (1.6, 8.0), "chars_byte": (1.6, 8.0), "bytes": (0.0, 0.10), "entropy": (0.6, 1.0)},
    "cyrillic": {"chars_piece": (1.2, 7.0), "chars_byte": (0.6, 7.0), "bytes": (0.0, 0.10), "entropy": (0.6, 1.0)},
    "other": {"chars_piece": (0.2, 7.0), "chars_byte": (0.2, 7.0), "bytes": (0.0, 1.0), "entropy": (0.6, 1.0)},
}
SCRIPTS = tuple(LIMITS)
#: Half-widths of the bands of a language, and the least half-width as a share of the median.
SPREADS, ENTROPY_SPREADS, LEAST_SHARE = 9.0, 4.0, 0.05
#: Fewer documents than this are no measure of a language.
LEAST_DOCS = 100
#: Measures are rounded to 1 / STEPS for the medians, deviations to 1 / 100.
STEPS = 10000


def tokenizer_file(name: str, folder: str | None) -> str:
    if folder:
        return str(Path(folder) / name)
    import public_tokenizers
    return public_tokenizers.path(name)


class WordTokens:
    """Token ids of words in two public vocabularies, kept by word hash."""

    LIMIT = 2_000_000  # words kept before the table starts anew

    def __init__(self, folder: str | None):
        import base64

        import sentencepiece
        import tiktoken
        from public_tokenizers import PATTERN

        self.sp = sentencepiece.SentencePieceProcessor(model_file=tokenizer_file(PIECES, folder))
        with open(tokenizer_file(BYTES, folder), "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.tk = tiktoken.Encoding("bytes", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.token_bytes = np.zeros(max(ranks.values()) + 1, dtype=np.int64)
        self.token_bytes[list(ranks.values())] = [len(x) for x in ranks]
        self.is_byte = np.array([self.sp.is_byte(i) for i in range(self.sp.vocab_size())])
        self.clear()

    def clear(self) -> None:
        self.hashes = np.zeros(0, np.uint64)
        self.rows: dict[str, np.ndarray] = {k: np.zeros(0, np.int64) for k in ("n_piece", "n_bytes", "n_byte_bpe", "at")}
        self.ids = np.zeros(0, np.int32)

    def add(self, hashes: np.ndarray, texts: list[str]) -> None:
        if len(self.hashes) + len(hashes) > self.LIMIT:
            self.clear()
        pieces = self.sp.encode(texts, num_threads=1)
        n = np.array([len(x) for x in pieces], dtype=np.int64)
        flat = np.fromiter((i for x in pieces for i in x), dtype=np.int32, count=int(n.sum()))
        other = [self._byte_tokens(texts[i:i + 4096]) for i in range(0, len(texts), 4096)]
        start = np.concatenate(([0], np.cumsum(n)))
        fallback = np.concatenate(([0], np.cumsum(self.is_byte[flat])))
        new = {"n_piece": n, "n_bytes": fallback[start[1:]] - fallback[start[:-1]],
               "n_byte_bpe": np.concatenate(other), "at": start[:-1] + len(self.ids)}
        self.ids = np.concatenate((self.ids, flat))
        every = np.concatenate((self.hashes, hashes))
        order = np.argsort(every, kind="stable")
        self.hashes = every[order]
        self.rows = {k: np.concatenate((v, new[k]))[order] for k, v in self.rows.items()}

    def _byte_tokens(self, texts: list[str]) -> np.ndarray:
        """Tokens of each word of a run of words: a space always starts a token,
        so a token belongs to the word in whose bytes it starts."""
        size = np.array([len(t.encode()) + 1 for t in texts], dtype=np.int64)
        ids = np.array(self.tk.encode_ordinary(" " + " ".join(texts)), dtype=np.int64)
        start = np.cumsum(self.token_bytes[ids]) - self.token_bytes[ids]
        return np.bincount(np.searchsorted(np.cumsum(size), start, side="right"), minlength=len(texts))[:len(texts)].astype(np.int64)

    def lookup(self, s: Slice, h: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Row of every word, after tokenising those not met before."""
        uniq, first, inverse = np.unique(h, return_index=True, return_inverse=True)
        at = np.searchsorted(self.hashes, uniq)
        known = at < len(self.hashes)
        known[known] = self.hashes[at[known]] == uniq[known]
        if not known.all():
            new = np.flatnonzero(~known)
            size = len(self.hashes)
            texts = [s.text(start[i], end[i]) for i in first[new]]
            if size + len(new) > self.LIMIT:      # the table starts anew: all words of this slice go in
                new, texts = np.arange(len(uniq)), [s.text(start[i], end[i]) for i in first]
            self.add(uniq[new], texts)
            at = np.searchsorted(self.hashes, uniq)
        return at[inverse]


def repeats(h: np.ndarray, doc: np.ndarray, n_docs: int, k: int) -> np.ndarray:
    """Words lying in a k-word window that its document holds twice or more."""
    w, first = window_hashes(h, doc, k)
    if not len(w):
        return np.zeros(n_docs, np.int64)
    d = doc[first]
    order = np.lexsort((w, d))
    same = (w[order][1:] == w[order][:-1]) & (d[order][1:] == d[order][:-1])
    twice = np.zeros(len(w), dtype=bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    cover = np.zeros(len(h) + 1, np.int64)
    np.add.at(cover, first[twice], 1)
    np.add.at(cover, first[twice] + k, -1)
    return np.bincount(doc, weights=np.cumsum(cover)[:-1] > 0, minlength=n_docs).astype(np.int64)



def duplicate_lines(s: Slice, prefix: np.ndarray, hasher: ByteHash, start: np.ndarray) -> np.ndarray:
    """Lines (split at newlines) with a word that equal an earlier line of their document."""
    n_docs = s.hi - s.lo
    if not len(start):
        return np.zeros(n_docs, np.int64)
    cut = np.flatnonzero(s.data == 0x0A)
    begin = np.unique(np.concatenate((cut + 1, s.offsets[:-1])))
    begin = begin[begin < len(s.data)]
    own = np.searchsorted(s.offsets, begin, side="right") - 1
    stop = np.minimum(s.offsets[own + 1], np.append(cut, len(s.data))[np.searchsorted(cut, begin)])
    word = np.searchsorted(start, begin)
    full = (word < len(start)) & (start[np.minimum(word, len(start) - 1)] < stop)
    begin, stop, own = begin[full], stop[full], own[full]
    h = hasher.ranges(prefix, begin, stop)
    order = np.lexsort((h, own))
    h, own = h[order], own[order]
    same = (h[1:] == h[:-1]) & (own[1:] == own[:-1])
    return np.bincount(own[1:][same], minlength=n_docs).astype(np.int64)


def entropy_share(ids: np.ndarray, doc: np.ndarray, n_docs: int) -> tuple[np.ndarray, np.ndarray]:
    """Per document: entropy of its token ids over the most that many tokens allow, and the tokens."""
    total = np.bincount(doc, minlength=n_docs)
    key = np.sort(doc.astype(np.int64) << 20 | ids)
    new = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1]))) if len(key) else np.zeros(0, np.int64)
    count = np.diff(np.append(new, len(key)))
    own = key[new] >> 20
    p = count / np.maximum(total[own], 1)
    bits = np.bincount(own, weights=-p * np.log2(np.maximum(p, 1e-300)), minlength=n_docs)
    most = np.log2(np.clip(total, 2, None).astype(float))
    return bits / np.minimum(most, 10.0), total


def scripts(s: Slice) -> np.ndarray:
    """Index into SCRIPTS of each document, by its bytes: ASCII letters and the
    two-byte lead bytes of Latin and Cyrillic; three- and four-byte leads are other."""
    table = np.full(256, 3, dtype=np.int64)
    table[65:91] = table[97:123] = table[0xC3:0xCA] = 0
    table[0xD0:0xD4] = 1
    table[0xE3:0xF5] = 2
    table[[0xCE, 0xCF, *range(0xD5, 0xE2)]] = 2
    n_docs = s.hi - s.lo
    kind = table[s.data]
    sums = np.zeros((3, n_docs), np.int64)
    for i in range(3):
        c = np.concatenate(([0], np.cumsum(kind == i)))
        sums[i] = c[s.offsets[1:]] - c[s.offsets[:-1]]
    return np.argmax(sums, axis=0)


MEASURES = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, "
            "in_limits boolean, script string, n_tokens long, chars_per_token double, chars_per_byte_token double, "
            "byte_share double, token_entropy double")


def measure_batches(folder: str | None, limits_by_script: dict, returned: list[str]):
    """mapInArrow function: rows with a text -> their ``returned`` columns and a struct of MEASURES."""
    limits = {m: np.array([limits_by_script[k][m] for k in SCRIPTS]) for m in ("chars_piece", "chars_byte", "bytes", "entropy")}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, tokens = ByteHash(), None
        for b in batches:
            tokens = tokens or WordTokens(folder)
            for s in slices(b.column("text"), RULE_BYTES):
                n = s.hi - s.lo
                start, end, doc = words(s)
                prefix = hasher.prefix(s.data)
                h = hasher.ranges(prefix, start, end)
                per = lambda x: np.bincount(doc, weights=x, minlength=n).astype(np.int64)
                points = np.concatenate(([0], np.cumsum((s.data & 0xC0) != 0x80)))
                symbols = np.concatenate(([0], np.cumsum(SYMBOLS[s.data])))
                n_words = np.bincount(doc, minlength=n).astype(np.int64)
                word_chars = per(points[end] - points[start])
                n_symbols = symbols[s.offsets[1:]] - symbols[s.offsets[:-1]]
                n_repeat = repeats(h, doc, n, WINDOW)
                n_dup = duplicate_lines(s, prefix, hasher, start)
                row = tokens.lookup(s, h, start, end)
                n_piece, n_bytes, n_bpe = (per(tokens.rows[k][row]) for k in ("n_piece", "n_bytes", "n_byte_bpe"))
                size = tokens.rows["n_piece"][row]
                at = np.repeat(tokens.rows["at"][row] - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
                entropy, total = entropy_share(tokens.ids[at], np.repeat(doc, size), n)
                kind = scripts(s)
                base_failed = (n_words < 20) | (100 * n_repeat > 30 * n_words)
                measures = {"chars_piece": word_chars / np.maximum(n_piece, 1), "chars_byte": word_chars / np.maximum(n_bpe, 1),
                            "bytes": n_bytes / np.maximum(n_piece, 1), "entropy": entropy}
                ok = np.ones(n, dtype=bool)
                for m, x in measures.items():
                    low, high = limits[m][kind].T
                    good = (x >= low) & (x <= high)
                    ok &= (good | (total < MIN_TOKENS)) if m == "entropy" else good
                out = {"n_words": n_words, "word_chars": word_chars, "n_symbols": n_symbols, "n_dup_lines": n_dup,
                       "n_repeat_words": n_repeat, "base_failed": base_failed, "in_limits": ok,
                       "script": pa.array([SCRIPTS[i] for i in kind], pa.string()), "n_tokens": n_piece,
                       "chars_per_token": measures["chars_piece"], "chars_per_byte_token": measures["chars_byte"],
                       "byte_share": measures["bytes"], "token_entropy": entropy}
                struct = pa.StructArray.from_arrays([x if isinstance(x, pa.Array) else pa.array(x) for x in out.values()], names=list(out))
                own = b.slice(s.lo, n)
                yield pa.RecordBatch.from_arrays([*(own.column(c) for c in returned), struct], names=[*returned, "measures"])
    return run


def _schema(returned: str | StructType) -> StructType:
    fields = (StructType.fromDDL(returned) if isinstance(returned, str) else returned).fields
    return StructType([*fields, StructField("measures", StructType.fromDDL(MEASURES))])


def _language() -> Column:
    """A key of the language; null has its own."""
    return F.coalesce(F.concat(F.lit("="), F.col("lang")), F.lit(""))


def language_bands(rows: DataFrame) -> DataFrame:
    """script, language -> the median (mid_*) and half-width (half_*) of its bands; rows
    carry lang and measures. Half-widths of fertility are for a text of one token."""
    m = F.col("measures")
    values = F.array(*(F.struct(F.lit(name).alias("name"), x.alias("x")) for name, x in (
        ("piece", m["chars_per_token"]), ("byte", m["chars_per_byte_token"]),
        ("entropy", F.when(m["n_tokens"] >= MIN_TOKENS, m["token_entropy"])))))
    long = (rows.filter(~m["base_failed"] & m["in_limits"])
            .select(m["script"].alias("script"), _language().alias("language"), m["n_tokens"].alias("n_tokens"), F.inline(values))
            .filter("x is not null"))
    group = ["script", "language", "name"]
    # Written tables have a known size: Spark broadcasts them below its threshold, else it shuffles.
    middle = written(
        long.groupBy(*group, F.round(F.col("x") * STEPS).alias("v")).agg(F.count("*").alias("n"))
        .groupBy(*group).agg((F.percentile("v", F.lit(0.5), F.col("n")) / STEPS).alias("mid"),
                             (F.percentile("v", F.lit(0.25), F.col("n")) / STEPS).alias("low"), F.sum("n").alias("docs"))
        .filter(F.col("docs") >= LEAST_DOCS))
    away = F.abs(F.col("x") - F.col("mid")) * F.sqrt("n_tokens")
    spread = (long.filter("name <> 'entropy'").join(middle, group)
              .groupBy(*group, F.round(F.least(away, F.lit(1e6)) * 100).alias("v")).agg(F.count("*").alias("n"))
              .groupBy(*group).agg((F.percentile("v", F.lit(0.5), F.col("n")) / 100).alias("spread")))
    half = F.when(F.col("name") == "entropy", ENTROPY_SPREADS * (F.col("mid") - F.col("low"))).otherwise(SPREADS * F.col("spread"))
    bands = middle.join(spread, group, "left").withColumn("half", half)
    pick = lambda c, name: F.max(F.when(F.col("name") == name, F.col(c))).alias(f"{c}_{name}")
    return written(bands.groupBy("script", "language").agg(*(pick(c, n) for n in ("piece", "byte", "entropy") for c in ("mid", "half"))))


def judged(rows: DataFrame) -> DataFrame:
    """rows (with lang and measures) with ``kept``: base rules, limits and the bands of all rows."""
    bands = language_bands(rows)
    m = F.col("measures")

    def inside(x: Column, name: str, scale: Column | None = None) -> Column:
        mid, half = F.col(f"bands.mid_{name}"), F.col(f"bands.half_{name}")
        width = F.greatest(half if scale is None else half / scale, LEAST_SHARE * mid)
        near = x >= mid - width if scale is None else F.abs(x - mid) <= width
        return F.coalesce(near, F.lit(True))

    root = F.sqrt(m["n_tokens"])
    good = (inside(m["chars_per_token"], "piece", root) & inside(m["chars_per_byte_token"], "byte", root)
            & (inside(m["token_entropy"], "entropy") | (m["n_tokens"] < MIN_TOKENS)))
    side = bands.select(F.struct("*").alias("bands"))
    joined = rows.join(side, (m["script"] == F.col("bands.script")) & (_language() == F.col("bands.language")), "left")
    return joined.withColumn("kept", ~m["base_failed"] & m["in_limits"] & good).drop("bands")


def quality_rules(docs: DataFrame, folder: str | None = None, limits: dict | None = None) -> DataFrame:
    """One row per document with its counts, measures, base_failed and kept."""
    rows = materialize(docs.select("doc_id", "lang", "text").mapInArrow(
        measure_batches(folder, limits or LIMITS, ["doc_id", "lang"]), _schema("doc_id long, lang string")))
    first = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    rest = ["script", "n_tokens", "chars_per_token", "chars_per_byte_token", "byte_share", "token_entropy"]
    return judged(rows).select("doc_id", *(f"measures.{c}" for c in first), "kept", *(f"measures.{c}" for c in rest))


def keep_good(docs: DataFrame, folder: str | None = None, limits: dict | None = None) -> DataFrame:
    """The rows of docs that the rules keep. They are measured once and written with
    their measures, since the bands need all of them. Other columns travel in one struct, so their names are free."""
    packed = docs.select("lang", "text", F.struct(*(F.col(f"`{c}`") for c in docs.columns if c not in ("lang", "text"))).alias("other"))
    rows = written(packed.mapInArrow(measure_batches(folder, limits or LIMITS, packed.columns), _schema(packed.schema)))
    return judged(rows).filter("kept").select(
        *(F.col(f"`{c}`") if c in ("lang", "text") else F.col(f"other.`{c}`") for c in docs.columns))
