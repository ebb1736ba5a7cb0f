"""Op 11: toxicity by a linear classifier over character n-grams scaled by naive
Bayes log-count ratios.

A text is lower-cased (A-Z) and padded with a space on both sides; its n-grams of
``GRAMS`` characters (code points, white space as one space character) are hashed into
``BUCKETS`` features, present or not. From the labelled texts each feature gets the naive
Bayes ratio r = log((1 + p) / (|p|)) - log((1 + q) / |q|), p and q being the texts of
either class that have it; ratios nearer to 0 than ``LEAST_RATIO`` tell nothing and
become 0. A logistic regression with an absolute penalty is then fitted on the
features scaled by r. The product of weight and ratio is one number per bucket, 0
for most, so that a text's score needs only its few telling n-grams.

Fitting: a bounded sample of labelled texts (``TRAIN_DOCS`` per class, of up to
``TRAIN_BYTES`` each, smallest hash of the id first) outside the held-out fold comes to
the driver; classes weigh the same. The weights (one float per bucket) go to the tasks,
which score every whole text in Arrow batches; n-grams are made in numpy for slices
of whole documents.

Nulls and edges: a null or empty text has one n-gram of its two spaces at most and gets the
score of the bias; a null doc_id is not held out and has no label; labels other than 0
and 1 are ignored; an id with both labels counts in both classes, repeated rows of an
id count once, with the smallest text; without labels of a class every score is 0.5;
extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.reuse import materialize
from .text import Slice, slices

GRAMS = (3, 4, 5, 6)
BUCKETS = 1 << 20
#: Bounds of the training sample: documents of each class, bytes of one text.
TRAIN_DOCS, TRAIN_BYTES = 2000, 32768
#: Texts of a class that must have a feature for it to count.
LEAST_TEXTS, LEAST_RATIO = 4, 0.7
#: Passes over the sample, and the weight of the absolute penalty.
PASSES, PENALTY = 250, 1e-3
#: Bytes scored at once.
SCORE_BYTES = 1 << 20
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
_STEP = np.uint64(0x2545F4914F6CDD1D)


def characters(s: Slice) -> tuple[np.ndarray, np.ndarray]:
    """Code points of the padded texts of a slice, one after the other, and where each text starts."""
    starts = np.zeros(len(s.offsets), dtype=np.int64)
    try:
        codes = np.frombuffer(s.data.tobytes().decode("utf-8").encode("utf-32-le"), dtype="<u4")
        before = np.concatenate(([0], np.cumsum(s.data & 0xC0 != 0x80)))
        sizes = np.diff(before[s.offsets])
    except UnicodeDecodeError:                                 # bytes that are not UTF-8 become U+FFFD, text by text
        parts = [np.frombuffer(s.text(a, b).encode("utf-32-le"), dtype="<u4") for a, b in zip(s.offsets[:-1], s.offsets[1:])]
        sizes, codes = np.array([len(p) for p in parts], dtype=np.int64), np.concatenate(parts)
    np.cumsum(sizes + 2, out=starts[1:])
    out = np.full(starts[-1], 32, dtype=np.uint64)
    first = np.concatenate(([0], np.cumsum(sizes)[:-1])) if len(sizes) else np.zeros(0, np.int64)
    out[np.arange(len(codes)) + np.repeat(starts[:-1] + 1 - first, sizes)] = codes
    out[(out >= 9) & (out <= 13)] = 32
    upper = (out >= 65) & (out <= 90)
    out[upper] += np.uint64(32)
    return out, starts


def grams(codes: np.ndarray, starts: np.ndarray, useful: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Bucket and document of the n-grams of every text, each once per text;
    with useful, only those in a bucket marked there."""
    n, shift = len(codes), np.uint64(64 - BUCKETS.bit_length() + 1)
    found, docs, h = [], [], np.zeros(n, dtype=np.uint64)
    room = np.repeat(starts[1:], np.diff(starts)) - np.arange(n)        # characters to the end of the text
    for k in range(max(GRAMS)):
        h = h[:n - k] * _STEP + codes[k:] + np.uint64(1) if n > k else h[:0]
        if k + 1 not in GRAMS:
            continue
        mixed = h * _MULTIPLIER
        bucket = ((mixed ^ (mixed >> np.uint64(29))) * _MULTIPLIER >> shift).astype(np.int64)
        ok = room[:len(bucket)] > k
        if useful is not None:
            ok &= useful[bucket]
        at = np.flatnonzero(ok)
        found.append(bucket[at])
        docs.append(np.searchsorted(starts, at, side="right") - 1)
    key = np.sort(np.concatenate(docs) * BUCKETS + np.concatenate(found))
    key = key[np.concatenate((np.ones(min(1, len(key)), dtype=bool), key[1:] != key[:-1]))]
    return key & (BUCKETS - 1), key >> (BUCKETS.bit_length() - 1)


def text_grams(texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Buckets and documents of a list of texts, in bounded parts."""
    lo = 0
    while lo < len(texts):
        part, size, first = [], 0, lo
        while lo < len(texts) and (not part or size < SCORE_BYTES):
            part.append(texts[lo].encode("utf-8", "replace"))
            size += len(part[-1])
            lo += 1
        s = Slice(0, len(part), np.frombuffer(b"".join(part), np.uint8), np.concatenate(([0], np.cumsum([len(p) for p in part]))).astype(np.int64))
        bucket, doc = grams(*characters(s))
        yield bucket, doc + first


def log_ratios(texts: list[str], y: np.ndarray, least: int = LEAST_TEXTS) -> np.ndarray:
    """The naive Bayes log-count ratio of every bucket, 0 where fewer than least texts have it."""
    n = np.zeros((2, BUCKETS), dtype=np.int64)
    for bucket, doc in text_grams(texts):
        for c in (0, 1):
            n[c] += np.bincount(bucket[y[doc] == c], minlength=BUCKETS)
    q, p = n
    r = np.log((1 + p) / (BUCKETS + p.sum())) - np.log((1 + q) / (BUCKETS + q.sum()))
    return np.where(p + q >= least, r, 0.0)


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def fit(texts: list[str], y: np.ndarray, passes: int = PASSES) -> tuple[np.ndarray, float]:
    """Weight of every bucket (ratio times learned weight) and bias."""
    r = log_ratios(texts, y)
    r[np.abs(r) < LEAST_RATIO] = 0.0
    useful = r != 0
    parts = [(bucket[useful[bucket]], doc[useful[bucket]]) for bucket, doc in text_grams(texts)]
    bucket, doc = (np.concatenate([p[k] for p in parts]) for k in range(2))
    ids, col = np.unique(bucket, return_inverse=True)
    r = np.append(r[ids], 1.0)                                           # the last feature is the bias
    share = np.where(y == 1, 0.5 / (y == 1).sum(), 0.5 / (y == 0).sum())     # classes weigh the same

    def forward(w):
        return np.bincount(doc, weights=(w * r)[col], minlength=len(y)) + w[-1]

    def backward(e):
        return np.append(np.bincount(col, weights=e[doc], minlength=len(ids)), e.sum()) * r

    v = np.ones(len(r))
    for _ in range(20):                                                  # the largest eigenvalue bounds the curvature
        v = backward(share * forward(v / np.linalg.norm(v)))
    step = 1 / (0.25 * 1.05 * np.linalg.norm(v))
    limit = np.append(np.full(len(ids), PENALTY * step), 0.0)
    w = ahead = np.zeros(len(r))
    t = 1.0
    for _ in range(passes):                                              # accelerated proximal gradient
        z = ahead - step * backward((sigmoid(forward(ahead)) - y) * share)
        new, t0 = np.sign(z) * np.maximum(np.abs(z) - limit, 0), t
        t = (1 + np.sqrt(1 + 4 * t * t)) / 2
        w, ahead = new, new + (t0 - 1) / t * (new - w)
    weights = np.zeros(BUCKETS, dtype=np.float32)
    weights[ids] = (w * r)[:-1]
    return weights, float(w[-1])


def held_out(doc_id: Column, folds: int = 3, fold: int = 1) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == fold, F.lit(False))


def training_texts(docs: DataFrame, labels: DataFrame, label_col: str, per_class: int, max_bytes: int) -> tuple[list[str], np.ndarray]:
    """Bounded sample of labelled texts outside the held-out fold: ids are picked
    first, so only the picked texts travel."""
    train = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).filter(~held_out(F.col("doc_id"))) \
        .filter(F.col("doc_id").isNotNull() & (F.octet_length("text") <= max_bytes))
    marks = labels.select("doc_id", F.col(label_col).cast("int").alias("y")).filter("y in (0, 1)").distinct()
    rows = materialize(train.select("doc_id").distinct().join(marks, "doc_id"))
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    classes = [rows.filter(F.col("y") == y).orderBy(*order).limit(per_class) for y in (1, 0)]
    chosen = classes[0].unionByName(classes[1])      # at most 2 * per_class rows
    found = train.join(F.broadcast(chosen), "doc_id").groupBy("y", "doc_id").agg(F.min("text").alias("text")).orderBy(*order, "y").collect()
    return [r.text for r in found], np.array([r.y for r in found], dtype=np.int64)


def score_batches(weights: np.ndarray | None, bias: float):
    """mapInArrow function: (doc_id, held_out, text) -> doc_id, held_out, score."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        useful = None if weights is None else weights != 0
        for b in batches:
            for s in slices(b.column("text"), SCORE_BYTES):
                n, score = s.hi - s.lo, np.full(s.hi - s.lo, 0.5)
                if weights is not None:
                    bucket, doc = grams(*characters(s), useful)
                    score = sigmoid(np.bincount(doc, weights=weights[bucket], minlength=n) + bias)
                yield pa.RecordBatch.from_arrays([b.column("doc_id").slice(s.lo, n), b.column("held_out").slice(s.lo, n), pa.array(score)],
                                                 names=["doc_id", "held_out", "score"])
    return run


def classify(docs: DataFrame, labels: DataFrame, label_col: str = "toxic", threshold: float = 0.7,
             per_class: int = TRAIN_DOCS, max_bytes: int = TRAIN_BYTES, passes: int = PASSES) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted."""
    texts, y = training_texts(docs, labels, label_col, per_class, max_bytes)
    weights, bias = fit(texts, y, passes) if len(set(y.tolist())) == 2 else (None, 0.0)
    scored = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text").mapInArrow(
        score_batches(weights, bias), "doc_id long, held_out boolean, score double")
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
