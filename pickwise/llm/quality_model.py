"""Op 3: quality classifier, a byte-level convolutional network in numpy.

Every byte has a learned embedding; learned filters of ``WIDTH`` bytes slide over
the whole text in steps of ``STRIDE``. The text is covered by overlapping chunks;
each filter is max-pooled over a chunk, and the chunks' pooled values are combined
(their mean and maximum, and how full the first chunk is) by a small dense
layer into one probability that the text is of good quality.

Fitting: a bounded sample of labelled rows (``TRAIN_DOCS`` per class, of texts up to
``TRAIN_BYTES``, smallest hash of the id first) outside the held-out fold is
brought to the driver and fitted with Adam on balanced batches; the weights
(some 20 kB) go to the tasks, which score every whole text in Arrow batches.

Nulls and edges: a null or empty text is one chunk of padding and gets the score
the network gives it; a null doc_id is not held out and has no label; labels
other than 0 and 1 are ignored; an id with both labels counts in both classes,
repeated rows of an id count once, with the smallest text; with no labels
of a class the score is 0.5 throughout; extra columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.reuse import materialize
from .text import Slice, slices

EMBED, WIDTH, STRIDE, FILTERS, HIDDEN = 8, 8, 4, 32, 16
#: Chunk length and step in filter positions (256 bytes, overlapping by 64).
CHUNK, STEP = 64, 48
#: Bounds of the training sample: documents of each class, bytes of one text.
TRAIN_DOCS, TRAIN_BYTES = 2000, 65536
STEPS, BATCH, RATE, SEED = 500, 32, 0.004, 3
#: Short texts are rare in a sample; so many of a batch's texts are trained by an excerpt.
EXCERPTS = 0.25
#: Bytes scored at once.
SCORE_BYTES = 1 << 20


class Layout:
    """Texts laid out for the filters: byte codes in blocks of STRIDE, and the
    positions of every chunk and the chunks of every document."""

    def __init__(self, s: Slice):
        size = np.diff(s.offsets)
        n_pos = np.maximum(1, -(-(size - WIDTH) // STRIDE) + 1)
        first = np.concatenate(([0], np.cumsum(n_pos + WIDTH // STRIDE - 1)))      # in blocks
        self.codes = np.zeros(first[-1] * STRIDE, dtype=np.uint8)
        at = np.arange(len(s.data)) + np.repeat(first[:-1] * STRIDE - s.offsets[:-1], size)
        self.codes[at] = s.data
        n_chunks = np.maximum(1, -(-(n_pos - (CHUNK - STEP)) // STEP))
        self.first_chunk = np.concatenate(([0], np.cumsum(n_chunks)))
        self.doc = np.repeat(np.arange(len(size)), n_chunks)
        nth = np.arange(len(self.doc)) - self.first_chunk[self.doc]
        self.start = first[self.doc] + nth * STEP
        self.end = np.minimum(self.start + CHUNK, first[self.doc] + n_pos[self.doc])


class Network:
    """Weights and the forward and backward passes."""

    def __init__(self, weights: dict[str, np.ndarray] | None = None):
        rng = np.random.default_rng(SEED)
        d = EMBED * STRIDE
        self.w = weights or {
            "embed": rng.normal(0, 0.5, (256, EMBED)), "conv": rng.normal(0, 1 / np.sqrt(2 * d), (WIDTH // STRIDE, d, FILTERS)),
            "bias": np.zeros(FILTERS), "dense": rng.normal(0, 1 / np.sqrt(2 * FILTERS), (2 * FILTERS + 1, HIDDEN)),
            "dense_bias": np.zeros(HIDDEN), "out": rng.normal(0, 1 / np.sqrt(HIDDEN), HIDDEN), "out_bias": np.zeros(1)}
        self.w = {k: v.astype(np.float32) for k, v in self.w.items()}

    def conv(self, lay: Layout) -> tuple[np.ndarray, np.ndarray]:
        x = self.w["embed"][lay.codes].reshape(-1, EMBED * STRIDE)
        taps = len(self.w["conv"])
        out = np.empty((len(x) + 1, FILTERS), dtype=np.float32)   # one spare row ends the last chunk
        out[:] = self.w["bias"]
        for j in range(taps):
            out[:len(x) - j] += x[j:] @ self.w["conv"][j]
        return x, out

    def pool(self, lay: Layout, out: np.ndarray) -> np.ndarray:
        edges = np.stack((lay.start, lay.end), axis=1).ravel()
        return np.maximum.reduceat(out, edges, axis=0)[::2]

    def combine(self, lay: Layout, pooled: np.ndarray) -> tuple:
        act = np.maximum(pooled, 0)
        at = lay.first_chunk[:-1]
        count = np.diff(lay.first_chunk)[:, None].astype(np.float32)
        fill = ((lay.end - lay.start)[at] / CHUNK).astype(np.float32)[:, None]      # of the first chunk
        feats = np.hstack((np.add.reduceat(act, at, axis=0) / count, np.maximum.reduceat(act, at, axis=0), fill))
        hidden = np.maximum(feats @ self.w["dense"] + self.w["dense_bias"], 0)
        return act, feats, hidden, hidden @ self.w["out"] + self.w["out_bias"]

    def scores(self, s: Slice) -> np.ndarray:
        lay = Layout(s)
        logit = self.combine(lay, self.pool(lay, self.conv(lay)[1]))[3]
        return 1 / (1 + np.exp(-np.clip(logit.astype(np.float64), -40, 40)))

    def gradients(self, s: Slice, y: np.ndarray) -> dict[str, np.ndarray]:
        w, lay = self.w, Layout(s)
        x, out = self.conv(lay)
        peak = np.array([a + out[a:b].argmax(axis=0) for a, b in zip(lay.start, lay.end)])     # (chunks, filters)
        f = np.arange(FILTERS)
        pooled = out[peak, f]
        act, feats, hidden, logit = self.combine(lay, pooled)
        d_logit = ((1 / (1 + np.exp(-logit)) - y) / len(y)).astype(np.float32)
        g = {"out": hidden.T @ d_logit, "out_bias": d_logit.sum(keepdims=True)}
        d_hidden = np.outer(d_logit, w["out"]) * (hidden > 0)
        g["dense"], g["dense_bias"] = feats.T @ d_hidden, d_hidden.sum(axis=0)
        d_feats = d_hidden @ w["dense"].T
        count = np.diff(lay.first_chunk)[lay.doc][:, None]
        top = act == feats[lay.doc, FILTERS:2 * FILTERS]
        share = np.add.reduceat(top, lay.first_chunk[:-1], axis=0, dtype=np.int64)[lay.doc]
        d_act = d_feats[lay.doc, :FILTERS] / count + d_feats[lay.doc, FILTERS:2 * FILTERS] * top / np.maximum(share, 1)
        d_act = (d_act * (pooled > 0)).astype(np.float32)
        d_out = np.zeros_like(out)
        np.add.at(d_out, (peak, np.broadcast_to(f, peak.shape)), d_act)
        d_out = d_out[:-1]
        g["bias"] = d_out.sum(axis=0)
        d_x, g["conv"] = np.zeros_like(x), np.empty_like(w["conv"])
        for j in range(len(w["conv"])):
            g["conv"][j] = x[j:].T @ d_out[:len(x) - j]
            d_x[j:] += d_out[:len(x) - j] @ w["conv"][j].T
        d_x = d_x.reshape(-1, EMBED)
        g["embed"] = np.stack([np.bincount(lay.codes, weights=d_x[:, i], minlength=256) for i in range(EMBED)], axis=1)
        return g


def as_slice(texts: list[bytes]) -> Slice:
    return Slice(0, len(texts), np.frombuffer(b"".join(texts), dtype=np.uint8),
                 np.concatenate(([0], np.cumsum([len(t) for t in texts]))).astype(np.int64))


def excerpt(text: bytes, rng: np.random.Generator) -> bytes:
    """Some words in a row of a text (a short text for training)."""
    start = int(rng.integers(max(1, len(text))))
    part = text[start:start + int(rng.integers(20, 400))]
    return b" ".join(part.split()[1:-1]) or text


def fit(good: list[bytes], bad: list[bytes], steps: int = STEPS) -> Network:
    """Adam on batches holding as many good as bad texts."""
    net, rng = Network(), np.random.default_rng(SEED)
    m = {k: np.zeros_like(v) for k, v in net.w.items()}
    v = {k: np.zeros_like(x) for k, x in net.w.items()}
    for t in range(1, steps + 1):
        batch = [good[i] for i in rng.integers(len(good), size=BATCH // 2)] + [bad[i] for i in rng.integers(len(bad), size=BATCH // 2)]
        batch = [excerpt(x, rng) if rng.random() < EXCERPTS else x for x in batch]
        g = net.gradients(as_slice(batch), np.repeat([1.0, 0.0], BATCH // 2))
        rate = RATE * min(1.0, 2 * (1 - t / (steps + 1)))
        for k in net.w:
            d = g[k].astype(np.float32)
            m[k] = 0.9 * m[k] + 0.1 * d
            v[k] = 0.99 * v[k] + 0.01 * d * d
            net.w[k] -= rate * (m[k] / (1 - 0.9 ** t)) / (np.sqrt(v[k] / (1 - 0.99 ** t)) + 1e-8)
    return net


def held_out(doc_id: Column, folds: int = 5, fold: int = 0) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == fold, F.lit(False))


def training_texts(docs: DataFrame, labels: DataFrame, label_col: str, per_class: int, max_bytes: int) -> tuple[list[bytes], list[bytes]]:
    """Bounded sample of texts labelled 1 and 0 outside the held-out fold: ids
    are picked first, so only the picked texts travel."""
    train = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).filter(~held_out(F.col("doc_id"))) \
        .filter(F.col("doc_id").isNotNull() & (F.octet_length("text") <= max_bytes))
    marks = labels.select("doc_id", F.col(label_col).cast("int").alias("y")).filter("y in (0, 1)").distinct()
    rows = materialize(train.select("doc_id").distinct().join(marks, "doc_id"))
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    good, bad = (rows.filter(F.col("y") == y).orderBy(*order).limit(per_class) for y in (1, 0))
    chosen = good.unionByName(bad)      # at most 2 * per_class rows
    texts = train.join(F.broadcast(chosen), "doc_id").groupBy("y", "doc_id").agg(F.min("text").alias("text")).orderBy(*order).collect()
    return tuple([r.text.encode("utf-8", "replace") for r in texts if r.y == y] for y in (1, 0))


def score_batches(weights: dict[str, np.ndarray] | None):
    """mapInArrow function: (doc_id, held_out, text) -> doc_id, held_out, score."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = Network(weights) if weights is not None else None
        for b in batches:
            for s in slices(b.column("text"), SCORE_BYTES):
                n = s.hi - s.lo
                score = net.scores(s) if net else np.full(n, 0.5)
                yield pa.RecordBatch.from_arrays([b.column("doc_id").slice(s.lo, n), b.column("held_out").slice(s.lo, n), pa.array(score)],
                                                 names=["doc_id", "held_out", "score"])
    return run


def classify(docs: DataFrame, labels: DataFrame, label_col: str = "quality", threshold: float = 0.3,
             per_class: int = TRAIN_DOCS, max_bytes: int = TRAIN_BYTES, steps: int = STEPS) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted."""
    good, bad = training_texts(docs, labels, label_col, per_class, max_bytes)
    weights = fit(good, bad, steps).w if good and bad else None
    scored = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text").mapInArrow(
        score_batches(weights), "doc_id long, held_out boolean, score double")
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
