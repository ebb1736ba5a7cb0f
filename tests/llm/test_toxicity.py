import math
import zlib

import numpy as np
from pickwise.llm import toxicity as tx
from pickwise.llm.text import Slice

from .helpers import documents, odd_rows, prose

BAD = ("grobian", "fiend", "wretch", "vermin")


def as_slice(texts):
    raw = [t if isinstance(t, bytes) else t.encode() for t in texts]
    return Slice(0, len(raw), np.frombuffer(b"".join(raw), np.uint8), np.concatenate(([0], np.cumsum([len(r) for r in raw]))).astype(np.int64))


def buckets(text):
    """The buckets of a text's n-grams, character by character."""
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else " " if c in "\t\n\v\f\r" else c for c in f" {text} ")
    mask, out = (1 << 64) - 1, set()
    for n in tx.GRAMS:
        for i in range(len(low) - n + 1):
            h = 0
            for c in low[i:i + n]:
                h = (h * int(tx._STEP) + ord(c) + 1) & mask
            h = (h * int(tx._MULTIPLIER)) & mask
            out.add((((h ^ (h >> 29)) * int(tx._MULTIPLIER)) & mask) >> (64 - tx.BUCKETS.bit_length() + 1))
    return out


def corpus(n=300):
    rows, marks = [], []
    for i in range(n):
        words = prose(i, 10 + i % 90).split()
        toxic = i % 3 == 0
        if toxic:
            words[i % len(words)] = BAD[i // 3 % 4].upper() if i % 2 else BAD[i // 3 % 4]
        rows.append((i, " ".join(words), "s"))
        marks.append((i, i % 2, int(toxic)))
    return rows, marks


def labels(spark, marks):
    return spark.createDataFrame(marks, "doc_id long, quality int, toxic int")


def test_grams_equal_brute_force():
    texts = ["Ab\tc é ab", "", "x", "ünïcode \U0001f600\U0001f600", prose(3, 200), "aaaaaaaa"]
    bucket, doc = tx.grams(*tx.characters(as_slice(texts)))
    for k, t in enumerate(texts):
        got = bucket[doc == k].tolist()
        assert len(got) == len(set(got)) and set(got) == buckets(t)


def test_bytes_that_are_not_utf8():
    bucket, doc = tx.grams(*tx.characters(as_slice([b"ab\xff\xfecd", b"plain"])))
    assert set(bucket[doc == 1].tolist()) == buckets("plain") and set(bucket[doc == 0].tolist()) == buckets("ab��cd")


def test_ratios_equal_brute_force():
    texts, y = ["abc", "abcd", "abx", "zbc"] * 2, np.array([1, 1, 0, 0] * 2)
    r = tx.log_ratios(texts, y, 2)
    sets = [buckets(t) for t in texts]
    p, q = (sum((list(s) for s, k in zip(sets, y) if k == c), []) for c in (1, 0))
    for b in set().union(*sets):
        if p.count(b) + q.count(b) >= 2:
            assert math.isclose(r[b], math.log((1 + p.count(b)) / (tx.BUCKETS + len(p))) - math.log((1 + q.count(b)) / (tx.BUCKETS + len(q))))
        else:
            assert r[b] == 0


def test_scores_are_those_of_the_fitted_weights(spark):
    rows, marks = corpus()
    docs = documents(spark, rows, clash=True).repartition(5)
    out = {r.doc_id: r for r in tx.classify(docs, labels(spark, marks)).collect()}
    texts, y = tx.training_texts(docs, labels(spark, marks), "toxic", tx.TRAIN_DOCS, tx.TRAIN_BYTES)
    assert len(texts) == sum(zlib.crc32(str(i).encode()) % 3 != 1 for i in range(300))
    weights, bias = tx.fit(texts, y)
    for i, text, _ in rows[::7]:
        z = bias + sum(float(weights[b]) for b in buckets(text))
        assert math.isclose(out[i].score, 1 / (1 + math.exp(-z)), rel_tol=1e-4, abs_tol=1e-6)
    held = [r for r in out.values() if r.held_out]
    assert {r.doc_id for r in held} == {i for i in range(300) if zlib.crc32(str(i).encode()) % 3 == 1}
    assert all(r.predicted == int(r.score >= 0.7) for r in out.values())
    right = sum((r.doc_id % 3 == 0) == (r.predicted == 1) for r in held)
    assert right >= 0.97 * len(held)


def test_held_out_labels_have_no_effect(spark):
    rows, marks = corpus(120)
    flipped = [(i, q, 1 - t if zlib.crc32(str(i).encode()) % 3 == 1 else t) for i, q, t in marks]
    docs = documents(spark, rows)
    first, second = ({r.doc_id: r.score for r in tx.classify(docs, labels(spark, m), passes=5).collect()} for m in (marks, flipped))
    assert first == second


def test_one_word_in_a_long_text(spark):
    rows, marks = corpus()
    rows += [(1000, prose(9, 15000) + " vermin " + prose(10, 15000), "s"), (1001, prose(11, 30000), "s")]
    out = {r.doc_id: r.predicted for r in tx.classify(documents(spark, rows), labels(spark, marks)).collect()}
    assert out[1000] == 1 and out[1001] == 0


def test_odd_rows_and_labels(spark):
    rows, marks = corpus(90)
    rows = [(100 + i, t, s) for i, t, s in rows] + odd_rows()
    marks = [(100 + i, q, t) for i, q, t in marks] + [(100, 1, None), (6, 1, 7), (None, 1, 1), (4, 0, 0), (4, 1, 1)]
    out = tx.classify(documents(spark, rows, clash=True), labels(spark, marks)).collect()
    assert len(out) == len(rows) and all(0 <= r.score <= 1 and r.held_out is not None for r in out)
    empty = {r.score for r in out if r.doc_id in (1, 2)}
    assert len(empty) == 1


def test_no_labels_and_empty_table(spark):
    rows, marks = corpus(20)
    docs = documents(spark, rows)
    for m in ([], [(0, 1, 1)]):
        assert {r.score for r in tx.classify(docs, labels(spark, m)).collect()} == {0.5}
    assert tx.classify(documents(spark, []), labels(spark, marks)).collect() == []
