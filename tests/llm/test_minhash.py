import random

import numpy as np
from pickwise.llm import minhash

from .helpers import documents, odd_rows, prose


def shingles(text):
    w = text.split()
    return set(zip(*(w[i:] for i in range(5)))) if len(w) >= 5 else ({tuple(w)} if w else set())


def classes_by_force(rows):
    ids, parent = [r[0] for r in rows], {r[0]: r[0] for r in rows}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    sets = {r[0]: shingles(r[1]) for r in rows}
    for i, a in enumerate(ids):
        for b in ids[:i]:
            if sets[a] and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                parent[y] = x
    return {i: find(i) for i in ids}


def edited(text, n, seed):
    rng, w = random.Random(seed), text.split()
    for _ in range(n):
        w[rng.randrange(len(w))] = f"new{rng.randrange(10 ** 6)}"
    return " ".join(w)


def test_classes_equal_brute_force(spark):
    rows, i = [], 0
    for g in range(40):
        base = prose(100 + g, 60 + 5 * g)
        for c in range(1 + g % 5):
            rows.append((i, edited(base, c * (1 + g % 3), i) if c else base, "s"))
            i += 1
    for c in range(60):                      # a hot group of copies and one of near copies
        rows += [(i, prose(7, 90), "s"), (i + 1, edited(prose(8, 150), 1, i), "s")]
        i += 2
    got = {r.doc_id: r.class_id for r in minhash.near_duplicates(documents(spark, rows)).collect()}
    assert got == classes_by_force(rows)


def test_links_of_a_large_family_near_the_threshold(spark, monkeypatch):
    monkeypatch.setattr(minhash, "PART_NODES", 64)     # several parts, so pairs across parts count too
    base, rng = prose(9, 300), random.Random(0)
    rows = [(i, edited(base, rng.randint(2, 10), i), "s") for i in range(400)]
    sets = [shingles(r[1]) for r in rows]
    links = [sum(x is not y and len(x & y) >= 0.8 * len(x | y) for y in sets) for x in sets]
    got = {r.doc_id: r for r in minhash.near_duplicates(documents(spark, rows)).collect()}
    assert [got[i].n_links for i in range(400)] == links
    assert {i: r.class_id for i, r in got.items()} == classes_by_force(rows)


def test_overlaps_and_forest_equal_brute_force():
    rng = random.Random(3)
    sets = [sorted({rng.randrange(1, 60) for _ in range(rng.randrange(30))} | {99}) for _ in range(25)]
    w = np.array([e for s in sets for e in s], dtype=np.uint64)
    doc = np.repeat(np.arange(25), [len(s) for s in sets])
    common = np.array([[len(set(a) & set(b)) for b in sets] for a in sets])
    out = minhash.overlaps(w, doc, 25, 25)
    np.fill_diagonal(out, np.diag(common))
    assert (out == common).all() and (minhash.overlaps(w, doc, 25, 9) == common[:9, 9:]).all()
    linked = np.zeros((6, 6), dtype=bool)
    for i, j in ((1, 4), (4, 2), (3, 5)):
        linked[i, j] = linked[j, i] = True
    assert minhash.forest(linked).tolist() == [0, 1, 1, 3, 1, 3]


def test_signatures_estimate_weighted_jaccard():
    rng = np.random.default_rng(0)
    e = rng.integers(1, 1 << 63, 300, dtype=np.uint64)
    wa, wb = rng.uniform(0.2, 9, 300), rng.uniform(0.2, 9, 300)
    true = np.minimum(wa, wb).sum() / np.maximum(wa, wb).sum()
    k = 2048
    sig = minhash.dart_signatures(np.concatenate((e, e)), np.concatenate((wa, wb)), np.repeat([0, 1], 300), 2, k)
    assert (sig != 0).all()
    assert abs((sig[0] == sig[1]).mean() - true) < 4 * np.sqrt(true * (1 - true) / k)


def test_odd_rows_and_clashing_columns(spark):
    rows = odd_rows()
    docs = documents(spark, rows, clash=True)
    out = minhash.near_duplicates(docs).collect()
    assert len(out) == len(rows)
    by = {}
    for r in out:
        by.setdefault(r.doc_id, []).append(r)
    assert {r.class_id for r in by[6] + by[9]} == {6} and by[6][0].class_size == 3
    assert by[1][0].class_size == by[2][0].class_size == 1          # wordless texts stay alone
    kept = minhash.keep_one(docs)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert ids.count(6) == 1 and 9 not in ids and {1, 2, 3, 4, 5, 7, 8} <= set(ids)


def test_empty_table(spark):
    docs = documents(spark, [])
    assert minhash.near_duplicates(docs).collect() == [] and minhash.keep_one(docs).collect() == []


def test_counted_weights(spark):
    rows = [(1, "a b c d e " * 9, "s"), (2, "a b c d e " * 3, "s")]
    one = minhash.near_duplicates(documents(spark, rows), weights="set").select("class_id").distinct().count()
    two = minhash.near_duplicates(documents(spark, rows), weights="count").select("class_id").distinct().count()
    assert (one, two) == (1, 2)
