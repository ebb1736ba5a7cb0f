import collections
import math
import random
import re

import duckdb
import pandas as pd
from pickwise.llm import lexical_search as ls, sql

from .helpers import documents, odd_rows, prose

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def split(text):
    return [t.translate(LOWER) for t in TERM.findall(text or "")]


def by_force(rows, items, top=10):
    docs = [(i, split(t)) for i, t, _ in rows]
    N, L = sum(1 for _, t in docs if t), sum(len(t) for _, t in docs)
    df = collections.Counter(t for _, ts in docs for t in set(ts))
    out = []
    for item, text in items:
        query, scored = split(text), []
        for place, (i, ts) in enumerate(docs):
            m = 25 + 75 * len(ts) * N // L if L else 25
            tf = collections.Counter(ts)
            score = sum(math.floor(1000 * math.log((2 * N + 2) / (2 * df[t] + 1))) * (10 ** 9 * tf[t] // (1000 * tf[t] + 8 * m)) for t in query if tf[t])
            if score > 0:
                scored.append((-score, i is None, i or 0, place, i))
        out += [(item, n, x[4], -x[0]) for n, x in enumerate(sorted(scored)[:top], 1)]
    return sorted(out, key=repr)


def benchmark(spark, items):
    return spark.createDataFrame(items, "item_id long, text string")


def run(docs, items, **options):
    return sorted((tuple(r) for r in ls.search(docs, items, **options).select("item_id", "rank", "doc_id", "score").collect()), key=repr)


def corpus(n=400):
    rng = random.Random(5)
    rows = [(i, "the " * rng.randint(0, 4) + prose(i, rng.randint(3, 90), 300) + (", The of!" if i % 2 else ""), "s") for i in range(n)]
    rows += [(n + i, rows[i][1], "s") for i in range(0, min(n, 60), 2)]          # equal texts: ties
    return rows


def queries(rows):
    items = [(k, " ".join(rows[7 * k][1].split()[:25]).upper()) for k in range(30)]
    return items + [(40, "the THE of the"), (41, "nowhere to be found"), (42, ""), (43, None), (44, "the"), (0, items[0][1]), (None, "the of")]


def test_equals_brute_force(spark):
    rows = corpus()
    items = queries(rows)
    docs = documents(spark, rows, clash=True).coalesce(1)
    expected = by_force(rows, items)
    # Many blocks, groups of items and stages; and one of each.
    assert run(docs, benchmark(spark, items), block_docs=37, group_items=7) == expected
    assert run(docs, benchmark(spark, items), block_bytes=1000, shares=(0.01, 0.1, 1.0)) == expected
    assert run(docs, benchmark(spark, items), shares=(1.0,)) == expected


def test_bars_prune_but_lose_nothing(spark):
    rows = corpus(900)
    items = queries(rows)
    docs = documents(spark, rows).coalesce(1)
    assert run(docs, benchmark(spark, items), block_docs=50, shares=(0.02, 0.05, 0.2, 0.5, 1.0), top=3) == by_force(rows, items, 3)


def test_odd_rows(spark):
    rows = odd_rows() + [(9, "ünïcode X ünïcode", "a"), (None, "one", "b"), (4, "one", "b")]
    items = [(1, "one ÜNÏCODE x"), (2, "Ünïcode"), (3, prose(3, 9)), (4, "a b"), (5, "\U0001f600")]
    docs = documents(spark, rows, clash=True).coalesce(1)
    assert run(docs, benchmark(spark, items)) == by_force(rows, items)


def test_empty_tables(spark):
    docs, items = documents(spark, corpus(5)), benchmark(spark, [(1, "the")])
    assert run(documents(spark, []), items) == []
    assert run(documents(spark, [(1, None, "a"), (2, "!?", "a")]), items) == []
    assert run(docs, benchmark(spark, [])) == []


def test_sql(spark):
    rows = corpus(200)
    items = queries(rows)[:-2]
    con = duckdb.connect()
    con.register("documents", pd.DataFrame(rows, columns=["doc_id", "text", "source"]))
    con.register("benchmark", pd.DataFrame(items, columns=["item_id", "text"]))
    got = con.sql(sql.OP12)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(got.fetchall(), key=repr) == by_force(rows, items)
