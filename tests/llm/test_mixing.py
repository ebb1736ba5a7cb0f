import duckdb
import pandas as pd
from pickwise.llm import mixing, sql
from pyspark.sql import functions as F

from .helpers import documents, odd_rows, prose


def run(docs, **options):
    out = mixing.mix_documents(docs, **options).select("doc_id", "size", "source_size", "target", "taken")
    return sorted((tuple(r) for r in out.collect()), key=repr)


def by_sql(docs):
    con = duckdb.connect()
    con.register("documents", docs.select("doc_id", "text", "source").toPandas().astype({"doc_id": "Int64"}))
    return sorted(con.sql(sql.OP8).fetchall(), key=repr)


def water_fill(sizes, share=1.5, cap=2.0):
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    left, target, open_ = share * sum(sizes.values()), dict.fromkeys(sizes, 0.0), set(sizes)
    while open_ and left > 1e-9:
        total = sum(weight[s] for s in open_)
        give = {s: left * weight[s] / total for s in open_}
        left = 0.0
        for s in list(open_):
            target[s] += give[s]
            if target[s] >= cap * sizes[s]:
                left += target[s] - cap * sizes[s]
                target[s] = cap * sizes[s]
                open_.discard(s)
    return target


def test_targets_and_budgets(spark):
    rows = [(i, prose(i, 5 + i % 90), f"s{i % 9}" if i % 3 else "s0") for i in range(900)] + [(5000 + i, prose(i, 30), None) for i in range(20)]
    out = mixing.mix_documents(documents(spark, rows)).collect()
    sizes, taken, target = {}, {}, {}
    source = {r[0]: r[2] for r in rows}
    for r in out:
        s = source[r.doc_id]
        sizes[s] = sizes.get(s, 0) + r["size"]
        taken[s] = taken.get(s, 0) + r.taken
        target[s] = r.target
        assert 0 <= r.taken <= 2 * r["size"]
    want = water_fill(sizes)
    for s in sizes:
        assert abs(target[s] - want[s]) < 1e-6 * want[s] + 1e-6 and abs(taken[s] - target[s]) <= 1
    assert run(documents(spark, rows)) == by_sql(documents(spark, rows)) == run(documents(spark, rows).repartition(7))


def test_rows_of_the_mix(spark):
    rows = [(i, prose(i, 5 + i % 30), f"s{i % 5}") for i in range(300)]
    docs = documents(spark, rows, clash=True)
    out = mixing.mixed_rows(docs)
    assert out.columns == docs.columns
    words = {}
    for r in out.collect():
        words[r.doc_id] = words.get(r.doc_id, 0) + len(r.text.split())
    want = {r.doc_id: r.taken for r in mixing.mix_documents(docs).collect() if r.taken}
    assert words == want


def test_odd_rows(spark):
    docs = documents(spark, odd_rows(), clash=True)
    out = mixing.mix_documents(docs).collect()
    assert len(out) == len(odd_rows())
    assert all(r.taken == 0 for r in out if not r["size"])
    assert run(docs) == by_sql(docs)
    assert mixing.mixed_rows(docs).count() > 0


def test_empty_and_wordless_tables(spark):
    assert run(documents(spark, [])) == []
    assert [r[4] for r in run(documents(spark, [(1, "", "a"), (2, None, None)]))] == [0, 0]


def test_buckets_are_even_for_any_weights(spark):
    # A third of the documents have five or forty symbols a word: their keys are large.
    rows = [(i, prose(i, 8) if i % 3 else ("#####a " if i % 2 else "$" * 40 + "b ") * 8, "s") for i in range(4000)]
    base = mixing.keyed(documents(spark, rows))
    placed = base.join(mixing.decisions(base), "source").select(
        mixing._bucket(F.col("es_key"), F.col("n_buckets"), F.col("n_docs"), F.col("classes")).alias("b"), "es_key", "n_buckets")
    counts = {r.b: r["count"] for r in placed.groupBy("b").count().collect()}
    n = placed.first().n_buckets
    assert min(counts) >= 0 and max(counts) < n and max(counts.values()) < 2 * 4000 / n
    order = [r.b for r in placed.orderBy("es_key").collect()]
    assert order == sorted(order)
    assert run(documents(spark, rows)) == by_sql(documents(spark, rows))
