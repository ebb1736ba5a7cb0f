import hashlib
import zlib

import duckdb
import pandas as pd
from pickwise.llm import merkle, sql

from .helpers import documents, odd_rows, prose

COLUMNS = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row, lower=False):
    text = row["text"]
    if lower and text is not None:
        text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    values = [row["doc_id"], row["source"], row["lang"], row["n_chars"], text]
    return H(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def climb(nodes):
    """Per node its list of (left, right), and the root."""
    paths, at, level = [[] for _ in nodes], list(range(len(nodes))), nodes
    while len(level) > 1:
        for i, p in enumerate(at):
            lo, hi = p // 16 * 16, min(p // 16 * 16 + 16, len(level))
            paths[i].append(("".join(level[lo:p]), "".join(level[p + 1:hi])))
        level = [H(*level[k:k + 16]) for k in range(0, len(level), 16)]
        at = [p // 16 for p in at]
    return paths, level[0]


def by_force(docs):
    rows = [r.asDict() for r in docs.select("doc_id", "source", "lang", "n_chars", "text").collect()]
    groups = {}
    for r in rows:
        groups.setdefault(r["source"], []).append(r)
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    order = {s: sorted(groups[s], key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf(r))) for s in names}
    trees = {s: climb([leaf(r) for r in order[s]]) for s in names}
    top, root = climb([trees[s][1] for s in names])
    out = []
    for s, above in zip(names, top):
        for r, path in zip(order[s], trees[s][0]):
            tampered = r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0
            h = leaf(r, tampered)
            for left, right in path + above:
                h = H(left, h, right)
            out.append((r["doc_id"], leaf(r), trees[s][1], root, H(*[x + y for x, y in path + above]), h, h == root))
    return sorted(out, key=repr)


def run(docs):
    out = merkle.manifest(docs)
    assert out.columns == COLUMNS
    return sorted((tuple(r) for r in out.collect()), key=repr)


def many(n, sources):
    """Sparse, dense and negative ids; a source with one row; one of more than 16 * 16."""
    rows = [(i * (1 if i % 3 else 977_777_777_777) * (-1 if i % 7 == 0 else 1), f"Text {i} É", f"src{i % sources if i % 2 else 0}") for i in range(n)]
    return rows + [(5, "alone", "zz"), (-(1 << 63), "least", "src0"), ((1 << 63) - 1, "most", "src0")]


def test_equals_brute_force(spark):
    docs = documents(spark, many(700, 20), clash=True).repartition(7)
    assert run(docs) == by_force(docs)


def test_more_sources_than_a_run(spark):
    docs = documents(spark, [(i, f"A{i}", f"s{i}") for i in range(300)])
    assert run(docs) == by_force(docs)


def test_repeated_and_null_ids(spark):
    rows = odd_rows() + [(7, prose(i % 20, 5), "a") for i in range(60)] + [(None, f"N{i % 5}", None) for i in range(40)]
    rows += [(64 * i + 7, "X", "a") for i in range(30)]
    docs = documents(spark, rows, clash=True).repartition(5)
    found = run(docs)
    assert found == by_force(docs)
    assert any(r[-1] for r in found) and not all(r[-1] for r in found)


def test_one_row_and_empty_table(spark):
    one = documents(spark, [(3, "Only", None)])
    assert run(one) == by_force(one) and run(one)[0][1] == run(one)[0][3]
    assert run(documents(spark, [])) == []


def test_sql(spark):
    docs = documents(spark, many(500, 30))
    con = duckdb.connect()
    con.register("documents", pd.DataFrame(docs.toPandas().astype({"doc_id": "Int64", "n_chars": "Int64"})))
    got = con.sql(sql.OP13)
    assert got.columns == COLUMNS
    assert sorted(got.fetchall(), key=repr) == run(docs)
