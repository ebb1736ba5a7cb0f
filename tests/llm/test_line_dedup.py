import duckdb
import pandas as pd
from pickwise.llm import line_dedup, sql

from .helpers import documents, odd_rows, prose


def by_sql(docs):
    con = duckdb.connect()
    con.register("documents", pd.DataFrame(docs.select("doc_id", "text", "source").toPandas().astype({"doc_id": "Int64"})))
    return sorted(con.sql(sql.OP2).fetchall(), key=repr)


def run(docs, **options):
    out = line_dedup.dedup_lines(docs, **options)
    return sorted((tuple(r) for r in out.select("doc_id", "n_lines", "n_removed", "removed_chars", "text").collect()), key=repr)


def test_boilerplate_by_distinct_sites(spark):
    rows, i = [], 0
    for site in range(14):
        for c in range(3):
            lines = [prose(i, 30), "  All rights reserved. \r" if site < 11 else "x", "Near" if site < 9 else "y", prose(i + 1000, 20), "Edge" if site < 10 else ""]
            rows.append((i, "\n".join(lines), f"s{site}"))
            i += 1
    rows += [(i + k, "copied whole\n" + prose(5, 50), f"s{k}") for k in range(12)]      # copies are left whole
    docs = documents(spark, rows)
    out = run(docs)
    assert out == by_sql(docs)
    removed = {r[0]: r[2] for r in out}
    assert removed[0] == 2 and removed[27] == 2 and removed[30] == 1 and removed[41] == 0 and removed[i] == 0


def test_boilerplate_that_outweighs_the_text_is_removed(spark):
    menu = prose(1, 60)
    rows = [(s, f"{menu}\nown {s}\n{menu}", f"site{s}") for s in range(12)] + [(99, f"{menu}\n\n{menu}", "site0")]
    out = {r.doc_id: r for r in line_dedup.dedup_lines(documents(spark, rows)).collect()}
    assert all(out[s].text == f"own {s}" and out[s].n_removed == 2 and not out[s].left_whole for s in range(12))
    assert out[99].text == rows[-1][1] and out[99].n_removed == 0 and out[99].left_whole     # nothing of its own
    docs = documents(spark, rows)
    assert run(docs) == by_sql(docs)


def test_exact_counts_near_the_threshold(spark):
    rows = [(s, f"line {n}\n" + prose(s, 9), f"site{s}") for n in range(97, 104) for s in range(n)]
    lines = line_dedup.line_table(documents(spark, rows))
    bad = line_dedup.boilerplate(lines, min_sites=100, lg_k=4, margin=0.9)
    assert bad.count() == 4


def test_odd_rows_and_clashing_columns(spark):
    docs = documents(spark, odd_rows(), clash=True)
    out = line_dedup.dedup_lines(docs, min_sites=2)
    assert out.count() == len(odd_rows()) and set(docs.columns) <= set(out.columns)
    null = [r for r in out.collect() if r.doc_id == 1][0]
    assert null.text is None and null.n_lines == 0 and null.n_removed == 0
    assert run(documents(spark, odd_rows())) == by_sql(documents(spark, odd_rows()))


def test_empty_table(spark):
    assert line_dedup.dedup_lines(documents(spark, [])).collect() == []


def test_no_python_in_the_plan(spark):
    plan = line_dedup.dedup_lines(documents(spark, [(1, "a\nb", "s")]))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
