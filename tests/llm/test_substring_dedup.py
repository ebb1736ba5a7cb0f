import re

import duckdb
import pandas as pd
from pickwise.llm import sql, substring_dedup as sd

from .helpers import CLASH, documents, odd_rows, prose

WORD = re.compile(r"[^ \t\n\v\f\r]+")


def parts(text, unit_words):
    """(start, end, words, normal form) of the units, character by character."""
    out, begin = [], 0
    for i in range(len(text)):
        ends = text[i] in ".!?\n"
        if i + 1 == len(text) or (ends and text[i + 1] not in ".!?\n"):
            words = WORD.findall(text[begin:i + 1])
            if len(words) >= unit_words:
                low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in " ".join(words))
                out.append((begin, i + 1, len(words), low))
            begin = i + 1
    return out


def by_force(rows, unit_words=sd.UNIT_WORDS, run_words=sd.RUN_WORDS):
    """Per row in place the list of (start, length, first doc)."""
    order = sorted(range(len(rows)), key=lambda k: (rows[k][0] is None, rows[k][0] or 0, k))
    first, out = {}, [[] for _ in rows]
    for k in order:
        run = []
        for start, end, words, norm in [*parts(rows[k][1] or "", unit_words), (0, 0, 0, None)]:
            if norm is not None and norm in first:
                run.append((start, end, words, first[norm]))
                continue
            if sum(r[2] for r in run) >= run_words and run:
                out[k].append((run[0][0], run[-1][1] - run[0][0], run[0][3]))
            run = []
            if norm is not None:
                first[norm] = rows[k][0]
    return out


def found(docs, unit_words=sd.UNIT_WORDS, run_words=sd.RUN_WORDS):
    got = sd.document_spans(sd.unit_table(docs, unit_words), run_words).orderBy("row_id").collect()
    spans = [[tuple(None if v == "-" else int(v) for v in s.split(":")) for s in r.spans.split()] for r in got]
    for r, s in zip(got, spans):
        assert r.n_spans == len(s) and r.changed == bool(s) and r.removed_chars == sum(x[1] for x in s)
    return spans


def sentences(seed, n, words=9):
    return " ".join(prose(seed * 1000 + i, words).capitalize() + ".!?"[i % 3] for i in range(n))


def planted():
    passage = sentences(77, 7)                    # 63 words, inside longer lines, wrapped anew, in capitals
    wrapped = passage.replace(". ", ".\n").replace("! ", "!\n\n  ")
    rows = []
    for i in range(120, 0, -1):
        form = [passage, passage.upper(), wrapped, f"{passage} {passage}"][i % 4]
        rows.append((i, f"{sentences(i, 3)} {form} {sentences(500 + i, 2)}\n{sentences(1000 + i // 2, 2)}", "s"))
    return rows


def test_spans_equal_brute_force(spark):
    rows = planted() + odd_rows() + [(None, sentences(77, 7), "s"), (300, sentences(77, 4) + " x", "s")]
    docs = documents(spark, rows, clash=True).drop("row_id").coalesce(1)
    assert found(docs) == by_force(rows)
    assert found(docs, 1, 1) == by_force(rows, 1, 1)
    assert sum(map(bool, by_force(rows))) > 110


def test_no_break_space_is_part_of_a_word(spark):
    a = "one two three four five six seven." * 6
    rows = [(1, a, "s"), (2, a.replace(" ", " "), "s"), (3, a, "s")]
    assert found(documents(spark, rows).coalesce(1), 3, 10) == by_force(rows, 3, 10)


def test_removal_keeps_first_occurrences_of_repeated_and_null_ids(spark):
    text = sentences(5, 8)
    rows = [(6, text, "s"), (6, text, "s"), (None, text, "t"), (None, sentences(6, 8), "t"), (None, sentences(6, 8), "t"), (1, None, "s")]
    docs = documents(spark, rows, clash=True)
    out = sd.dedup(docs)
    assert out.columns == docs.columns and set(CLASH) <= set(out.columns)
    texts = sorted((r.text for r in out.collect() if r.text), key=len)
    assert sorted(texts) == sorted([text, sentences(6, 8)]) and out.count() == len(rows)
    assert [r.text for r in out.filter("doc_id = 1").collect()] == [None]


def test_removal_equals_brute_force(spark):
    rows = planted()
    docs = documents(spark, rows).coalesce(1)
    want = {r[0]: sd.cut_spans(r[1], [s[:2] for s in spans]) for r, spans in zip(rows, by_force(rows))}
    assert {r.doc_id: r.text for r in sd.dedup(docs).collect()} == want
    assert sum(sentences(77, 7).upper() in t.upper() for t in want.values()) == 1


def test_cut_spans():
    assert sd.cut_spans("ab\ncd\nef", [(3, 3)]) == "ab\nef"
    assert sd.cut_spans("abcd", [(2, 2), (0, 1)]) == "b" and sd.cut_spans(None, []) is None


def test_sql(spark):
    rows = [r for r in planted() if r[0] % 3] + [r for r in odd_rows() if r[0]] + [(300, sentences(77, 4) + " xİ", "s")]
    docs = documents(spark, rows).coalesce(1)
    con = duckdb.connect()
    con.register("documents", pd.DataFrame(rows, columns=["doc_id", "text", "source"]))
    got = sd.document_spans(sd.unit_table(docs)).drop("row_id")
    assert con.sql(sql.OP4).columns == got.columns
    assert sorted(con.sql(sql.OP4).fetchall(), key=repr) == sorted((tuple(r) for r in got.collect()), key=repr)


def test_empty_table(spark):
    assert found(documents(spark, [])) == [] and sd.dedup(documents(spark, [])).collect() == []
