"""The pipeline as a chain: every stage's written output against plain Python or SQL on
its own input."""

import glob
import os
import tempfile
import zlib

import corpus_pipeline
import duckdb
import numpy as np
import pandas as pd
import pytest
from pickwise.llm import mixing, quality_rules, sql
from pyspark.sql import functions as F

from .helpers import CLASH, documents, odd_rows, prose
from .test_minhash import classes_by_force, edited
from .test_packing import reference_ids
from .test_quality_rules import by_force as base_counts

pytest.importorskip("public_tokenizers")


def corpus():
    rows, i = [], 0
    for g in range(60):
        base = "\n".join(prose(100 * g + k, 40) for k in range(3))
        copies = [base] * (1 + g % 3) + ([edited(base.replace("\n", " "), 1, g)] if g % 4 == 0 else [])
        for c in copies:
            footer = "read our terms and the notice of privacy here" if g % 2 else "own words %d" % i
            rows.append((i, f"{c}\n{footer}", f"site{i % 14}"))
            i += 1
    return rows + [(500 + k, "short text", "site0") for k in range(3)] + [(600, "same words here " * 90, "site1")]


def run_stages(spark, docs):
    """The input and output of every stage of run()."""
    folder = tempfile.mkdtemp(prefix="pw-pipe-")
    docs.write.parquet(f"{folder}/documents.parquet")
    seen = set(glob.glob(f"{spark.sparkContext.getCheckpointDir().removeprefix('file:')}/pipeline-*"))
    last = corpus_pipeline.run(spark, folder)
    new = set(glob.glob(f"{spark.sparkContext.getCheckpointDir().removeprefix('file:')}/pipeline-*")) - seen
    assert len(new) == 1
    outs = [spark.read.parquet(f"{folder}/documents.parquet")]
    outs += [spark.read.parquet(os.path.join(*new, f"{k}-{name}")) for k, (name, _) in enumerate(corpus_pipeline.STAGES)]
    assert sorted(map(tuple, last.collect()), key=repr) == sorted(map(tuple, outs[-1].collect()), key=repr)
    return outs


def rows_of(df):
    return sorted(((r.doc_id, r.text, r.source) for r in df.collect()), key=repr)


def by_duckdb(query, df):
    con = duckdb.connect()
    con.register("documents", pd.DataFrame(rows_of(df), columns=["doc_id", "text", "source"]).astype({"doc_id": "Int64"}))
    return con.sql(query).df()


def test_every_stage_equals_brute_force(spark):
    raw, good, clean, single, mixed, packed = run_stages(spark, documents(spark, corpus()).repartition(4))
    # 1: base rules by force; what they pass, the bands decide.
    verdict = {r.doc_id: r.kept for r in quality_rules.quality_rules(raw).collect()}
    for i, text, _ in rows_of(raw):
        n, _, _, _, repeated = base_counts(text)
        assert not verdict[i] or (n >= 20 and 100 * repeated <= 30 * n)
    assert rows_of(good) == [r for r in rows_of(raw) if verdict[r[0]]] and 0 < good.count() < raw.count()
    # 2: the SQL of line dedup.
    want = by_duckdb(sql.OP2, good)
    assert {r[0]: r[1] for r in rows_of(clean)} == dict(zip(want.doc_id, want.text)) and want.n_removed.sum() > 20
    # 3: one document of every class by brute force.
    classes = classes_by_force(rows_of(clean))
    kept = [r[0] for r in rows_of(single)]
    assert sorted(classes[i] for i in kept) == sorted(set(classes.values())) and len(kept) < clean.count()
    assert set(rows_of(single)) <= set(rows_of(clean))
    # 4: the SQL of mixing says how many words of each document are taken.
    want = by_duckdb(sql.OP8, single)
    size, taken = dict(zip(want.doc_id, want["size"])), dict(zip(want.doc_id, want.taken))
    got = {}
    for i, text, _ in rows_of(mixed):
        got[i] = got.get(i, 0) + len((text or "").split())
        assert 0 < len((text or "").split()) <= size[i]
    assert {i: n for i, n in taken.items() if n} == got
    # 5: every id of every document in exactly one piece.
    pieces = {}
    for r in packed.collect():
        pieces.setdefault(r.doc_id, []).append(r)
    ids = {}
    for i, text, _ in rows_of(mixed):
        ids.setdefault(i, []).append(reference_ids(text))
    assert {i: sum(r.length for r in p) for i, p in pieces.items()} == {i: sum(map(len, t)) for i, t in ids.items()}
    whole = {zlib.crc32(np.array(t, dtype="<u4").tobytes()) for ts in ids.values() for t in ts if len(t) <= 4096}
    assert {r.ids_crc32 for p in pieces.values() for r in p if r.length == r.doc_tokens} <= whole
    room = packed.groupBy("sequence_id").agg(F.sum("length").alias("n"), F.max(F.col("offset") + F.col("length")).alias("end")).collect()
    assert all(r.n == r.end <= 4096 for r in room)


def test_columns_odd_rows_and_clashing_names(spark):
    docs = documents(spark, odd_rows() + corpus()[:40], clash=True)
    outs = run_stages(spark, docs)
    assert all(o.columns == docs.columns for o in outs[:-1]) and set(CLASH) <= set(docs.columns)
    assert all(r.n_chars == len(r.text) for o in outs[2:-1] for r in o.collect() if r.text is not None)
    assert outs[-1].count() > 0


def test_empty_table(spark):
    outs = run_stages(spark, documents(spark, []))
    assert [o.count() for o in outs] == [0] * 6


def test_stage_names_and_weights():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "line_dedup", "near_duplicates", "mixing", "packing"]
    assert mixing.SYMBOLS
