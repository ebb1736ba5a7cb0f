"""Op 4: substring dedup by hashing paragraphs, built from units of one sentence or line.

A text is cut after every run of sentence ends (``.``, ``!``, ``?``) and newlines; a
part of at least ``unit_words`` words is a unit. Units are normalised (A-Z in
lower case, single spaces), digested to 128 bits and grouped over all documents.
Of each digest the occurrence that ranks first (smallest doc_id, then place of the row,
then offset) stays. Consecutive units of a document that all repeat an earlier one
form a run; a run of at least ``run_words`` words is a repeated paragraph and becomes a span
with its offsets (code points) in the original text. So a passage is found wherever it
stands in a line or paragraph, and however it is wrapped between its sentences; single repeated
sentences stay. The first occurrence of a unit is never part of a span.

Skew: only digests and positions are shuffled; the first occurrence is a
partially aggregated minimum, and units meet the written table of repeated
digests in a plain equi-join that adaptive execution splits at a hot unit. Runs
are formed within one document.

Nulls and edges: a null or empty text has no units; a null doc_id ranks last;
repeated rows rank by their place in the table, so one of them keeps its units and every
other one has its own spans; words are separated by ASCII white space only (U+00A0 is part of a
word); extra columns are ignored by the search and kept by the removal; an empty table gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .text import lookup_table, written

#: Words of the smallest unit and of the smallest run that is cut.
UNIT_WORDS, RUN_WORDS = 6, 30
UNIT = r"[^.!?\n]*[.!?\n]+|[^.!?\n]+"
_UNIT, _WORD = re.compile(UNIT), re.compile(r"[^\x20\x09-\x0D]+")
_SIGN = 1 << 63
_COLUMNS = ("nth", "start", "length", "words", "d1", "d2")


def units(text: str, unit_words: int = UNIT_WORDS) -> Iterator[tuple[int, int, int, int]]:
    """(start, length, words, digest) of every unit of a text."""
    for m in _UNIT.finditer(text):
        words = _WORD.findall(m.group())
        if len(words) >= unit_words:
            norm = " ".join(words).encode("utf-8", "replace").lower()      # of bytes: A-Z only
            yield m.start(), m.end() - m.start(), len(words), xxhash.xxh3_128_intdigest(norm)


def unit_batches(unit_words: int):
    """mapInArrow function: (doc_id, row_id, text) -> one row per unit (nth from 1), and
    one per document (nth 0) with its words and length."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at, out = [], {k: [] for k in _COLUMNS}

            def put(i, *values):
                at.append(i)
                for k, v in zip(_COLUMNS, values):
                    out[k].append(v)
            for i, text in enumerate(b.column("text")):
                text = text.as_py() or ""
                put(i, 0, 0, len(text), len(_WORD.findall(text)), None, None)
                for nth, (start, length, words, digest) in enumerate(units(text, unit_words), 1):
                    put(i, nth, start, length, words, (digest >> 64) - _SIGN, (digest & (2 * _SIGN - 1)) - _SIGN)
            own = pa.array(at, pa.int64())
            yield pa.RecordBatch.from_arrays([b.column("doc_id").take(own), b.column("row_id").take(own),
                                              *(pa.array(v, pa.int64()) for v in out.values())], names=["doc_id", "row_id", *out])
    return run


def numbered(docs: DataFrame) -> DataFrame:
    """docs written once with row_id, the place of a row; repeated rows stay apart."""
    return written(docs.drop("row_id").withColumn("row_id", F.monotonically_increasing_id()))


def unit_table(docs: DataFrame, unit_words: int = UNIT_WORDS) -> DataFrame:
    """The written table of documents and units: doc_id, row_id, nth, start, length, words, d1, d2."""
    row_id = F.col("row_id") if "row_id" in docs.columns else F.monotonically_increasing_id()
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), row_id.alias("row_id"), "text")
    return written(rows.mapInArrow(unit_batches(unit_words), "doc_id long, row_id long, " + ", ".join(f"{c} long" for c in _COLUMNS)))


def repeated_spans(table: DataFrame, run_words: int = RUN_WORDS) -> DataFrame:
    """One row per span of a unit table: doc_id, row_id, start, length, words, n_units, and
    first_doc_id, the document that keeps its first unit."""
    found = table.filter("nth > 0")
    rank = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row_id", "start")
    first = found.groupBy("d1", "d2").agg(F.min(rank).alias("first"), F.count("*").alias("n")).filter("n > 1")
    first = lookup_table(first.select("d1", "d2", F.col("first.doc_id").alias("first_doc_id"), F.col("first.row_id").alias("first_row"),
                                      F.col("first.start").alias("first_start")))
    again = found.join(first, ["d1", "d2"]).filter("row_id <> first_row or start <> first_start")
    # Consecutive numbers have the same distance to their rank in the document.
    run = again.withColumn("run", F.col("nth") - F.row_number().over(Window.partitionBy("row_id").orderBy("nth")))
    return run.groupBy("row_id", "run").agg(
        F.first("doc_id").alias("doc_id"), F.min("start").alias("start"), F.max(F.col("start") + F.col("length")).alias("end"),
        F.sum("words").alias("words"), F.count("*").alias("n_units"), F.min_by("first_doc_id", "nth").alias("first_doc_id")).filter(
        F.col("words") >= run_words).select(
        "doc_id", "row_id", "start", (F.col("end") - F.col("start")).alias("length"), "words", "n_units", "first_doc_id")


def document_spans(table: DataFrame, run_words: int = RUN_WORDS) -> DataFrame:
    """One row per document: doc_id, row_id, n_words, n_spans, removed_words, removed_chars,
    changed, and spans as text (start:length:first_doc_id, by start)."""
    name = F.concat_ws(":", "start", "length", F.coalesce(F.col("first_doc_id").cast("string"), F.lit("-")))
    spans = repeated_spans(table, run_words).groupBy("row_id").agg(
        F.count("*").alias("n_spans"), F.sum("words").alias("removed_words"), F.sum("length").alias("removed_chars"),
        F.sort_array(F.collect_list(F.struct("start", name.alias("name")))).alias("names"))
    docs = table.filter("nth = 0").select("doc_id", "row_id", F.col("words").alias("n_words"))
    count = [F.coalesce(c, F.lit(0)).alias(c) for c in ("n_spans", "removed_words", "removed_chars")]
    return docs.join(spans.hint("rebalance"), "row_id", "left").select(
        "doc_id", "row_id", "n_words", *count, F.col("n_spans").isNotNull().alias("changed"),
        F.coalesce(F.array_join(F.transform("names", lambda x: x["name"]), " "), F.lit("")).alias("spans"))


def cut_spans(text: str | None, spans: list[tuple[int, int]]) -> str | None:
    """text without the spans (start, length)."""
    if text is None or not spans:
        return text
    out, at = [], 0
    for start, length in sorted(spans):
        out.append(text[at:start])
        at = start + length
    out.append(text[at:])
    return "".join(out)


def remove_spans(docs: DataFrame, spans: DataFrame) -> DataFrame:
    """The numbered docs with their spans cut out of the texts; row_id tells repeated rows apart."""
    per_row = spans.groupBy(F.col("row_id").alias("__id")).agg(F.collect_set(F.struct("start", "length")).alias("__cut"))
    joined = docs.select(F.struct(*docs.columns).alias("__row"), F.col("row_id").alias("__id")).join(lookup_table(per_row), "__id", "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            row = b.column("__row")
            at = row.type.get_field_index("text")
            text = [cut_spans(t, [(x["start"], x["length"]) for x in c or ()])
                    for t, c in zip(row.field(at).to_pylist(), b.column("__cut").to_pylist())]
            arrays = [pa.array(text, row.type[i].type) if i == at else row.field(i) for i in range(row.type.num_fields)]
            yield pa.RecordBatch.from_arrays(arrays, names=[f.name for f in row.type])
    return joined.mapInArrow(run, docs.schema)


def dedup(docs: DataFrame, unit_words: int = UNIT_WORDS, run_words: int = RUN_WORDS) -> DataFrame:
    """docs without the spans that repeat earlier ranked text."""
    rows = numbered(docs)
    return remove_spans(rows, repeated_spans(unit_table(rows, unit_words), run_words)).select(*docs.columns)
