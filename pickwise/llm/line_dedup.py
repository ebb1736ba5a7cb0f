"""Op 2 [native]: line dedup by the spread of a line over distinct sites.

A site is a document's source. Lines (split at newlines) are compared without
surrounding ASCII white space, by two 64-bit hashes. Per line hash a HyperLogLog
sketch of the sites is merged by aggregation; a line whose estimate is clearly
at or above ``min_sites`` is boilerplate, and one whose estimate lies within
``margin`` of it gets an exact distinct count of its sites. Boilerplate lines are
removed from every document that has lines of its own. A document of boilerplate
lines only is a copy, which near-duplicate removal judges as a whole: it is left
as it is and flagged in ``left_whole``.

Skew: sketches and counts are partially aggregated before they are shuffled, and
lines meet the (written) table of boilerplate hashes in a plain equi-join that
adaptive execution can split at a hot line.

Nulls and edges: a null text stays null with 0 lines; blank lines are never
removed; a null source counts as one site; repeated rows are treated alike;
extra columns stay untouched (one named like an output is replaced); an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.reuse import materialize
from .text import lookup_table

#: Distinct sites from which a line is boilerplate.
MIN_SITES = 10
#: Estimates within this share of the threshold are counted exactly; the sketch's
#: relative standard error is 1.04 / sqrt(2 ** LG_K) = 3.3 %, so this is 7 of them.
MARGIN = 0.25
LG_K = 10
BLANK = " \t\r\v\f"


def _lines(text: Column) -> Column:
    return F.split(text, "\n")


def _key(doc: DataFrame) -> list[Column]:
    """What identifies a document when its lines come back: its id and its text."""
    return [F.coalesce(F.col("doc_id"), F.lit(-(1 << 63))).alias("kd"), F.xxhash64("text").alias("kt"),
            F.xxhash64(F.lit(2), "text").alias("ku")]


def line_table(docs: DataFrame) -> DataFrame:
    """kd, kt, ku (document key), site, pos, chars, h1, h2 per line."""
    bare = F.transform(_lines(F.col("text")), lambda x: F.trim(x, F.lit(BLANK)))
    hashed = F.transform(bare, lambda x: F.struct(F.length(x).alias("chars"), F.xxhash64(x).alias("h1"),
                                                  F.xxhash64(F.lit(2), x).alias("h2")))
    return docs.filter("text is not null").select(
        *_key(docs), F.coalesce("source", F.lit("\0none")).alias("site"), F.posexplode(hashed).alias("pos", "line")
    ).select("kd", "kt", "ku", "site", "pos", "line.*")


def boilerplate(lines: DataFrame, min_sites: int = MIN_SITES, margin: float = MARGIN, lg_k: int = LG_K) -> DataFrame:
    """h1, h2 of the lines that at least min_sites distinct sites have."""
    seen = lines.filter("chars > 0")
    spread = seen.groupBy("h1", "h2").agg(F.hll_sketch_estimate(F.hll_sketch_agg("site", F.lit(lg_k))).alias("sites"))
    spread = lookup_table(spread.filter(F.col("sites") >= min_sites * (1 - margin)))
    sure = spread.filter(F.col("sites") > min_sites * (1 + margin)).select("h1", "h2")
    near = spread.filter(F.col("sites") <= min_sites * (1 + margin)).select("h1", "h2")
    exact = seen.join(near, ["h1", "h2"]).select("h1", "h2", "site").distinct() \
        .groupBy("h1", "h2").agg(F.count("*").alias("sites")).filter(F.col("sites") >= min_sites).select("h1", "h2")
    return sure.union(exact)


def dedup_lines(docs: DataFrame, min_sites: int = MIN_SITES, margin: float = MARGIN, lg_k: int = LG_K) -> DataFrame:
    """docs with its text cleaned, and n_lines, n_removed, removed_chars, left_whole.

    ``n_removed`` is 0 in a document that is left whole although it has boilerplate."""
    lines = materialize(line_table(docs))
    bad = lookup_table(boilerplate(lines, min_sites, margin, lg_k))
    hit = lines.join(bad, ["h1", "h2"]).filter("chars > 0").select("kd", "kt", "ku").distinct()
    # The lines of the documents with a hit, in order, each with its flag.
    flagged = lines.join(lookup_table(hit), ["kd", "kt", "ku"]).join(bad.withColumn("bad", F.lit(True)), ["h1", "h2"], "left")
    flag = F.struct("pos", F.coalesce("bad", F.lit(False)).alias("bad"), "chars")
    per_doc = flagged.groupBy("kd", "kt", "ku").agg(F.sort_array(F.collect_set(flag)).alias("flags"))
    removed = F.aggregate("flags", F.lit(0).cast("long"), lambda a, x: a + F.when(x.bad, x.chars).otherwise(0))
    whole = F.aggregate("flags", F.lit(0).cast("long"), lambda a, x: a + x.chars)
    cleaned = F.col("removed_chars") < whole
    per_doc = lookup_table(per_doc.withColumn("removed_chars", removed).withColumn("cleaned", cleaned).select(
        "kd", "kt", "ku", "cleaned", F.when(F.col("cleaned"), F.col("removed_chars")).alias("removed_chars"),
        F.when(F.col("cleaned"), F.transform("flags", lambda x: x.bad)).alias("bad")))
    mine = [c for c in docs.columns if c not in ("n_lines", "n_removed", "removed_chars", "left_whole")]
    own = docs.select(F.struct(*mine).alias("row"), "text", *_key(docs)).join(per_doc, ["kd", "kt", "ku"], "left")
    kept = F.filter(F.zip_with(_lines(F.col("text")), F.col("bad"), lambda x, b: F.when(~b, x)), lambda x: x.isNotNull())
    clean = F.when(F.col("bad").isNull(), F.col("text")).otherwise(F.array_join(kept, "\n"))
    others = [F.col("row")[c].alias(c) if c != "text" else clean.alias("text") for c in mine]
    return own.select(
        *others, F.when(F.col("text").isNull(), 0).otherwise(F.size(_lines(F.col("text")))).cast("long").alias("n_lines"),
        F.coalesce(F.size(F.filter("bad", lambda b: b)), F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce("removed_chars", F.lit(0)).cast("long").alias("removed_chars"),
        F.coalesce(~F.col("cleaned"), F.lit(False)).alias("left_whole"))
