"""Op 12: ranked lexical search by pipelined term partitioning.

The index is cut two ways: documents into blocks of bounded size, terms into owners.
Owner 0 has the rarest terms, the last one the words that most documents hold. A
bundle (one block, one group of items) carries the items' terms and a sparse
accumulator: which documents of the block have how much score for which item. It
visits the owners one after the other: each stage is a cogroup of the bundles with
the owner's postings by block, which adds integer contributions. After the last
stage the best documents of all blocks are merged.

Between the stages the tenth best sum so far of every item over all blocks is its
bar. No document can lose score, so a document whose sum, plus the most that the
item's terms of the owners to come can add, stays below the bar cannot be among
the ten best and leaves the accumulator; once that most is below the bar by itself,
no further documents are taken up. This keeps the result exact: there is no cap.

Terms are compared by a 64-bit hash of their bytes. A bitmap of the items' terms of
fixed size (``FILTER_BITS``, the only thing sent to all tasks) drops most other
words before they are shuffled; its false positives go in the join with the items' terms.

Skew: a frequent term has one posting list per block, never one list; blocks and item
groups have bounded sizes; the ten best are merged by a window that Spark limits on
the map side. Counts of documents and terms come to the driver as two numbers.

Nulls and edges: a null or empty text has no terms, is not counted and never found; a
null doc_id ranks after all others among equal scores, and equal scores of rows that
share a doc_id rank by their place in the table; an item without terms, or without a
matching document, has no rows; repeated items each get their rows under a rank of
their own row; extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.reuse import materialize
from .text import ByteHash, Slice, bounds, slices

TOP = 10
#: Bytes of text (and documents) of one block, items of one group.
BLOCK_BYTES, BLOCK_DOCS, GROUP_ITEMS = 16 << 20, 1 << 16, 256
#: Bits of the bitmap of the items' terms.
FILTER_BITS = 1 << 21
#: A term belongs to the first owner whose share of the documents it does not exceed.
OWNER_SHARES = (1 / 2048, 1 / 128, 1 / 16, 1.0)

_TERM = np.zeros(256, dtype=bool)
_TERM[0x80:] = True
for _lo, _hi in ((0x30, 0x3A), (0x41, 0x5B), (0x61, 0x7B)):
    _TERM[_lo:_hi] = True


def terms(s: Slice, hasher: ByteHash) -> tuple[np.ndarray, np.ndarray]:
    """Hash (as a signed number) and document of every term of a slice, in order."""
    inside = _TERM[s.data]
    n = len(inside)
    if n == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    cut = np.zeros(n + 1, dtype=bool)
    cut[s.offsets] = True
    start = np.flatnonzero(inside & (cut[:n] | np.concatenate(([True], ~inside[:-1]))))
    end = np.flatnonzero(inside & (cut[1:] | np.concatenate((~inside[1:], [True])))) + 1
    h = hasher.ranges(hasher.prefix(s.data), start, end).view(np.int64)
    return h, np.searchsorted(s.offsets, start, side="right") - 1


def _runs(*keys: np.ndarray) -> np.ndarray:
    """Where a new combination of sorted keys starts, and the end."""
    if len(keys[0]) == 0:
        return np.zeros(1, np.int64)
    new = np.concatenate(([True], np.logical_or.reduce([k[1:] != k[:-1] for k in keys])))
    return np.append(np.flatnonzero(new), len(keys[0]))


def item_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """mapInArrow function: (uid, text) -> uid, term, times per different term of an item."""
    hasher = ByteHash(lower=True)
    for b in batches:
        for s in slices(b.column("text")):
            h, doc = terms(s, hasher)
            order = np.lexsort((h, doc))
            h, doc = h[order], doc[order]
            at = _runs(doc, h)
            yield pa.RecordBatch.from_arrays(
                [b.column("uid").slice(s.lo, s.hi - s.lo).take(pa.array(doc[at[:-1]])), pa.array(h[at[:-1]]), pa.array(np.diff(at))],
                names=["uid", "term", "times"])


def filter_bit(term: np.ndarray) -> np.ndarray:
    return ((term.view(np.uint64) >> np.uint64(8)) & np.uint64(FILTER_BITS - 1)).astype(np.int64)


def term_bitmap(item_terms: DataFrame) -> np.ndarray:
    """A boolean per bit that some item's term has; FILTER_BITS / 32768 rows come to the driver."""
    bit = F.shiftright("term", 8).bitwiseAND(FILTER_BITS - 1)
    rows = item_terms.select(bit.alias("bit")).distinct().groupBy(F.expr("bit div 32768").alias("part")) \
        .agg(F.expr("bitmap_construct_agg(bit % 32768)").alias("bits")).collect()
    out = np.zeros(FILTER_BITS, dtype=bool)
    for r in rows:
        out[r.part * 32768:(r.part + 1) * 32768] = np.unpackbits(np.frombuffer(r.bits, np.uint8), bitorder="little")
    return out


class Block:
    """Documents collected until a block is full."""

    def __init__(self):
        self.ids, self.rows, self.n, self.h, self.doc, self.tf, self.docs, self.bytes = [], [], [], [], [], [], 0, 0

    def add(self, ids: pa.Array, rows: np.ndarray, s: Slice, hasher: ByteHash, wanted: np.ndarray) -> None:
        h, doc = terms(s, hasher)
        n = np.diff(bounds(doc, s.hi - s.lo))
        hit = np.flatnonzero(wanted[filter_bit(h)])
        h, doc = h[hit], doc[hit]
        order = np.lexsort((h, doc))
        h, doc = h[order], doc[order]
        at = _runs(doc, h)
        self.h.append(h[at[:-1]])
        self.doc.append((doc[at[:-1]] + self.docs).astype(np.int64))
        self.tf.append(np.diff(at))
        self.ids.append(ids)
        self.rows.append(rows)
        self.n.append(n)
        self.docs += s.hi - s.lo
        self.bytes += len(s.data)

    def batch(self, number: int) -> Iterator[pa.RecordBatch]:
        """The block's documents (term null), then one row per term with its postings."""
        ids, n, rows = pa.concat_arrays([x.cast(pa.int64()) for x in self.ids]), np.concatenate(self.n).astype(np.int64), np.concatenate(self.rows)
        h, doc, tf = np.concatenate(self.h), np.concatenate(self.doc), np.concatenate(self.tf)
        order = np.lexsort((doc, h))
        h, doc, tf = h[order], doc[order], tf[order]
        at = _runs(h)
        first = at[:-1]
        known = np.asarray(ids.is_valid())
        head = [known.astype(np.uint8).tobytes(), np.asarray(ids.fill_null(0)).astype("<i8").tobytes() + rows.astype("<i8").tobytes()]
        d, t = doc.astype("<u4"), tf.astype("<u4")
        empty = len(first) == 0
        most = [] if empty else np.maximum.reduceat(tf, first).tolist()
        least = [] if empty else np.minimum.reduceat(n[doc], first).tolist()
        cols = {
            "block": [number] * (len(first) + 1), "term": [None, *h[first].tolist()], "df": [int((n > 0).sum()), *np.diff(at).tolist()],
            "size": [int(n.sum()), *[None] * len(first)], "most": [None, *most], "least": [None, *least],
            "docs": [head[1], *[d[a:b].tobytes() for a, b in zip(first, at[1:])]],
            "tfs": [n.astype("<i8").tobytes() + head[0], *[t[a:b].tobytes() for a, b in zip(first, at[1:])]]}
        yield pa.RecordBatch.from_arrays([pa.array(v, BLOCK_TYPES[k]) for k, v in cols.items()], names=list(cols))


BLOCK_TYPES = {"block": pa.int64(), "term": pa.int64(), "df": pa.int64(), "size": pa.int64(), "most": pa.int64(), "least": pa.int64(),
               "docs": pa.binary(), "tfs": pa.binary()}
_BLOCK_SCHEMA = "block long, term long, df long, size long, most long, least long, docs binary, tfs binary"


def block_batches(wanted: np.ndarray, block_bytes: int, block_docs: int):
    """mapInArrow function: (doc_id, uid, text) -> blocks (BLOCK_TYPES). A block's
    number is the place of its first row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, block, number = ByteHash(lower=True), Block(), None
        for b in batches:
            uid = np.asarray(b.column("uid"))
            for s in slices(b.column("text")):
                for lo in range(s.lo, s.hi, block_docs):       # many short documents
                    hi = min(s.hi, lo + block_docs)
                    o = s.offsets[lo - s.lo:hi - s.lo + 1]
                    part = Slice(lo, hi, s.data[o[0]:o[-1]], o - o[0])
                    if block.docs and (block.docs + hi - lo > block_docs or block.bytes + len(part.data) > block_bytes):
                        yield from block.batch(number)
                        block = Block()
                    number = int(uid[lo]) if not block.docs else number
                    block.add(b.column("doc_id").slice(lo, hi - lo), uid[lo:hi], part, hasher, wanted)
        if block.docs:
            yield from block.batch(number)
    return run


def impact(tf: np.ndarray, n: np.ndarray, N: int, L: int) -> np.ndarray:
    """(1000000000 tf) div (1000 tf + 8 m) with m = 25 + (75 n N) div L."""
    m = 25 + (75 * n * N) // L
    return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


def visit(N: int, L: int, top: int):
    """Cogroup function of one owner's stage: a bundle and the block's postings of
    the owner -> the bundle with its new accumulator and its best sums so far."""
    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left):
            return pd.DataFrame(columns=["block", "grp", "ids", "n", "item", "doc", "sum", "best"])
        row = left.iloc[0]
        sizes = row.n
        docs = len(sizes) // 9
        n = np.frombuffer(sizes, "<i8", docs)
        postings = {}
        for t, w, d, f in zip(right.term, right.w, right.docs, right.tfs):
            d, f = np.frombuffer(d, "<u4").astype(np.int64), np.frombuffer(f, "<u4").astype(np.int64)
            postings[t] = (d, w * impact(f, n[d], N, L))
        acc_item, acc_doc, acc_sum = (np.frombuffer(row[c], t).astype(np.int64) for c, t in (("item", "<u4"), ("doc", "<u4"), ("sum", "<i8")))
        at = np.searchsorted(acc_item, np.arange(len(row["terms"]) + 1))
        out, best = [], []
        total, seen = np.zeros(docs, np.int64), np.zeros(docs, dtype=bool)
        for i, item in enumerate(row["terms"]):
            mine = slice(at[i], at[i + 1])
            have = acc_doc[mine]
            lists = [(*postings[t], q) for t, q in zip(item["term"], item["times"]) if t in postings]
            total[have] = acc_sum[mine]
            seen[have] = True
            if item["open"] < item["bar"]:                     # no document can still come up from nothing
                for d, c, q in lists:
                    if len(have) * 16 < len(d):
                        p = np.minimum(np.searchsorted(d, have), len(d) - 1)
                        ok = d[p] == have
                        total[have[ok]] += q * c[p[ok]]
                    else:
                        ok = seen[d]
                        total[d[ok]] += q * c[ok]
                found = have
            else:
                for d, c, q in lists:
                    total[d] += q * c                          # a list holds a document once
                    seen[d] = True
                found = np.flatnonzero(seen)
            sums = total[found].copy()
            total[found], seen[found], seen[have], total[have] = 0, False, False, 0
            keep = sums + item["rest"] >= item["bar"]
            found, sums = found[keep], sums[keep]
            out.append((np.full(len(found), i), found, sums))
            if len(found):
                high = np.sort(sums)[::-1][:top]
                best += [{"i": i, "score": int(x)} for x in high[high > 0]]
        item, doc, total = (np.concatenate([o[k] for o in out]) if out else np.zeros(0, np.int64) for k in range(3))
        return pd.DataFrame({"block": [row.block], "grp": [row.grp], "ids": [row.ids], "n": [row.n], "item": [item.astype("<u4").tobytes()],
                             "doc": [doc.astype("<u4").tobytes()], "sum": [total.astype("<i8").tobytes()], "best": [best]})
    return run


_BUNDLE_SCHEMA = ("block long, grp long, ids binary, n binary, item binary, doc binary, sum binary, "
                  "best array<struct<i:int,score:long>>")


def final_batches(top: int):
    """mapInArrow function: bundles -> grp, i, doc_id, row, score of each item's best of the block."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in b.to_pylist():
                docs = len(r["n"]) // 9
                known = np.frombuffer(r["n"], np.uint8)[8 * docs:].astype(bool)
                ids, rows = np.frombuffer(r["ids"], "<i8")[:docs], np.frombuffer(r["ids"], "<i8")[docs:]
                item, doc, total = np.frombuffer(r["item"], "<u4"), np.frombuffer(r["doc"], "<u4"), np.frombuffer(r["sum"], "<i8")
                at = _runs(item)
                picked = []
                for lo, hi in zip(at[:-1], at[1:]):
                    d, s = doc[lo:hi], total[lo:hi]
                    d, s = d[s > 0], s[s > 0]
                    if len(s) > top:
                        ok = s >= np.partition(s, len(s) - top)[len(s) - top]
                        d, s = d[ok], s[ok]
                    order = np.lexsort((rows[d], ids[d], ~known[d], -s))[:top]
                    picked.append((np.full(len(order), item[lo], dtype=np.int64), d[order], s[order]))
                if picked:
                    i, d, s = (np.concatenate([p[k] for p in picked]) for k in range(3))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(i), r["grp"])), pa.array(i), pa.array(ids[d], mask=~known[d]), pa.array(rows[d]), pa.array(s)],
                        names=["grp", "i", "doc_id", "row", "score"])
    return run


def item_groups(items: DataFrame, item_terms: DataFrame, weights: DataFrame, group_items: int) -> tuple[DataFrame, int]:
    """grp, i, item_id and its terms (term, times, owner, w, most) per item with matching terms,
    i from 0 in its group; and the number of groups."""
    n_items = items.count()
    groups = max(1, -(-n_items // group_items))
    known = item_terms.join(weights, "term").groupBy("uid").agg(F.sort_array(F.collect_list(F.struct("owner", "term", "times", "w", "most"))).alias("terms"))
    dealt = items.join(known, "uid").withColumn("grp", F.pmod(F.xxhash64("uid"), F.lit(groups)))
    w = Window.partitionBy("grp").orderBy("uid")               # about group_items rows
    return materialize(dealt.select("uid", "item_id", "terms", "grp", (F.row_number().over(w) - 1).alias("i"))), groups


def search(docs: DataFrame, items: DataFrame, top: int = TOP, block_bytes: int = BLOCK_BYTES, block_docs: int = BLOCK_DOCS,
           group_items: int = GROUP_ITEMS, shares: tuple[float, ...] = OWNER_SHARES) -> DataFrame:
    """item_id, rank, doc_id, score: the top documents of every item."""
    spark = docs.sparkSession
    none = spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    items = materialize(items.select(F.monotonically_increasing_id().alias("uid"), F.col("item_id").cast("long").alias("item_id"), "text"))
    item_terms = materialize(items.select("uid", "text").mapInArrow(item_batches, "uid long, term long, times long"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.monotonically_increasing_id().alias("uid"), "text")
    index = materialize(rows.mapInArrow(block_batches(term_bitmap(item_terms), block_bytes, block_docs), _BLOCK_SCHEMA))
    heads = index.filter("term is null")
    count = heads.agg(F.sum("df").alias("N"), F.sum("size").alias("L")).first()
    N, L = count.N or 0, count.L or 0
    if not N:
        return none
    m = F.lit(25) + F.expr(f"(75 * least * {N}L) div {L}L")
    weights = index.filter("term is not null").join(item_terms.select("term").distinct(), "term", "left_semi").withColumn("m", m).groupBy("term").agg(
        F.sum("df").alias("df"), F.max(F.expr("(1000000000L * most) div (1000L * most + 8 * m)")).alias("most"))
    owner = F.lit(len(shares) - 1)
    for k in range(len(shares) - 2, -1, -1):
        owner = F.when(F.col("df") <= shares[k] * N, k).otherwise(owner)
    w = F.floor(1000 * F.log((2 * F.lit(N) + 2).cast("double") / (2 * F.col("df") + 1).cast("double"))).cast("long")
    weights = materialize(weights.select("term", "most", w.alias("w"), owner.cast("int").alias("owner")))
    groups, n_groups = item_groups(items.select("uid", "item_id"), item_terms, weights, group_items)
    postings = materialize(index.filter("term is not null").select("block", "term", "docs", "tfs").join(weights.select("term", "w", "owner"), "term"))
    group_list = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_groups - 1).cast("long")))
    bundles = heads.select("block", group_list.alias("grp"), F.col("docs").alias("ids"), F.col("tfs").alias("n"), *[
        F.lit(b"").alias(c) for c in ("item", "doc", "sum")])
    bars = None
    for stage in range(len(shares)):
        # What the item's terms from this stage (open) and after it (rest) can add at most.
        def most_from(k):
            return F.aggregate(F.filter("terms", lambda x: x.owner >= k), F.lit(0).cast("long"), lambda a, x: a + x.times * x.w * x.most)
        mine = F.filter("terms", lambda x: x.owner == stage)
        plan = groups if bars is None else groups.join(bars, ["grp", "i"], "left")
        plan = plan.select("grp", "i", F.struct(
            "i", F.transform(mine, lambda x: x.term).alias("term"), F.transform(mine, lambda x: x.times).alias("times"),
            most_from(stage).alias("open"), most_from(stage + 1).alias("rest"),
            (F.lit(0) if bars is None else F.coalesce("bar", F.lit(0))).cast("long").alias("bar")).alias("item"))
        plan = plan.groupBy("grp").agg(F.sort_array(F.collect_list("item")).alias("terms")).hint("rebalance")
        left = bundles.join(plan, "grp").select("block", "grp", "ids", "n", "item", "doc", "sum", "terms")
        right = postings.filter(F.col("owner") == stage).select(F.col("block").alias("its_block"), group_list.alias("its_grp"), "term", "w", "docs", "tfs")
        met = left.groupBy("block", "grp").cogroup(right.groupBy("its_block", "its_grp"))
        bundles = materialize(met.applyInPandas(visit(N, L, top), _BUNDLE_SCHEMA))
        if stage + 1 < len(shares):
            best = bundles.select("grp", F.explode("best").alias("b")).select("grp", "b.*")
            nth = F.row_number().over(Window.partitionBy("grp", "i").orderBy(F.desc("score")))
            bars = best.withColumn("nth", nth).filter(F.col("nth") <= top).groupBy("grp", "i").agg(
                F.max(F.when(F.col("nth") == top, F.col("score"))).alias("bar"))
            bundles = bundles.drop("best")
    found = bundles.select("grp", "ids", "n", "item", "doc", "sum").mapInArrow(final_batches(top), "grp long, i long, doc_id long, row long, score long")
    order = Window.partitionBy("grp", "i").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last(), "row")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return ranked.join(groups.select("grp", "i", "item_id"), ["grp", "i"]).select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")
