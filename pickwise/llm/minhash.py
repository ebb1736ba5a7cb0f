"""Op 10: near-duplicate classes by DartMinHash signatures and banded joining.

Every text becomes the set of its five-word shingles (a text of one to four
words is one shingle; ``weights="count"`` weighs a shingle by its number of
occurrences instead of 1). DartMinHash throws hashed darts at the plane
(weight x rank) of every shingle: the darts of a region are a Poisson number
seeded by the shingle and the region alone, so equal regions of two documents
hold equal darts. Regions double in weight and in rank; a document throws them
in order of rank until every one of the ``k`` coordinates has caught a dart, and
its signature keeps the earliest dart of each coordinate. Two signatures agree
in a coordinate with a probability that is the weighted Jaccard similarity.

Links: texts equal word for word form one class node first (hot copies never
meet in a join). Nodes are gathered by the smallest node that a few steps
through shared buckets lead to and dealt into parts of at most about PART_NODES nodes and PART_WORDS
words. Two parts that meet in any bucket (or one part with itself) are one unit
of work: all their node pairs are verified exactly on the shingles of their
whole texts, so every pair that shares a bucket is verified, once. A unit
returns per node its number of links and one edge of a spanning forest, never
the pairs. Classes are the connected components of these edges (star
contraction). No cap on buckets; the comparisons inside a family of n nodes are
n * n / 2, each text travels about n / PART_NODES times.

Nulls and edges: a null or wordless text is a class of its own; a null doc_id
is allowed; repeated rows fall into one class; extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.reuse import materialize
from .text import ByteHash, Slice, bounds, lookup_table, mix, slices, uniform, window_hashes, words

SHINGLE = 5
SIMILARITY = 0.8
#: 25 bands of 5 rows: a pair of similarity 0.8 shares a band with probability 0.99995.
BANDS, ROWS = 25, 5
#: About the most nodes and words of a part; two parts are compared in memory.
PART_NODES, PART_WORDS = 2048, 1 << 19
#: Times the smallest group of a node's buckets is taken over, so that the fringe
#: of a family joins its group (else it meets every part of the family anew).
HOPS = 2
#: Shingles in more documents than this are counted by a matrix product.
RARE = 8


def rank_cell(c: int) -> tuple[float, float]:
    """Rank interval of cell c: 1/32, then doubling up to 16, then steps of 16."""
    if c == 0:
        return 0.0, 1 / 32
    if c <= 9:
        return 2.0 ** (c - 6), 2.0 ** (c - 5)
    return 16.0 * (c - 9), 16.0 * (c - 8)


def poisson(u: np.ndarray, mean: np.ndarray) -> np.ndarray:
    """Poisson numbers by inversion of uniforms."""
    p = np.exp(-mean)
    cum, k, out = p.copy(), 0, np.zeros(len(u), dtype=np.int64)
    live = np.flatnonzero(u >= cum)
    while len(live):
        k += 1
        out[live] = k
        p[live] *= mean[live] / k
        cum[live] += p[live]
        live = live[(u[live] >= cum[live]) & (p[live] > 1e-300)]
    return out


def dart_signatures(element: np.ndarray, weight: np.ndarray, doc: np.ndarray, n_docs: int, k: int) -> np.ndarray:
    """(n_docs, k) dart ids of weighted sets given as (element hash, weight > 0,
    document) rows sorted by document; rows of empty documents stay 0."""
    total = np.bincount(doc, weights=weight, minlength=n_docs)
    reach = np.where(total > 0, (k * math.log(k) + 2 * k) / np.maximum(total, 1e-300), 0.0)
    best = np.full((n_docs, k), np.inf)
    sig = np.zeros((n_docs, k), dtype=np.uint64)
    live, active = np.flatnonzero(total > 0), total > 0   # documents that still throw
    mine = np.arange(len(doc))                            # and their elements
    c = 0
    while len(live):
        lo, hi = rank_cell(c)
        rows, band = mine, 0
        while len(rows):      # weight regions [0, 1), [1, 2), [2, 4), [4, 8), ...
            w_lo, w_hi = (0.0, 1.0) if band == 0 else (2.0 ** (band - 1), 2.0 ** band)
            rows = rows[weight[rows] > w_lo]
            if not len(rows):
                break
            cell = mix(element[rows] ^ mix(np.array([(c + 1) * 64 + band], dtype=np.uint64)))
            count = poisson(uniform(cell), np.full(len(rows), (hi - lo) * (w_hi - w_lo)))
            hit = np.flatnonzero(count)
            if len(hit):
                which = np.repeat(hit, count[hit])
                nth = np.arange(len(which)) - np.repeat(np.cumsum(count[hit]) - count[hit], count[hit])
                dart = mix(cell[which] + (nth.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15))
                rank = lo + uniform(mix(dart ^ np.uint64(0xA5A5A5A5))) * (hi - lo)
                at = w_lo + uniform(mix(dart ^ np.uint64(0x5C5C5C5C))) * (w_hi - w_lo)
                own = rows[which]
                inside = at < weight[own]
                dart, rank, own = dart[inside], rank[inside], doc[own[inside]]
                coord = (mix(dart ^ np.uint64(0x3B3B3B3B)) % np.uint64(k)).astype(np.int64)
                slot = own * k + coord
                better = np.flatnonzero(rank < best.ravel()[slot])
                better = better[np.argsort(-rank[better])]      # the earliest comes last and stays
                best.ravel()[slot[better]], sig.ravel()[slot[better]] = rank[better], dart[better]
            band += 1
        over = live[hi >= reach[live]]
        over = over[np.isfinite(best[over]).all(axis=1)]
        if len(over):
            active[over] = False
            live, mine = live[active[live]], mine[active[doc[mine]]]
        c += 1
    return sig


def shingle_sets(s: Slice, hasher: ByteHash, size: int = SHINGLE) -> tuple:
    """Per slice: distinct shingles, their counts and documents (sorted by
    document, then shingle), word counts, and a 128-bit key of the words."""
    n_docs = s.hi - s.lo
    start, end, doc = words(s)
    h = hasher.ranges(hasher.prefix(s.data), start, end)
    n_words = np.bincount(doc, minlength=n_docs)
    w, first = window_hashes(h, doc, size)
    d = doc[first]
    short = np.flatnonzero((n_words > 0) & (n_words < size))
    at = bounds(doc, n_docs)
    if len(short):
        own = n_words[short].astype(np.uint64)
        for j in range(size - 1 if size < 64 else 0):
            live = n_words[short] > j
            own[live] = mix(own[live] * np.uint64(31) + h[at[short[live]] + j])
        w, d = np.concatenate((w, own)), np.concatenate((d, short))
    order = np.lexsort((w, d))
    w, d = w[order], d[order]
    new = np.ones(len(w), dtype=bool)
    new[1:] = (w[1:] != w[:-1]) | (d[1:] != d[:-1])
    at_new = np.flatnonzero(new)
    counts = np.diff(np.append(at_new, len(w)))
    # The key of the whole word sequence: sums of position-mixed word hashes.
    pos = (np.arange(len(h)) - at[doc]).astype(np.uint64) if len(h) else np.zeros(0, np.uint64)
    key = []
    for seed in (1, 2):
        x = np.concatenate(([np.uint64(0)], np.cumsum(mix(h + mix(pos * np.uint64(2) + np.uint64(seed << 40))), dtype=np.uint64)))
        key.append(mix(x[at[1:]] - x[at[:-1]] + n_words.astype(np.uint64)))
    return w[new], counts, d[new], n_words, key


def signature_batches(bands: int, rows: int, size: int, weights: str):
    """mapInArrow function: (doc_id, text) -> doc_id, n_words, k1, k2, bands."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = ByteHash()
        for b in batches:
            ids = b.column("doc_id")
            for s in slices(b.column("text")):
                w, counts, d, n_words, key = shingle_sets(s, hasher, size)
                weight = counts.astype(float) if weights == "count" else np.ones(len(w))
                sig = dart_signatures(w, weight, d, s.hi - s.lo, bands * rows)
                out = np.zeros((s.hi - s.lo, bands), dtype=np.uint64)
                for r in range(rows):
                    out = mix(out * np.uint64(3) + sig[:, r::rows])
                out = mix(out + np.arange(bands, dtype=np.uint64)).view(np.int64)
                yield pa.RecordBatch.from_arrays([
                    ids.slice(s.lo, s.hi - s.lo), pa.array(n_words.astype(np.int64)),
                    pa.array(key[0].view(np.int64)), pa.array(key[1].view(np.int64)),
                    pa.ListArray.from_arrays(pa.array(np.arange(0, out.size + 1, bands, dtype=np.int32)),
                                             pa.array(out.ravel()))],
                    names=["doc_id", "n_words", "k1", "k2", "bands"])
    return run


def content_keys(docs: DataFrame) -> DataFrame:
    """All columns of docs with __k1, __k2 (the 128-bit key of the words)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = ByteHash()
        for b in batches:
            keys: list[list] = [[np.zeros(0, np.int64)], [np.zeros(0, np.int64)]]
            for s in slices(b.column("text")):
                for own, key in zip(keys, shingle_sets(s, hasher, 1 << 30)[4]):
                    own.append(key.view(np.int64))
            yield pa.RecordBatch.from_arrays([*b.columns, *(pa.array(np.concatenate(k)) for k in keys)],
                                             names=[*b.schema.names, "__k1", "__k2"])
    schema = ", ".join(f"`{c}` {t}" for c, t in docs.dtypes)
    return docs.mapInArrow(run, f"{schema}, __k1 long, __k2 long")


def packed_texts(docs: DataFrame) -> DataFrame:
    """k1, k2 and the compressed text of every document that has words."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, codec = ByteHash(), pa.Codec("zstd", 1)
        for b in batches:
            for s in slices(b.column("text")):
                _, _, _, n_words, key = shingle_sets(s, hasher, 1 << 30)
                keep = np.flatnonzero(n_words)
                raw = [s.data[s.offsets[i]:s.offsets[i + 1]].tobytes() for i in keep]
                packed = [len(x).to_bytes(8, "little") + codec.compress(x, asbytes=True) for x in raw]
                yield pa.RecordBatch.from_arrays([pa.array(k.view(np.int64)[keep]) for k in key] + [pa.array(packed, pa.binary())],
                                                 names=["k1", "k2", "packed"])
    return docs.select("text").mapInArrow(run, "k1 long, k2 long, packed binary")


def unpacked(column: pa.Array) -> pa.Array:
    codec = pa.Codec("zstd")
    raw = [x.as_py() for x in column]
    return pa.array([codec.decompress(x[8:], int.from_bytes(x[:8], "little"), asbytes=True) for x in raw],
                    pa.large_binary()).cast(pa.large_string())


def overlaps(w: np.ndarray, doc: np.ndarray, n_docs: int, n_left: int) -> np.ndarray:
    """Numbers of common elements of sets given as (element, document) rows
    sorted by document: of all pairs of documents if n_left is n_docs (the
    diagonal is not filled), else of the first n_left with the others."""
    own = n_left == n_docs
    low = 0 if own else n_left
    out = np.zeros((n_left, n_docs - low), dtype=np.float32 if len(w) < 1 << 24 else np.float64)
    order = np.argsort(w, kind="stable")
    w, doc = w[order], doc[order]
    start = np.flatnonzero(np.concatenate((np.ones(min(len(w), 1), dtype=bool), w[1:] != w[:-1])))
    count = np.diff(np.append(start, len(w)))
    for k in range(2, RARE + 1):
        i, j = np.triu_indices(k, 1)
        some = doc[start[count == k][:, None] + np.arange(k)]
        i, j = some[:, i].ravel(), some[:, j].ravel()
        if not own:
            across = (i < n_left) & (j >= n_left)
            i, j = i[across], j[across] - n_left
        at, n = np.unique(i * out.shape[1] + j, return_counts=True)
        out.ravel()[at] += n
    if own:
        out += out.T.copy()
    often = np.flatnonzero(count > RARE)
    for lo in range(0, len(often), 2048):
        some = often[lo:lo + 2048]
        at = np.repeat(start[some] - np.cumsum(count[some]) + count[some], count[some]) + np.arange(count[some].sum())
        has = np.zeros((n_docs, len(some)), dtype=np.float32)
        has[doc[at], np.repeat(np.arange(len(some)), count[some])] = 1
        out += has[:n_left] @ has[low:].T
    return out


def forest(linked: np.ndarray) -> np.ndarray:
    """Per row of a symmetric boolean matrix the first row of its component."""
    root = np.arange(len(linked))
    todo = linked.any(axis=1)
    for i in np.flatnonzero(todo):
        front = np.array([i]) if todo[i] else np.zeros(0, np.int64)
        todo[front] = False
        while len(front):
            near = todo.copy()
            near[near] = linked[np.ix_(near, front)].any(axis=1)
            front = np.flatnonzero(near)
            root[front], todo[front] = i, False
    return root


def unit_batches(size: int, weights: str, similarity: float):
    """mapInArrow function: (pa, pb, side, node, packed) sorted by unit (pa, pb)
    -> node, root, links: the links of node to the nodes it meets in the unit
    and the first node of its component there."""
    def verified(side: np.ndarray, node: np.ndarray, w: np.ndarray, length: np.ndarray) -> pa.RecordBatch:
        n, n_left = len(node), int((side == 0).sum())
        low = n_left if n_left < n else 0
        order = np.argsort(side, kind="stable")          # the first part's nodes come first
        place = np.empty(n, dtype=np.int64)
        place[order] = np.arange(n)
        doc = np.repeat(place, length)
        by = np.argsort(doc, kind="stable")
        node, length = node[order], length[order]
        both = overlaps(w[by], doc[by], n, n_left)
        linked = np.zeros((n, n), dtype=bool)
        for at in range(0, n_left, 256):
            own = both[at:at + 256].astype(float)
            linked[at:at + len(own), low:] = own / (length[at:at + len(own), None] + length[low:] - own) >= similarity
        linked[:, :n_left] |= linked[:n_left].T
        np.fill_diagonal(linked, False)
        links, root = linked.sum(axis=1), forest(linked)
        keep = np.flatnonzero(links)
        return pa.RecordBatch.from_arrays([pa.array(x) for x in (node[keep], node[root[keep]], links[keep])],
                                          names=["node", "root", "links"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, unit, held = ByteHash(), None, []
        for b in batches:
            for lo in range(0, b.num_rows, 256):
                part = b.slice(lo, 256)
                found, sizes = [], []
                for s in slices(unpacked(part.column("packed"))):
                    w, c, d, _, _ = shingle_sets(s, hasher, size)
                    if weights == "count":      # a shingle's nth occurrence is an element
                        at = np.repeat(np.cumsum(c) - c, c)
                        nth = (np.arange(len(at)) - at).astype(np.uint64)
                        w, d = mix(np.repeat(w, c) + nth * np.uint64(0x9E3779B97F4A7C15)), np.repeat(d, c)
                    found.append(w)
                    sizes.append(np.bincount(d, minlength=s.hi - s.lo))
                w, length = np.concatenate(found), np.concatenate(sizes)
                at = np.concatenate(([0], np.cumsum(length)))
                first, second, side, node = (part.column(k).to_numpy() for k in ("pa", "pb", "side", "node"))
                new = np.flatnonzero((first[1:] != first[:-1]) | (second[1:] != second[:-1])) + 1
                for x, y in zip([0, *new], [*new, len(node)]):
                    if unit != (first[x], second[x]):
                        if held:
                            yield verified(*(np.concatenate(v) for v in zip(*held)))
                        unit, held = (first[x], second[x]), []
                    held.append((side[x:y], node[x:y], w[at[x]:at[y]], length[x:y]))
        if held:
            yield verified(*(np.concatenate(v) for v in zip(*held)))
    return run


def components(edges: DataFrame) -> DataFrame:
    """Connected components of edges (a, b) by alternating large and small
    stars; returns (node, comp), comp being the smallest node."""
    def star(e: DataFrame, large: bool) -> DataFrame:
        both = e.select("a", "b").union(e.select(F.col("b").alias("a"), F.col("a").alias("b"))) if large else \
            e.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        low = lookup_table(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")))
        out = both.join(low, "a")
        if large:
            out = out.filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        else:
            out = out.select(F.col("b").alias("a"), F.col("m").alias("b")).union(low.select("a", F.col("m").alias("b")))
        return out.filter("a <> b").distinct()

    e = materialize(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct())
    before = None
    while True:
        e = materialize(star(materialize(star(e, True)), False))
        now = e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    nodes = e.select(F.col("a").alias("node"), F.col("b").alias("comp"))
    return nodes.union(e.select(F.col("b").alias("node"), F.col("b").alias("comp")).distinct())


def near_duplicates(docs: DataFrame, similarity: float = SIMILARITY, size: int = SHINGLE, bands: int = BANDS,
                    rows: int = ROWS, weights: str = "set") -> DataFrame:
    """One row per document: doc_id, k1, k2 (key of its words), class_id (the
    smallest doc_id of its class), class_size (documents), n_links (verified
    links of its text to other texts), is_kept (its text is the one that stays).
    """
    if weights not in ("set", "count"):
        raise ValueError("weights is 'set' or 'count'")
    base = docs.select("doc_id", "text")
    sig = base.mapInArrow(signature_batches(bands, rows, size, weights),
                          "doc_id long, n_words long, k1 long, k2 long, bands array<long>")
    sig = materialize(sig.withColumn("uid", F.monotonically_increasing_id()))
    # One node per distinct word sequence; a wordless text is its own node.
    lone = F.when(F.col("n_words") == 0, F.col("uid")).otherwise(F.lit(-1))
    sig = sig.withColumn("lone", lone)
    nodes = materialize(sig.groupBy("k1", "k2", "lone").agg(
        F.min("uid").alias("node"), F.min("doc_id").alias("min_doc"), F.count("*").alias("copies"), F.max("n_words").alias("n_words")))
    firsts = sig.filter("n_words > 0").select("uid", "bands").join(nodes.select(F.col("node").alias("uid")), "uid")
    hits = materialize(firsts.select(F.col("uid").alias("node"), F.explode("bands").alias("bucket")))
    shared = lookup_table(hits.groupBy("bucket").agg(F.min("node").alias("low"), F.max("node").alias("high"))
                          .filter("low < high").select("bucket", "low"))
    hits = materialize(hits.join(shared, "bucket"))
    links = materialize(_links(base, nodes, hits, size, weights, similarity))
    comp = materialize(components(links.select(F.col("node").alias("a"), F.col("root").alias("b"))))
    degree = links.groupBy("node").agg(F.sum("links").alias("n_links"))
    full = nodes.join(comp, "node", "left").withColumn("comp", F.coalesce("comp", "node")).join(degree, "node", "left")
    full = materialize(full)
    classes = lookup_table(full.groupBy("comp").agg(
        F.min("min_doc").alias("class_id"), F.sum("copies").alias("class_size"),
        F.min(F.struct(F.col("min_doc").isNull().alias("no_id"), "min_doc", "node")).alias("best")))
    named = lookup_table(full.join(classes, "comp").select(
        "k1", "k2", "lone", "class_id", "class_size", F.coalesce("n_links", F.lit(0)).alias("n_links"),
        (F.col("node") == F.col("best.node")).alias("is_kept"),
        F.col("min_doc").alias("first_doc")))
    return sig.select("doc_id", "k1", "k2", "lone").join(named, ["k1", "k2", "lone"]).select(
        "doc_id", "k1", "k2", "class_id", "class_size", "n_links",
        (F.col("is_kept") & F.col("doc_id").eqNullSafe(F.col("first_doc"))).alias("is_kept"))


def _links(docs: DataFrame, nodes: DataFrame, hits: DataFrame, size: int, weights: str, similarity: float) -> DataFrame:
    """node, root, links of every unit of work, from hits (node, bucket, low: the
    bucket's smallest node) of all buckets with several nodes."""
    group = hits.groupBy("node").agg(F.min("low").alias("group"))
    for _ in range(HOPS):
        near = hits.join(lookup_table(group), "node")
        low = lookup_table(near.groupBy("bucket").agg(F.min("group").alias("group")))
        group = hits.select("node", "bucket").join(low, "bucket").groupBy("node").agg(F.min("group").alias("group"))
    group = materialize(group.join(lookup_table(nodes.filter("lone = -1").select("node", "k1", "k2", "n_words")), "node"))
    sizes = lookup_table(group.groupBy("group").agg(F.greatest(
        F.ceil(F.count("*") / PART_NODES), F.ceil(F.sum("n_words") / PART_WORDS)).alias("n_parts")))
    dealt = group.join(sizes, "group").select(
        "node", "k1", "k2", F.xxhash64("group", F.pmod(F.xxhash64("node"), "n_parts")).alias("part"))
    dealt = lookup_table(dealt)
    # The parts of every bucket; one meets itself where two of its nodes do.
    meets = materialize(hits.select("node", "bucket").join(dealt.select("node", "part"), "node")
                        .groupBy("bucket", "part").agg(F.count("*").alias("n")))
    left, right = meets.select("bucket", F.col("part").alias("pa"), "n"), meets.select("bucket", F.col("part").alias("pb"))
    units = materialize(left.join(right, "bucket").filter("pa < pb or (pa = pb and n > 1)").select("pa", "pb").distinct())
    asked = lookup_table(units.select("pa", "pb", F.lit(0).alias("side"), F.col("pa").alias("part")).union(
        units.filter("pa <> pb").select("pa", "pb", F.lit(1).alias("side"), F.col("pb").alias("part"))))
    # Copies are reduced before they are shuffled, so a hot group of them stays small.
    packed = packed_texts(docs).dropDuplicates(["k1", "k2"]).join(dealt, ["k1", "k2"]).select("node", "part", "packed")
    rows = lookup_table(packed).join(asked, "part").select("pa", "pb", "side", "node", "packed")
    return rows.repartition("pa", "pb").sortWithinPartitions("pa", "pb").mapInArrow(
        unit_batches(size, weights, similarity), "node long, root long, links long")


def keep_one(docs: DataFrame, **options) -> DataFrame:
    """The rows of docs whose text stays: one document of each class."""
    no_id = F.lit(-(1 << 63))
    kept = near_duplicates(docs, **options).filter("is_kept").select(
        F.coalesce("doc_id", no_id).alias("__kd"), F.col("k1").alias("__k1"), F.col("k2").alias("__k2"))
    kept = lookup_table(kept.distinct())
    own = content_keys(docs).withColumn("__kd", F.coalesce("doc_id", no_id))
    return own.join(kept, ["__kd", "__k1", "__k2"], "left_semi").dropDuplicates(["__kd", "__k1", "__k2"]).select(*docs.columns)
