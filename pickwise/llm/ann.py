"""Op 1: approximate nearest neighbours on shifted Hilbert curves.

Every vector is projected onto a few random directions, several times over; each
projection, shifted at random, is laid along a Hilbert curve. Per curve the rows
are range-partitioned by key into blocks of equal share; a query searches the
block its own key falls into and the neighbouring ones. The windows of all
curves merge: each window answers its exact nearest rows, and the best of all
windows are ranked by the exact distance on the original vectors.

The index is fitted on a bounded sample (``SAMPLE`` rows of smallest id hash: where
projected values lie and where blocks are cut); every row is indexed. A block's
share does not depend on the table's size, and neither does the recall (0.96 on
isotropic 64-dimensional vectors, where a tenth of the rows is near any
point in few dimensions; more blocks do for data with fewer true dimensions).

Skew: equal vectors are one point with its smallest ids, so a common vector is
searched once; large blocks are split (``TASK_ROWS``) over tasks.

Nulls and edges: null ids, null, empty or zero vectors, and vectors with null or
non-finite components take no part, nor do vectors of another length than
the commonest; of several vectors of one id the smallest counts; with fewer
rows than a window all are searched; ties go to the smaller id; extra columns
are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.reuse import materialize

CURVES, DIMENSIONS, BITS = 12, 8, 6
#: Blocks of a curve; a query searches its own and REACH on either side.
BLOCKS, REACH = 24, 1
#: A block never holds fewer rows than this on purpose (small tables get fewer blocks).
LEAST_ROWS = 512
#: Rows the index is fitted on, rows of a block that one task searches, queries it answers.
SAMPLE, TASK_ROWS, TASK_QUERIES = 20_000, 20_000, 2_000
SEED = 1


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Position on the Hilbert curve of integer cells (n, d) with ``bits`` per axis
    (Skilling's axes-to-transpose rule, applied to all rows at once)."""
    x = cells.astype(np.int64).T.copy()
    d = len(x)
    q = 1 << (bits - 1)
    while q > 1:
        low = q - 1
        for i in range(d):
            up = (x[i] & q) != 0
            swap = np.where(up, 0, (x[0] ^ x[i]) & low)
            x[0] ^= np.where(up, low, swap)
            x[i] ^= swap
        q >>= 1
    for i in range(1, d):
        x[i] ^= x[i - 1]
    t = np.zeros(x.shape[1], dtype=np.int64)
    q = 1 << (bits - 1)
    while q > 1:
        t ^= np.where((x[d - 1] & q) != 0, q - 1, 0)
        q >>= 1
    x ^= t
    key = np.zeros(x.shape[1], dtype=np.int64)
    for b in range(bits - 1, -1, -1):
        for i in range(d):
            key = key << 1 | (x[i] >> b) & 1
    return key


class Curves:
    """Projections, shifts and block borders, fitted on a sample (rows of vectors)."""

    def __init__(self, sample: np.ndarray, blocks: int, curves: int = CURVES, dimensions: int = DIMENSIONS, bits: int = BITS):
        rng = np.random.default_rng(SEED)
        n_dim = sample.shape[1]
        self.bits = bits
        self.axes = [np.linalg.qr(rng.standard_normal((n_dim, min(dimensions, n_dim))))[0] for _ in range(curves)]
        self.shift = [rng.random(a.shape[1]) for a in self.axes]
        self.low, self.span = [], []
        for a in self.axes:
            low, high = np.quantile(sample @ a, (0.005, 0.995), axis=0)
            self.low.append(low)
            self.span.append(np.where(high > low, high - low, 1.0))
        part = np.arange(1, blocks) / blocks
        keys = self.keys(sample)
        self.borders = [np.quantile(k, part, method="lower") if blocks > 1 else np.zeros(0, np.int64) for k in keys]

    def keys(self, x: np.ndarray) -> list[np.ndarray]:
        """Key of every row on every curve. The sampled range covers half of an
        axis and the shift moves it within the rest; values outside are clipped."""
        out = []
        for a, s, low, span in zip(self.axes, self.shift, self.low, self.span):
            with np.errstate(all="ignore"):
                unit = np.clip(np.nan_to_num((x @ a - low) / span), -0.5, 1.5)
            cell = np.clip((0.25 + 0.5 * unit + 0.25 * (2 * s - 1)) * (1 << self.bits), 0, (1 << self.bits) - 1)
            out.append(hilbert_keys(cell.astype(np.int64), self.bits))
        return out

    def blocks(self, x: np.ndarray) -> np.ndarray:
        """(curves, rows) block numbers."""
        return np.array([np.searchsorted(b, k, side="right") for b, k in zip(self.borders, self.keys(x))])


def matrix(column: pa.Array) -> np.ndarray:
    """Rows of an equal-length list column as a float64 matrix."""
    n = len(column)
    return np.asarray(column.flatten(), dtype=np.float64).reshape(n, -1)


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """id, v (array<double>), one row per id: vectors that can take part."""
    v = F.col(vector_col).cast("array<double>")
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), v.alias("v")).filter("id is not null and v is not null").filter(fine)
    rows = materialize(rows.groupBy("id").agg(F.min("v").alias("v")))
    size = rows.groupBy(F.size("v").alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "d").first()
    return rows.filter(F.size("v") == size["d"]) if size else rows


def block_batches(curves: Curves, splits: int):
    """mapInArrow function: (point, v, salt) -> curve, block, part, point, v for every curve."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo in range(0, b.num_rows, 2048):
                s = b.slice(lo, 2048)
                x = matrix(s.column("v"))
                part = np.asarray(s.column("salt")) % splits
                for c, block in enumerate(curves.blocks(x)):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(x), c, np.int32)), pa.array(block.astype(np.int32)), pa.array(part.astype(np.int32)),
                         s.column("point"), s.column("v")], names=["curve", "block", "part", "point", "v"])
    return run


def asked_batches(curves: Curves, blocks: int, reach: int, splits: int, chunks: int):
    """mapInArrow function: (query_id, v, salt) -> one row per curve, window block and part."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo in range(0, b.num_rows, 2048):
                s = b.slice(lo, 2048)
                x = matrix(s.column("v"))
                chunk = (np.asarray(s.column("salt")) % chunks).astype(np.int32)
                for c, own in enumerate(curves.blocks(x)):
                    for step in range(-reach, reach + 1):
                        block = own + step
                        ok = np.flatnonzero((block >= 0) & (block < blocks))
                        row = pa.array(ok)
                        for part in range(splits):
                            yield pa.RecordBatch.from_arrays(
                                [pa.array(np.full(len(ok), c, np.int32)), pa.array(block[ok].astype(np.int32)),
                                 pa.array(np.full(len(ok), part, np.int32)), pa.array(chunk[ok]),
                                 s.column("query_id").take(row), s.column("v").take(row)],
                                names=["curve", "block", "part", "chunk", "query_id", "v"])
    return run


def distances(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Euclidean distance of one vector to rows, by direct differences in double."""
    return np.sqrt(np.square(x - q).sum(axis=1))


def window_search(k: int):
    """cogroup function: the queries and the points of one window -> each query's nearest points."""
    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        found: dict[str, list] = {"query_id": [], "point": [], "score": []}
        if len(left) and len(right):
            q, x = np.stack(left["v"].to_numpy()), np.stack(right["v"].to_numpy())
            point = right["point"].to_numpy()
            with np.errstate(all="ignore"):
                norm = np.square(x).sum(axis=1)
                for lo in range(0, len(q), 128):
                    # Squared distances up to rounding, to find all that can be among the nearest; then exact ones.
                    own = np.square(q[lo:lo + 128]).sum(axis=1)
                    rough = own[:, None] + norm[None] - 2 * (q[lo:lo + 128] @ x.T)
                    slack = 1e-12 * (own + norm.max())
                    # One more than k: the query's own point may be among them.
                    kth = np.partition(rough, min(k, rough.shape[1] - 1), axis=1)[:, min(k, rough.shape[1] - 1)]
                    for i in range(len(rough)):
                        near = np.flatnonzero(~(rough[i] > kth[i] + 2 * slack[i]))
                        score = distances(q[lo + i], x[near])
                        order = np.lexsort((point[near], score))
                        keep = order[score[order] <= score[order][min(k, len(order) - 1)]] if len(order) > k + 1 else order
                        found["query_id"].append(np.full(len(keep), left["query_id"].iloc[lo + i]))
                        found["point"].append(point[near][keep])
                        found["score"].append(score[keep])
        return pd.DataFrame({n: np.concatenate(v) if v else np.zeros(0, np.float64 if n == "score" else np.int64) for n, v in found.items()})
    return run


def nearest(vectors: DataFrame, is_query: Column, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding",
            blocks: int = BLOCKS, reach: int = REACH, curves: int = CURVES) -> DataFrame:
    """For every row of vectors for which ``is_query`` (a condition on ``id``) holds:
    query_id, rank (from 1), vec_id, score of its k nearest other rows found."""
    rows = usable(vectors, id_col, vector_col)
    schema = "query_id long, rank int, vec_id long, score double"
    # Equal vectors are one point: its number and its k + 1 smallest ids.
    ranked = rows.withColumn("nth", F.row_number().over(Window.partitionBy("v").orderBy("id"))).filter(F.col("nth") <= k + 1)
    points = materialize(ranked.groupBy("v").agg(F.min("id").alias("point"), F.sort_array(F.collect_list("id")).alias("ids")))
    n = points.count()
    if n == 0:
        return vectors.sparkSession.createDataFrame([], schema)
    salted = points.select("point", "v", F.pmod(F.xxhash64("point"), F.lit(1 << 20)).alias("salt"))
    sample = np.array([r.v for r in salted.orderBy(F.xxhash64("point"), "point").limit(SAMPLE).select("v").collect()], dtype=np.float64)
    blocks = max(1, min(blocks, n // LEAST_ROWS))
    fitted = Curves(sample, blocks, curves)
    splits = max(1, -(-n // (blocks * TASK_ROWS)))
    queries = rows.filter(is_query).select(F.col("id").alias("query_id"), "v", F.pmod(F.xxhash64("id"), F.lit(1 << 20)).alias("salt"))
    queries = materialize(queries)
    chunks = max(1, -(-queries.count() * (2 * reach + 1) // (blocks * TASK_QUERIES)))
    indexed = salted.mapInArrow(block_batches(fitted, splits), "curve int, block int, part int, point long, v array<double>")
    indexed = indexed.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))))
    asked = queries.mapInArrow(asked_batches(fitted, blocks, reach, splits, chunks),
                               "curve int, block int, part int, chunk int, query_id long, v array<double>")
    key = ["curve", "block", "part", "chunk"]
    search = window_search(k)
    found = asked.groupBy(*key).cogroup(indexed.groupBy(*key)).applyInPandas(search, "query_id long, point long, score double").distinct()
    # Points back to ids, the query's own left out.
    ids = materialize(points.select("point", "ids"))
    out = found.join(ids, "point").select("query_id", "score", F.explode("ids").alias("vec_id")).filter("vec_id <> query_id")
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    out = out.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return out.select("query_id", "rank", "vec_id", "score")
