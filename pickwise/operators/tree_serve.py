"""I2, L6, J3 for tree ensembles: the cheapest plant of every demand without
scoring all pairs.

* An ensemble is a small table of nodes. Its split thresholds cut every
  feature into bins; rows whose features fall into the same bins (a cell) get
  the same prediction from every tree, so demands and plants are reduced to
  their distinct cells first.
* Plant cells are put into a hierarchy: sorted by their bins, ``LEAF`` cells make
  a leaf box, ``FANOUT`` boxes the next one, up to a few top boxes. A box holds
  the lowest and highest bin per feature.
* Search runs down the hierarchy as Spark joins: every demand cell carries a
  list of boxes that may hold its best plant. One round joins them with their
  children and finds, from the leaves that a tree can reach inside the box, a
  lower and an upper bound of the prediction. A box whose lower bound lies above
  the smallest upper bound of that demand cell is dropped. Only the plant cells of the
  last boxes are scored.
* On the last level a box is a single cell, so lower and upper bound are
  the prediction itself; ties go to the smallest plant key.

The result is exact for any ensemble; how many boxes survive depends on it
(``bounded`` reports the pairs looked at). Nothing but the ensemble (whose size
is set by trees and depth) goes to every task, and demands are never grouped
by anything but their own cell.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from ..functions.ranking import with_global_index
from ..functions.reuse import materialize, reusable
from ..session import ensure_checkpoint_dir

#: Plant cells of a leaf box, and boxes of a higher one.
LEAF, FANOUT = 16, 8
#: Node visits that one vectorised step may hold.
STEP_VISITS = 2_000_000


@dataclass
class Ensemble:
    """Nodes of all trees as arrays: feature (-1: leaf), bin of the threshold (a row goes
    left if its bin is at most this), children, value; the root and weight of every tree."""
    features: list[str]
    cuts: list[np.ndarray]
    feature: np.ndarray
    bin: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    weights: np.ndarray
    divisor: float = 1.0

    def bounds(self, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Lower and upper bound of the prediction over boxes of bins (rows x features).
        With lo == hi both are the prediction, summed over the trees in order."""
        n, trees = len(lo), len(self.roots)
        low, high = np.zeros(n), np.zeros(n)
        step = max(1, STEP_VISITS // max(1, trees))
        for a in range(0, n, step):
            b = min(n, a + step)
            least, most = np.full((trees, b - a), np.inf), np.full((trees, b - a), -np.inf)
            row = np.tile(np.arange(b - a), trees)
            tree = np.repeat(np.arange(trees), b - a)
            node = np.repeat(self.roots, b - a)
            while len(node):
                leaf = self.feature[node] < 0
                if leaf.any():
                    at = (tree[leaf], row[leaf])
                    np.minimum.at(least, at, self.value[node[leaf]])
                    np.maximum.at(most, at, self.value[node[leaf]])
                    row, tree, node = row[~leaf], tree[~leaf], node[~leaf]
                f, cut = self.feature[node], self.bin[node]
                go_left, go_right = lo[a + row, f] <= cut, hi[a + row, f] > cut
                row = np.concatenate((row[go_left], row[go_right]))
                tree = np.concatenate((tree[go_left], tree[go_right]))
                node = np.concatenate((self.left[node[go_left]], self.right[node[go_right]]))
            for t in range(trees):
                w = self.weights[t]
                low[a:b] += w * (least[t] if w >= 0 else most[t])
                high[a:b] += w * (most[t] if w >= 0 else least[t])
        return low / self.divisor, high / self.divisor


def ensemble_of(nodes: list[tuple], features: list[str], weights: dict[int, float] | None = None, divisor: float = 1.0) -> Ensemble:
    """Nodes (tree, id, prediction, left, right, feature, threshold), feature < 0 for a
    leaf; ids are unique inside a tree and its root has the smallest."""
    nodes = sorted(nodes)
    place = {(t, i): k for k, (t, i, *_) in enumerate(nodes)}
    cuts = [np.unique([x[6] for x in nodes if x[5] == f]) for f in range(len(features))]
    columns = list(zip(*nodes))
    feature = np.array(columns[5], dtype=np.int64)
    bins = np.array([np.searchsorted(cuts[f], thr) if f >= 0 else 0 for f, thr in zip(columns[5], columns[6])], dtype=np.int64)
    child = [np.array([place[(t, c)] if f >= 0 else 0 for t, c, f in zip(columns[0], columns[k], columns[5])], dtype=np.int64) for k in (3, 4)]
    trees, roots = np.unique(np.array(columns[0]), return_index=True)
    w = np.array([(weights or {}).get(int(t), 1.0) for t in trees])
    return Ensemble(features, cuts, feature, bins, *child, np.array(columns[2], dtype=np.float64), roots, w, divisor)


def model_ensemble(model, spark) -> Ensemble:
    """The nodes of a fitted MLlib forest or boosting model. They are read from the table
    that MLlib itself writes (to the shared checkpoint folder); their
    number is bounded by trees and depth, not by data."""
    stage = model.pipeline.stages[-1]
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/ensemble-{uuid.uuid4()}"
    stage.write().save(path)
    n = "nodeData"
    rows = spark.read.parquet(f"{path}/data").select(
        "treeID", f"{n}.id", f"{n}.prediction", f"{n}.leftChild", f"{n}.rightChild", f"{n}.split.featureIndex",
        F.expr(f"try_element_at({n}.split.leftCategoriesOrThreshold, 1)").alias("thr"), f"{n}.split.numCategories").collect()
    if any(r.featureIndex >= 0 and r.numCategories >= 0 for r in rows):
        raise ValueError("categorical splits are not supported")
    nodes = [(r.treeID, r.id, r.prediction, r.leftChild, r.rightChild, r.featureIndex if r.leftChild >= 0 else -1, r.thr) for r in rows]
    boosted = model.model_type == "gradient_boosting"
    weights = dict(enumerate(stage.treeWeights)) if boosted else None
    return ensemble_of(nodes, list(model.features), weights, 1.0 if boosted else float(stage.getNumTrees))


def _with_bins(df: DataFrame, ens: Ensemble, features: list[str], name: str) -> DataFrame:
    """df with the array of its features' bin numbers: how many cuts lie below the value."""
    cuts = [ens.cuts[ens.features.index(f)] for f in features]

    @pandas_udf("array<int>")
    def bins(rows: Iterator[pd.DataFrame]) -> Iterator[pd.Series]:
        for x in rows:
            out = np.stack([np.searchsorted(c, x.iloc[:, k].to_numpy(np.float64), side="left") for k, c in enumerate(cuts)], axis=1)
            yield pd.Series(list(out.astype(np.int32)), index=x.index)

    if not features:
        return df.withColumn(name, F.array().cast("array<int>"))
    return df.withColumn(name, bins(F.struct(*[F.col(f).cast("double").alias(f) for f in features])))


def plant_boxes(cells: DataFrame, n_cells: int, leaf: int, fanout: int) -> list[DataFrame]:
    """Levels of boxes over plant cells (place, p), cells first: box, up (the box above), lo, hi."""
    levels = [cells.select(F.col("place").alias("box"), F.expr(f"place div {leaf}").alias("up"), F.col("p").alias("lo"), F.col("p").alias("hi"))]
    n, width = n_cells, leaf
    while n > 1:
        lowest = F.expr("aggregate(los, los[0], (a, x) -> zip_with(a, x, (u, v) -> least(u, v)))")
        highest = F.expr("aggregate(his, his[0], (a, x) -> zip_with(a, x, (u, v) -> greatest(u, v)))")
        up = levels[-1].groupBy("up").agg(F.collect_list("lo").alias("los"), F.collect_list("hi").alias("his"))
        levels.append(materialize(up.select(F.col("up").alias("box"), F.expr(f"up div {fanout}").alias("up"), lowest.alias("lo"), highest.alias("hi"))))
        n, width = math.ceil(n / width), fanout
    return levels


def _bound_batches(ens: Ensemble, mine: list[int], theirs: list[int]):
    """mapInPandas function: (cell, d, box, lo, hi) -> cell, box, low, high."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for x in batches:
            if not len(x):
                continue
            lo = np.empty((len(x), len(ens.features)), dtype=np.int64)
            hi = lo.copy()
            if mine:
                lo[:, mine] = hi[:, mine] = np.stack(x["d"].to_numpy())
            if theirs:
                lo[:, theirs], hi[:, theirs] = np.stack(x["lo"].to_numpy()), np.stack(x["hi"].to_numpy())
            low, high = ens.bounds(lo, hi)
            yield pd.DataFrame({"cell": x["cell"], "box": x["box"], "low": low, "high": high})
    return run


@dataclass
class TreeServing:
    """picks: demand, plant, info..., prediction; bounded: pairs of demand cell and box
    looked at on each level (top first, the last one are scored cells); all_pairs: demands x plants."""
    picks: DataFrame
    bounded: list[int]
    all_pairs: int


def best_plant_trees(ens: Ensemble, demands: DataFrame, plants: DataFrame, demand_key: str = "demand_id", plant_key: str = "plant_id",
                     plant_info: list[str] | None = None, plant_order: str | None = None, leaf: int = LEAF, fanout: int = FANOUT) -> TreeServing:
    """The plant with the lowest prediction for every demand row. Ties go to the first
    plant by ``plant_order``, then to the smallest plant key; a plant with a missing feature is never picked, a demand
    with one gets no plant. Repeated plant keys are separate candidates."""
    info = list(plant_info or [])
    mine = [f for f in ens.features if f in demands.columns]
    theirs = [f for f in ens.features if f not in mine]
    spark = demands.sparkSession
    demands = reusable(demands.select(demand_key, *mine))
    binned = materialize(_with_bins(demands.na.drop(subset=mine), ens, mine, "d").select(F.col(demand_key).alias("__dk"), *mine, "d"))
    tie = [F.col(plant_order).alias("__po")] if plant_order else []
    usable = plants.select(plant_key, *info, *theirs, *tie).na.drop(subset=[plant_key, *theirs])
    rank = F.struct(*(["__po"] if tie else []), F.col(plant_key).alias("k"), *info)
    cells = _with_bins(usable, ens, theirs, "p").groupBy("p").agg(F.min(rank).alias("best"), F.count(F.lit(1)).alias("n"))
    cells = materialize(with_global_index(cells, ["p"], "place"))
    d_cells = binned.select("d").distinct()
    d_cells = materialize(d_cells.select(F.monotonically_increasing_id().alias("cell"), "d"))
    size = cells.agg(F.count(F.lit(1)).alias("cells"), F.sum("n").alias("plants")).first()
    looked: list[int] = []
    types = dict(demands.select(demand_key).dtypes) | dict(plants.select(plant_key, *info).dtypes)
    schema = ", ".join([f"`{demand_key}` {types[demand_key]}", f"`selected_plant` {types[plant_key]}", *[f"`{c}` {types[c]}" for c in info], "raw_prediction double"])
    if not size.cells:
        nothing = demands.select(demand_key, *[F.lit(None).cast(t).alias(c) for c, t in [("selected_plant", types[plant_key]), *[(c, types[c]) for c in info]]],
                                 F.lit(None).cast("double").alias("raw_prediction"))
        return TreeServing(nothing, looked, 0)
    levels = plant_boxes(cells, size.cells, leaf, fanout)
    # The top level is one box; a round looks at the children of the boxes left over.
    left = d_cells.withColumn("up", F.lit(0).cast("long"))
    columns = [ens.features.index(f) for f in mine], [ens.features.index(f) for f in theirs]
    for level in reversed(levels[:-1] if len(levels) > 1 else levels):
        pairs = left.join(level.hint("rebalance"), "up").select("cell", "d", "box", "lo", "hi")
        found = materialize(pairs.select("cell", "d", "box", "lo", "hi").mapInPandas(
            _bound_batches(ens, *columns), "cell long, box long, low double, high double"))
        looked.append(found.count())
        least = found.groupBy("cell").agg(F.min("high").alias("least"))
        kept = found.join(least.hint("rebalance"), "cell").filter(F.col("low") <= F.col("least"))
        left = kept.select("cell", F.col("box").alias("up")).join(d_cells.hint("rebalance"), "cell")
    # The boxes are cells now, and those left over share the lowest prediction.
    best = kept.join(cells.select(F.col("place").alias("box"), "best").hint("rebalance"), "box").groupBy("cell").agg(
        F.min("best").alias("best"), F.min("low").alias("raw_prediction"))
    by_bins = best.join(d_cells, "cell").select("d", "best", "raw_prediction")
    chosen = binned.select("__dk", *mine, "d").join(by_bins.hint("rebalance"), "d")
    # Back to the demand rows: those without a cell keep null.
    gaps = demands.filter(F.greatest(F.lit(False), *[F.col(f).isNull() for f in mine])) if mine else demands.limit(0)
    picks = chosen.select(F.col("__dk").alias(demand_key), F.col("best.k").alias("selected_plant"), *[F.col("best")[c].alias(c) for c in info], "raw_prediction")
    missing = gaps.select(demand_key, F.lit(None).cast(types[plant_key]).alias("selected_plant"),
                          *[F.lit(None).cast(types[c]).alias(c) for c in info], F.lit(None).cast("double").alias("raw_prediction"))
    return TreeServing(picks.unionByName(missing), looked, demands.count() * size.plants)

