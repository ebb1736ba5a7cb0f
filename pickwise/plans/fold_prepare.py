"""Leave-one-demand-out with preprocessing per fold (P5-P8, A1-A3, G3), by
down-dating: no fold reads the data again.

What a refit of the preprocessor without demand d would give:

* Scalers: the sums of the demand table less those of d's rows.
* Plant medians: without d's cost a plant's median follows from the three values in the
  middle of its costs (``selection.middle_values``) and whether d's cost lies below, at or above.
* Cut-off: the wanted rank of the plant medians moves by the plants whose median crosses it.
  The ``reach`` medians on either side of the common cut-off decide it; a fold
  whose rank leaves this window gets a window four times as wide, until it is inside.
* Training rows: those of the plants within the fold's cut-off but for d's own. Their statistics
  are a prefix sum over plants in order of median, corrected by the plants whose flag d's cost decides. A pair
  is judged only if its plant's median lies, with or without it, between the lowest and the highest cut-off of any
  fold; sums of plant features and costs per demand stand for the others, as demand features are the same in all of
  them. So the pairs are kept as (demand, plant, cost) and never written with their features, and
  statistics per plant are made for the plants between the cut-offs or with a decided flag alone.
* Scaled features: the statistics hold centred values z (0 where missing) and a
  mark u of presence, so that (z - m u) / s, the fold's scaled and mean-filled value, is linear in them.

The held-out rows of d are its costs on the fold's good plants; missing features of d take the
fold's mean. Plant features are scaled once, as no fold changes the plant table.

Nulls and edges: demand rows and costs without a demand key belong to no fold but count in all; several costs
of one (demand, plant) pair count as the smallest; null costs count nowhere; a fold that leaves no cost at
all has no threshold, one that leaves no training row or no value of a feature has no model; a spread
below 1e-6 of the whole table's counts as none (divided by one).
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import discover_features
from ..functions.quantiles import grouped_quantiles
from ..functions.reuse import beside, few, materialize
from ..functions.selection import middle_values
from ..operators.combine import COST, DEMAND, PLANT, first_per_key
from ..operators.prepare import Preprocessor, ScalerParams, fit_scaler
from ..operators.regret import scenario_table
from . import gram

#: Plant medians on either side of the common cut-off that come to the driver first.
REACH = 256
#: Folds that one task solves.
SOLVES_PER_TASK = 2000
_NO_SPREAD = 1e-6


@dataclass
class FoldPreprocessing:
    """``folds``: the demand key, ``m_i`` and ``s_i`` (mean and spread of demand feature i in
    units of the common scaler) and ``threshold``. ``pairs``: every (demand, plant, cost) with the
    plant's median with (``old``) and without (``new``) it, joined again wherever it is read if the plants are few.
    ``medians``: plant and ``old``."""
    settings: Preprocessor
    demand_features: list[str]
    plant_features: list[str]
    scaler: ScalerParams
    folds: DataFrame
    pairs: DataFrame
    medians: DataFrame
    steps: list[float]

    def parameters(self) -> DataFrame:
        """Per fold: mean and standard deviation of every demand feature, and the cut-off."""
        cols = []
        for i, f in enumerate(self.demand_features):
            mean, std = self.scaler.means[i], self.scaler.stds[i]
            cols.append((F.lit(mean) + F.lit(std) * F.col(f"m_{i}")).alias(f"{f}__mean"))
            cols.append((F.lit(std) * F.col(f"s_{i}")).alias(f"{f}__std"))
        return self.folds.select(self.settings.demand_key, *cols, "threshold")


def _unit(std: float | None) -> float:
    return std if std else 1.0


def fold_scalers(demand: DataFrame, features: list[str], key: str) -> tuple[ScalerParams, DataFrame]:
    """The common scaler of the present values, and per demand key m_i and s_i of the table without it
    (mean and standard deviation after filling with the fold's mean, in units of the common scaler)."""
    base = fit_scaler(demand, features)
    z = [(F.col(f).cast("double") - F.lit(m)) / F.lit(_unit(s)) for f, m, s in zip(features, base.means, base.stds)]
    aggs = [F.count(F.lit(1)).alias("n")]
    for i, x in enumerate(z):
        aggs += [F.count(x).alias(f"c_{i}"), F.coalesce(F.sum(x), F.lit(0.0)).alias(f"t_{i}"), F.coalesce(F.sum(x * x), F.lit(0.0)).alias(f"q_{i}")]
    whole = demand.agg(*aggs).first()
    own = demand.filter(F.col(key).isNotNull()).groupBy(key).agg(*aggs)
    cols = []
    for i in range(len(features)):
        left, rows = F.nullif(F.lit(whole[f"c_{i}"]) - F.col(f"c_{i}"), F.lit(0)), F.nullif(F.lit(whole["n"]) - F.col("n"), F.lit(0))
        mean = (F.lit(whole[f"t_{i}"]) - F.col(f"t_{i}")) / left
        var = ((F.lit(whole[f"q_{i}"]) - F.col(f"q_{i}")) / left - mean * mean) * left / rows
        spread = F.sqrt(F.greatest(var, F.lit(0.0)))
        cols += [mean.alias(f"m_{i}"), F.when(mean.isNotNull(), F.when(spread < _NO_SPREAD, 0.0).otherwise(spread)).alias(f"s_{i}")]
    # In units of a spread of 1 where the column has none: parameters() multiplies it back.
    scaler = ScalerParams(list(features), [m if m is not None else 0.0 for m in base.means], [_unit(s) for s in base.stds])
    return scaler, own.select(key, *cols)


def median_changes(costs: DataFrame, demand_key: str, plant_key: str, cost: str) -> tuple[DataFrame, DataFrame]:
    """(plant, old, n) for every plant with costs, and (demand, plant, cost, old, new) for every
    pair: the plant's median with and without the pair's cost (null: no cost is left)."""
    rows = costs.select(demand_key, plant_key, F.col(cost).cast("double").alias(cost)).filter(F.col(plant_key).isNotNull() & F.col(cost).isNotNull())
    # One row per pair; each cost without a demand is a row. A partitioning of the costs by the pair is kept.
    alone = F.when(F.col(demand_key).isNull(), F.monotonically_increasing_id())
    rows = rows.withColumn("__alone", alone).groupBy(demand_key, plant_key, "__alone").agg(F.min(cost).alias(cost)).drop("__alone")
    rows = materialize(rows)
    odd = F.col("n") % 2 == 1
    middle = middle_values(rows, [plant_key], cost)
    middle = materialize(middle.withColumn("old", F.when(odd, F.col("at")).otherwise(_between("at", "above"))))
    x = F.col(cost)
    new = F.when(F.col("n") == 1, F.lit(None).cast("double")) \
        .when(odd & (x < F.col("at")), _between("at", "above")).when(odd & (x > F.col("at")), _between("below", "at")) \
        .when(odd, _between("below", "above")).when(x <= F.col("at"), F.col("above")).otherwise(F.col("at"))
    cheap = few(middle)
    pairs = rows.filter(F.col(demand_key).isNotNull()).join(F.broadcast(middle) if cheap else middle.hint("rebalance"), plant_key)
    pairs = pairs.select(demand_key, plant_key, cost, "old", new.alias("new"))
    return middle.select(plant_key, "old", "n"), pairs if cheap else materialize(pairs)


def _between(a: str, b: str) -> Column:
    return F.col(a) + (F.col(b) - F.col(a)) * 0.5


def fold_thresholds(medians: DataFrame, pairs: DataFrame, demand_key: str, plant_key: str, percentile: float,
                    reach: int = REACH) -> tuple[DataFrame, float | None, list[float]]:
    """(demand, threshold) for the folds that may differ from the common cut-off, the common
    cut-off, and the ordered distinct medians around it that hold every threshold between them."""
    q = float(percentile) / 100.0
    n_plants = medians.count()
    kind = pairs.schema[plant_key].dataType
    done = pairs.sparkSession.createDataFrame([], f"{demand_key} {pairs.schema[demand_key].dataType.simpleString()}, threshold double")
    if n_plants == 0:
        return done, None, []
    cut = grouped_quantiles(medians, [], "old", {"t": q}).first()["t"]
    order, todo = [F.col("old"), F.col(plant_key)], pairs
    while True:
        # At most 2 * reach rows, the medians next to the cut-off in order of (median, plant).
        lower = medians.filter(F.col("old") <= cut).orderBy(*[c.desc() for c in order]).limit(reach).select("old", plant_key).collect()
        upper = medians.filter(F.col("old") > cut).orderBy(*order).limit(reach).select("old", plant_key).collect()
        window = lower[::-1] + upper
        n_before = medians.filter(F.col("old") <= cut).count() - len(lower)
        n_after = n_plants - n_before - len(window)
        ends = [F.struct(F.lit(r["old"]).alias("old"), F.lit(r[plant_key]).cast(kind).alias(plant_key)) for r in (window[0], window[-1])]
        place = F.struct("old", plant_key)
        was = F.when(place < ends[0], -1).when(place > ends[1], 1).otherwise(0)
        low, high = (window[0]["old"] if n_before else -math.inf), (window[-1]["old"] if n_after else math.inf)
        now = F.when(F.col("new") < low, -1).when(F.col("new") > high, 1).when(F.col("new").isNotNull(), 0)
        at = F.array_position(F.array(*[F.lit(r[plant_key]).cast(kind) for r in window]), F.col(plant_key)).cast("int")
        moved = todo.select(demand_key, "new", was.alias("was"), now.alias("now"), at.alias("at")).filter(~F.col("was").eqNullSafe(F.col("now")) | (F.col("was") == 0))
        per_fold = moved.groupBy(demand_key).agg(
            (F.lit(n_before) + F.count_if(F.col("now") == -1) - F.count_if(F.col("was") == -1)).alias("before"),
            (F.lit(n_plants) - F.count_if(F.col("now").isNull())).alias("n"),
            F.collect_list(F.when(F.col("was") == 0, F.col("at"))).alias("gone"),
            F.collect_list(F.when(F.col("now") == 0, F.col("new"))).alias("added"))
        kept = F.filter(F.array(*[F.lit(r["old"]) for r in window]), lambda _, i: ~F.array_contains(F.col("gone"), i + 1))
        rank = (F.col("n") - 1) * F.lit(q)
        values = per_fold.select(demand_key, "n", "before", F.array_sort(F.concat(kept, "added")).alias("v"), rank.alias("rank"))
        lo, hi = (F.floor("rank") - F.col("before")).cast("int"), (F.ceil("rank") - F.col("before")).cast("int")
        inside = (F.col("n") <= 0) | ((lo >= 0) & (hi < F.size("v")))
        x, y = F.get("v", F.greatest(lo, F.lit(0))), F.get("v", F.greatest(hi, F.lit(0)))
        value = F.when(F.col("n") > 0, x + (y - x) * (F.col("rank") - F.floor("rank")))
        found = materialize(values.select(demand_key, value.alias("threshold"), inside.alias("inside")))
        done = done.unionByName(found.filter("inside").drop("inside"))
        open_folds = found.filter("not inside").select(demand_key)
        if (n_before == 0 and n_after == 0) or open_folds.isEmpty():
            return done, cut, sorted({r["old"] for r in window})
        todo, reach = todo.join(open_folds.hint("rebalance"), demand_key, "left_semi"), reach * 4


def fit_folds(demand: DataFrame, plants: DataFrame, costs: DataFrame, settings: Preprocessor | None = None,
              reach: int = REACH) -> FoldPreprocessing:
    """The preprocessor's parameters without each demand in turn."""
    s = settings or Preprocessor()
    if s.missing_value_strategy != "mean":
        raise ValueError("preprocessing per fold fills with the mean; other strategies are not down-dated")
    dfeat, pfeat = discover_features(demand, s.demand_prefix), discover_features(plants, s.plant_prefix)
    scaler, scalers = fold_scalers(demand, dfeat, s.demand_key)
    medians, pairs = median_changes(costs, s.demand_key, s.plant_key, s.cost)
    special, cut, steps = fold_thresholds(medians, pairs, s.demand_key, s.plant_key, s.plant_filter_percentile, reach)
    special = special.withColumn("special", F.lit(True))
    folds = scalers.join(special, s.demand_key, "left").withColumn(
        "threshold", F.when(F.col("special"), F.col("threshold")).otherwise(F.lit(cut).cast("double"))).drop("special")
    return FoldPreprocessing(s, dfeat, pfeat, scaler, materialize(folds), pairs, medians, steps)


@dataclass
class FoldSystems:
    """``folds``: per demand its fold's preprocessing, features (``z_i``, ``u_i``), the sums over its own held-out rows
    (``b_``: ``gram.stat_columns`` of the plant features), ``slot``, its place in ``prefix`` (the statistics of all
    plants up to a cut-off), and ``moved``, the statistics of plants whose flag its costs decide. ``plants``: plant features.
    ``least`` and ``most``: the lowest and the highest cut-off."""
    fitted: FoldPreprocessing
    folds: DataFrame
    plants: DataFrame
    columns: list[str]
    marks: list[int]
    prefix: DataFrame
    least: float | None
    most: float | None

    @property
    def stats(self) -> DataFrame:
        """Per fold the statistics of its training rows, with ``n_held_out``."""
        return self.statistics(self.folds)

    def statistics(self, folds: DataFrame) -> DataFrame:
        p, names = len(self.fitted.plant_features), gram.stat_columns(len(self.columns))
        own = gram.widened([F.col(c) for c in self.columns[:len(self.columns) - p]], _own(p), p)
        kept = [c for c in folds.columns if not c.startswith("b_") and c not in ("slot", "moved")]
        sums = [(F.col(c) + F.coalesce(F.col("moved")[i], F.lit(0.0)) - x).alias(c) for i, (c, x) in enumerate(zip(names, own))]
        return folds.join(F.broadcast(self.prefix), "slot").select(*kept, *sums, F.round("b_n").cast("long").alias("n_held_out"))


def _own(p: int) -> list[Column]:
    return [F.col(f"b_{c}") for c in gram.stat_columns(p)]


def _slot(x: Column, steps: list[float]) -> Column:
    """How many of the steps are at most x."""
    return F.size(F.filter(F.array(*[F.lit(v) for v in steps]), lambda v: v <= x)) if steps else F.lit(0)


def _with_plants(pairs: DataFrame, plants: DataFrame, key: str, plant: str) -> tuple[DataFrame, bool]:
    """The pairs with the plants' features, and whether they are dealt by ``key`` (narrow, before a broadcast join)."""
    if few(plants):
        return pairs.hint("rebalance", F.col(key)).join(F.broadcast(plants), plant), True
    return pairs.join(plants.hint("rebalance"), plant), False


def fold_systems(fitted: FoldPreprocessing, demand: DataFrame, plants: DataFrame) -> FoldSystems:
    """Gram statistics of every fold's training rows, from one pass over the pairs."""
    s = fitted.settings
    key, plant = s.demand_key, s.plant_key
    dfeat, pfeat = fitted.demand_features, fitted.plant_features
    present = demand.agg(F.count(F.lit(1)).alias("__n"), *[F.count(F.col(f).cast("double")).alias(f) for f in dfeat]).first()
    marks = [i for i, f in enumerate(dfeat) if present[f] < present["__n"]]        # features with a missing value somewhere
    d = first_per_key(demand, key, dfeat) if dfeat else demand.select(key).distinct()
    z = [(F.col(f).cast("double") - F.lit(m)) / F.lit(sd) for f, m, sd in zip(dfeat, fitted.scaler.means, fitted.scaler.stds)]
    d = d.select(F.col(key).alias(DEMAND), *[F.coalesce(x, F.lit(0.0)).alias(f"z_{i}") for i, x in enumerate(z)],
                 *[F.col(dfeat[i]).isNotNull().cast("double").alias(f"u_{i}") for i in marks])
    p = fit_scaler(plants, pfeat).apply(first_per_key(plants, plant, pfeat)).na.drop(how="any") if pfeat else plants.select(plant).distinct()
    p = materialize(p.select(F.col(plant).alias(PLANT), *pfeat))
    side = [f"z_{i}" for i in range(len(dfeat))] + [f"u_{i}" for i in marks]
    columns, names, narrow = side + list(pfeat), gram.stat_columns(len(side) + len(pfeat)), gram.stat_columns(len(pfeat))
    pairs = fitted.pairs.select(F.col(key).alias(DEMAND), F.col(plant).alias(PLANT), F.col(s.cost).alias(COST), "old", "new")
    ends = fitted.folds.agg(F.min("threshold").alias("least"), F.max("threshold").alias("most")).first()
    least, most = F.lit(ends["least"]).cast("double"), F.lit(ends["most"]).cast("double")
    steps = [v for v in fitted.steps if ends["least"] is not None and ends["least"] < v <= ends["most"]]
    # Per demand the sums over its pairs with plants within every cut-off.
    within, dealt = _with_plants(pairs.filter(F.col("old") <= least).select(DEMAND, PLANT, COST), p, DEMAND, PLANT)
    sums = gram.gram_parts(within, pfeat, COST, DEMAND, dealt=dealt).groupBy(DEMAND).agg(*[F.sum(c).alias(f"b_{c}") for c in narrow])
    folds = fitted.folds.withColumnRenamed(key, DEMAND).join(d, DEMAND).join(sums, DEMAND, "left").na.fill(0.0, [f"b_{c}" for c in narrow])
    folds = materialize(folds)
    whole = gram.widened([F.col(c) for c in side], _own(len(pfeat)), len(pfeat))
    total = folds.agg(*[F.coalesce(F.sum(x), F.lit(0.0)).alias(c) for c, x in zip(names, whole)]).first()
    # The other pairs, each judged by its fold's cut-off: a few, unless the cut-offs lie far apart.
    sure = (F.col("old") <= least) & F.coalesce(F.col("new") <= least, F.lit(False))
    judged = pairs.filter(~sure & ((F.col("old") <= most) | F.coalesce(F.col("new") <= most, F.lit(False))))
    judged = judged.join(folds.select(DEMAND, "threshold"), DEMAND)
    before, after = (F.coalesce(F.col(c) <= F.col("threshold"), F.lit(False)).cast("int") for c in ("old", "new"))
    judged = materialize(judged.select(DEMAND, PLANT, COST, (after - before).alias("turn"), (after - (F.col("old") <= least).cast("int")).alias("change")))
    change = judged.filter("change <> 0").join(beside(p), PLANT).select(DEMAND, *[x.alias(c) for c, x in zip(narrow, gram.stat_products(pfeat, COST, F.col("change")))])
    change = change.groupBy(DEMAND).agg(*[F.sum(c).alias(f"c_{c}") for c in narrow])
    # Statistics per plant: of those between the cut-offs and of those that come or go by a fold's own cost.
    turned = judged.filter("turn <> 0").select(DEMAND, PLANT, "turn")
    medians = fitted.medians.select(F.col(plant).alias(PLANT), "old")
    between = (F.col("old") > least) & (F.col("old") <= most)
    wanted = medians.join(turned.select(PLANT, F.lit(True).alias("turns")).distinct(), PLANT, "left").filter(between | F.col("turns"))
    wanted = materialize(wanted.select(PLANT, "old"))
    rows = pairs.drop("old", "new").join(beside(wanted.select(PLANT)), PLANT, "left_semi").join(folds.select(DEMAND, *side), DEMAND).join(beside(p), PLANT)
    per_plant = materialize(gram.gram_stats(rows, columns, COST, PLANT).join(beside(wanted), PLANT))
    by_slot = {r["slot"]: np.array([r[c] for c in names]) for r in per_plant.filter(between).groupBy(
        _slot(F.col("old"), steps).alias("slot")).agg(*[F.sum(c).alias(c) for c in names]).collect()}
    running, prefix = np.array([total[c] for c in names]), [(-1, *[0.0] * len(names))]      # slot -1: no threshold, no training rows
    for i in range(len(steps) + 1):
        running = running + by_slot.get(i, 0.0)
        prefix.append((i, *running.tolist()))
    prefix_df = folds.sparkSession.createDataFrame(prefix, "slot int, " + ", ".join(f"{c} double" for c in names))
    moved = turned.join(beside(per_plant), PLANT).groupBy(DEMAND).agg(*[F.sum(F.col(c) * F.col("turn")).alias(c) for c in names])
    # Own sums: those within every cut-off, and what the judged pairs change.
    folds = folds.join(change, DEMAND, "left").join(moved.select(DEMAND, F.array(*names).alias("moved")), DEMAND, "left")
    folds = folds.select(*[c for c in folds.columns if c[:2] not in ("b_", "c_")], F.when(F.col("threshold").isNull(), -1).otherwise(_slot(F.col("threshold"), steps)).alias("slot"),
                         *[(F.col(f"b_{c}") + F.coalesce(F.col(f"c_{c}"), F.lit(0.0))).alias(f"b_{c}") for c in narrow])
    return FoldSystems(fitted, materialize(folds), p, columns, marks, prefix_df, ends["least"], ends["most"])


def fold_counts(systems: FoldSystems) -> DataFrame:
    """Per fold: the cut-off, its training rows and its held-out rows."""
    return systems.stats.select(DEMAND, "threshold", F.round("n").cast("long").alias("n_train"), "n_held_out")


def _solver(columns: int, n_demand: int, marks: list[int], alpha: float, max_iter: int):
    """mapInPandas function: fold statistics -> intercept and coefficients on the fold's scaled features."""
    pairs = [(i, j) for i in range(columns) for j in range(i, columns)]
    n_marks, p = len(marks), columns - len(marks)

    def run(batches):
        for pdf in batches:
            if pdf.empty:
                continue
            b, n = len(pdf), pdf["n"].to_numpy(np.float64)
            e = pdf[[f"sx_{i}" for i in range(columns)]].to_numpy(np.float64) / n[:, None]
            ybar = pdf["sy"].to_numpy(np.float64) / n
            c = pdf[[f"sxy_{i}" for i in range(columns)]].to_numpy(np.float64) - n[:, None] * e * ybar[:, None]
            g = np.empty((b, columns, columns))
            for i, j in pairs:
                g[:, i, j] = g[:, j, i] = pdf[f"sxx_{i}_{j}"].to_numpy(np.float64) - n * e[:, i] * e[:, j]
            # Rows of a: the fold's scaled feature from (z, u, plant features); shift: what is constant in it.
            a, shift = np.zeros((b, p, columns)), np.zeros((b, p))
            for i in range(n_demand):
                m, s = pdf[f"m_{i}"].to_numpy(np.float64), pdf[f"s_{i}"].to_numpy(np.float64)
                s = np.where(s == 0, 1.0, s)
                a[:, i, i] = 1 / s
                if i in marks:
                    a[:, i, n_demand + marks.index(i)] = -m / s
                else:
                    shift[:, i] = -m / s
            for i in range(n_demand, p):
                a[:, i, i + n_marks] = 1.0
            g = a @ g @ a.transpose(0, 2, 1)
            c, xbar = np.einsum("bij,bj->bi", a, c), np.einsum("bij,bj->bi", a, e) + shift
            # Rounding of a constant feature is no spread.
            flat = np.diagonal(g, axis1=1, axis2=2) <= 1e-12 * n[:, None]
            g[flat[:, :, None] | flat[:, None, :]] = 0.0
            w = gram.lasso_cd_batch(g, np.where(flat, 0.0, c), n, alpha, max_iter=max_iter)
            yield pd.DataFrame({DEMAND: pdf[DEMAND].to_numpy(), "intercept": ybar - np.einsum("bi,bi->b", xbar, w), "coef": list(w)})
    return run


def lasso_logo_refit(systems: FoldSystems, alpha: float = 1.0, max_iter: int = 10_000) -> DataFrame:
    """G3 without leakage: per demand with held-out rows the regret of a Lasso fitted, preprocessing
    included, without that demand: Demand_ID, n_train, n_held_out, Selection_Error, Fold_RMSE."""
    n_demand, pfeat = len(systems.fitted.demand_features), systems.fitted.plant_features
    usable = F.col("n") > 0.5
    for i in range(n_demand):
        usable = usable & F.col(f"m_{i}").isNotNull()
    usable = usable & (F.col("n_held_out") > 0)
    tasks = max(1, math.ceil(systems.stats.filter(usable).count() / SOLVES_PER_TASK))
    kind = systems.folds.schema[DEMAND].dataType.simpleString()
    # Dealt before the statistics are spelled out.
    stats = systems.statistics(systems.folds.repartition(tasks, DEMAND)).filter(usable)
    solved = materialize(stats.mapInPandas(
        _solver(len(systems.columns), n_demand, systems.marks, float(alpha), max_iter), f"{DEMAND} {kind}, intercept double, coef array<double>"))
    sides = systems.stats.filter(usable).join(solved, DEMAND)
    # The demand's part of the prediction is the same for all its pairs.
    shared = F.col("intercept")
    for i in range(n_demand):
        present = F.col(f"u_{i}") if i in systems.marks else F.lit(1.0)
        x = (F.col(f"z_{i}") - F.col(f"m_{i}") * present) / F.when(F.col(f"s_{i}") == 0, 1.0).otherwise(F.col(f"s_{i}"))
        shared = shared + F.col("coef")[i] * x
    sides = sides.select(DEMAND, F.round("n").cast("long").alias("n_train"), "n_held_out", "threshold", shared.alias("shared"),
                         *[F.col("coef")[n_demand + j].alias(f"w_{j}") for j in range(len(pfeat))])
    # Pairs within some cut-off; those within every one need not be judged.
    s = systems.fitted.settings
    held = systems.fitted.pairs.filter(F.col("new") <= F.lit(systems.most).cast("double")).select(
        F.col(s.demand_key).alias(DEMAND), F.col(s.plant_key).alias(PLANT), F.col(s.cost).alias(COST),
        F.when(F.col("new") > F.lit(systems.least).cast("double"), F.col("new")).alias("new"))
    held = held.join(sides.hint("rebalance"), DEMAND).filter(F.col("new").isNull() | (F.col("new") <= F.col("threshold")))
    held = held.drop("new", "threshold").join(beside(systems.plants), PLANT)
    held = held.withColumn("prediction", sum((F.col(f"w_{j}") * F.col(f) for j, f in enumerate(pfeat)), F.col("shared")))
    scen = scenario_table(held, extra_keys=["n_train", "n_held_out"])
    return scen.select("Demand_ID", "n_train", "n_held_out", "Selection_Error", F.abs("Selection_Error").alias("Fold_RMSE"))
