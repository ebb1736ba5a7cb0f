"""The data behind the reference's plots and report.

Nothing is drawn; every summary is a small DataFrame computed by aggregates.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.quantiles import DEFAULT_METHOD, grouped_quantiles, quantile_expr
from ..functions.reuse import reusable
from .regret import STAT_NAMES, cumulative_rmse, error_stats, improvement_pct, selection_quality


def plant_performance(costs: DataFrame, plant: str = "plant_id", cost: str = "cost",
                      quantile_method: str = DEFAULT_METHOD) -> DataFrame:
    """Per plant mean, median, sample std and count of its costs."""
    c = F.col(cost)
    keyed = costs.filter(F.col(plant).isNotNull())
    if quantile_method in ("exact", "approx"):
        return keyed.groupBy(plant).agg(
            F.avg(c).alias("mean_cost"), quantile_expr(cost, 0.5, quantile_method).alias("median_cost"),
            F.stddev_samp(c).alias("std_cost"), F.count(c).alias("n_costs"))
    keyed = reusable(keyed.select(plant, cost))
    basic = keyed.groupBy(plant).agg(F.avg(c).alias("mean_cost"), F.stddev_samp(c).alias("std_cost"),
                                     F.count(c).alias("n_costs"))
    med = grouped_quantiles(keyed.select(plant, cost), [plant], cost, {"median_cost": 0.5}, quantile_method)
    return basic.join(med, plant, "left").select(plant, "mean_cost", "median_cost", "std_cost", "n_costs")


def cheapest_plants(costs: DataFrame, k: int = 10, plant: str = "plant_id", cost: str = "cost",
                    quantile_method: str = DEFAULT_METHOD) -> DataFrame:
    """L4: the ``k`` plants with the lowest median cost (ties: plant key)."""
    perf = plant_performance(costs, plant, cost, quantile_method).filter(F.col("median_cost").isNotNull())
    return perf.orderBy("median_cost", plant).limit(k)


def boxplot_stats(costs: DataFrame, k: int = 10, plant: str = "plant_id", cost: str = "cost",
                  quantile_method: str = DEFAULT_METHOD) -> DataFrame:
    """Box-plot numbers for the ``k`` cheapest plants: quartiles
    (linear), whiskers = most extreme costs within 1.5 IQR of the box, and
    the number of outliers beyond them."""
    # Read five times below (medians, top-k, quartiles, fences): write the
    # two needed columns once unless they already come from a written table.
    costs = reusable(costs.select(plant, cost))
    top = cheapest_plants(costs, k, plant, cost, quantile_method).select(plant)
    rows = costs.filter(F.col(cost).isNotNull()).join(F.broadcast(top), plant, "left_semi")
    q = grouped_quantiles(rows, [plant], cost, {"q1": 0.25, "median_cost": 0.5, "q3": 0.75}, quantile_method)
    iqr = F.col("q3") - F.col("q1")
    fences = q.select("*", (F.col("q1") - 1.5 * iqr).alias("__lo"), (F.col("q3") + 1.5 * iqr).alias("__hi"))
    c = F.col(cost)
    inside = (c >= F.col("__lo")) & (c <= F.col("__hi"))
    out = rows.join(F.broadcast(fences), plant).groupBy(plant, "q1", "median_cost", "q3").agg(
        F.min(F.when(inside, c)).alias("whisker_low"),
        F.max(F.when(inside, c)).alias("whisker_high"),
        F.count_if(~inside).alias("n_outliers"),
        F.count(c).alias("n_costs"))
    return out


def histogram(df: DataFrame, value: str, bins: int = 50) -> DataFrame:
    """``bins`` equal-width bins from min to max, the last bin closed
    (numpy ``histogram``). A constant column gets the range value +- 0.5.
    Empty bins are listed with count 0; counts add up to the non-missing rows.
    The bin table has ``bins`` rows (a parameter), so it is broadcast."""
    v = F.col(value)
    present = df.select(v.cast("double").alias("__v")).filter(F.col("__v").isNotNull())
    bounds = present.agg(F.min("__v").alias("mn"), F.max("__v").alias("mx")).select(
        F.when(F.col("mn") == F.col("mx"), F.col("mn") - 0.5).otherwise(F.col("mn")).alias("lo"),
        F.when(F.col("mn") == F.col("mx"), F.col("mx") + 0.5).otherwise(F.col("mx")).alias("hi"))
    # Two numbers, computed once: as literals they keep the bin expression
    # free of subqueries that would each recompute the input.
    b = bounds.first()
    if b is None or b["lo"] is None:
        return df.sparkSession.createDataFrame([], "bin int, bin_lo double, bin_hi double, count bigint")
    lo, hi = F.lit(float(b["lo"])), F.lit(float(b["hi"]))
    n = F.lit(bins)
    guess = F.least(F.floor((F.col("__v") - lo) / (hi - lo) * n), n - 1).cast("int")
    # The edges decide: division may put a value one bin beside its edge.
    edge = lambda i: F.when(i == n, hi).otherwise(i.cast("double") * ((hi - lo) / n) + lo)
    guess = guess - (F.col("__v") < edge(guess)).cast("int")
    idx = guess + ((F.col("__v") >= edge(guess + 1)) & (guess < n - 1)).cast("int")
    counts = present.select(idx.alias("bin")).groupBy("bin").agg(F.count(F.lit(1)).alias("n"))
    spark = df.sparkSession
    all_bins = spark.range(bins).select(F.col("id").cast("int").alias("bin"))
    edges = all_bins.select(
        "bin",
        (F.col("bin").cast("double") * ((hi - lo) / n) + lo).alias("bin_lo"),
        F.when(F.col("bin") == bins - 1, hi)
         .otherwise((F.col("bin") + 1).cast("double") * ((hi - lo) / n) + lo).alias("bin_hi"))
    return (edges.join(F.broadcast(counts), "bin", "left")
            .select("bin", "bin_lo", "bin_hi", F.coalesce(F.col("n"), F.lit(0)).alias("count")))


def residuals(scored: DataFrame, actual: str = "Cost", pred: str = "prediction") -> DataFrame:
    """residual = predicted - actual."""
    return scored.select(F.col(actual).alias("actual"), F.col(pred).alias("predicted"),
                         (F.col(pred) - F.col(actual)).alias("residual"))


def prediction_bounds(scored: DataFrame, actual: str = "Cost", pred: str = "prediction") -> DataFrame:
    """Common min/max of actual and predicted values (the diagonal of
    the actual-vs-predicted view) and the number of pairs."""
    a, p = F.col(actual), F.col(pred)
    return scored.agg(F.least(F.min(a), F.min(p)).alias("lo"), F.greatest(F.max(a), F.max(p)).alias("hi"),
                      F.count(F.lit(1)).alias("n_pairs"), F.avg(a).alias("mean_actual"),
                      F.avg(p).alias("mean_predicted"))


def mean_line(df: DataFrame, value: str) -> DataFrame:
    """The mean reference line."""
    return df.agg(F.avg(value).alias("mean"))


def stats_long(stats: DataFrame, model: str, evaluation: str) -> DataFrame:
    """One stats row (A10) as (model, evaluation, metric, value) rows."""
    pairs = ", ".join(f"'{m}', CAST(`{m}` AS DOUBLE)" for m in STAT_NAMES)
    return stats.select(F.lit(model).alias("model"), F.lit(evaluation).alias("evaluation"),
                        F.expr(f"stack({len(STAT_NAMES)}, {pairs}) AS (metric, value)"))


def model_comparison(errors: dict[tuple[str, str], DataFrame], err: str = "Selection_Error") -> DataFrame:
    """The 7 statistics for every (model, evaluation) error table, plus
    the RMSE improvement of ``optimized`` over ``baseline`` per evaluation."""
    parts = [stats_long(error_stats(df, err), m, e) for (m, e), df in errors.items()]
    long = parts[0]
    for p in parts[1:]:
        long = long.unionByName(p)
    rmse = long.filter(F.col("metric") == "rmse").groupBy("evaluation").agg(
        F.max(F.when(F.col("model") == "baseline", F.col("value"))).alias("b"),
        F.max(F.when(F.col("model") == "optimized", F.col("value"))).alias("o"))
    imp = rmse.select(F.lit("improvement").alias("model"), "evaluation",
                      F.lit("rmse_improvement_pct").alias("metric"),
                      improvement_pct(F.col("b"), F.col("o")).alias("value"))
    return long.unionByName(imp)


def feature_importance(importances: list[float], names: list[str], spark, k: int = 20) -> DataFrame:
    """L3/M7: the ``k`` largest importances with feature names (one value per
    feature, from the fitted model)."""
    rows = [(n, float(v)) for n, v in zip(names, importances)]
    df = spark.createDataFrame(rows, "feature string, importance double")
    return df.orderBy(F.desc("importance"), "feature").limit(k)


class LazySummaries(Mapping):
    """A mapping whose entries may be built on first access: it lists every
    entry; ``pending()`` lists those not built yet."""

    def __init__(self, ready: dict | None = None):
        self._ready, self._later = dict(ready or {}), {}

    def __setitem__(self, key, value):
        self._ready[key] = value

    def __iter__(self):
        return iter([*self._ready, *self._later])

    def __len__(self):
        return len(self._ready) + len(self._later)

    def later(self, key, build):
        self._later[key] = build

    def __getitem__(self, key):
        if key in self._later:
            self._ready[key] = self._later.pop(key)()
        return self._ready[key]

    def pending(self) -> list:
        return list(self._later)


def summary_bundle(costs: DataFrame, scored_train: DataFrame, scored_test: DataFrame,
                   scenario: DataFrame, folds: DataFrame, plant: str = "plant_id",
                   cost: str = "cost", importances: DataFrame | None = None,
                   quantile_method: str = DEFAULT_METHOD) -> Mapping[str, DataFrame]:
    """Every summary as a lazy DataFrame (the cumulative RMSE, which
    needs a sort written to the checkpoint folder, is built on first access)."""
    from .display import density_grid, hash_sample
    out = LazySummaries({
        "cost_mean": mean_line(costs, cost),
        "train_bounds": prediction_bounds(scored_train),
        "test_bounds": prediction_bounds(scored_test),
        "regret_mean": mean_line(scenario, "Selection_Error"),
        "selection_quality": selection_quality(scenario),
        "fold_mean": mean_line(folds, "Selection_Error"),
    })
    # Entries that run a job while they are planned (histogram bounds, hot-plant
    # checks, the sort behind running sums) are built on first access.
    out.later("cost_histogram", lambda: histogram(costs, cost, 50))
    out.later("train_residual_histogram", lambda: histogram(residuals(scored_train), "residual", 50))
    out.later("test_residual_histogram", lambda: histogram(residuals(scored_test), "residual", 50))
    out.later("regret_histogram", lambda: histogram(scenario, "Selection_Error", 30))
    for name, pairs in (("train", scored_train), ("test", scored_test)):
        out.later(f"{name}_density", lambda pairs=pairs: density_grid(pairs))
        out[f"{name}_sample"] = hash_sample(pairs.select("Demand_ID", "Plant_ID", "Cost", "prediction"), ["Demand_ID", "Plant_ID"])
    out.later("cumulative_rmse", lambda: cumulative_rmse(folds))
    out.later("boxplot_stats", lambda: boxplot_stats(costs, 10, plant, cost, quantile_method))
    out.later("plant_performance", lambda: plant_performance(costs, plant, cost, quantile_method))
    if importances is not None:
        out["feature_importance"] = importances
    return out
