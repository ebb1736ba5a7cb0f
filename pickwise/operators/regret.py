"""Selection regret and its statistics.

The scenario table is one ``groupBy(demand)`` with four aggregates; the
aggregates are partial (map-side combine), so a demand with a huge number of
candidate rows is reduced before the shuffle and never held by one task.

Tie rule: the reference takes the first row in file order. A table read through
``sources.ingest`` carries that order, and ``order`` names it; else ties go to the
smallest plant key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import safe_ratio
from ..functions.quantiles import DEFAULT_METHOD, grouped_quantiles, quantile_expr
from ..functions.ranking import with_running_sums
from ..functions.reuse import reusable
from .combine import COST, DEMAND, PLANT

SCENARIO_COLUMNS = ["Demand_ID", "Model_Selected_Plant", "Oracle_Selected_Plant",
                    "Model_Selected_Cost", "Oracle_Cost", "Selection_Error"]
STAT_NAMES = ["mean", "median", "std", "min", "max", "rmse", "count"]


def scenario_table(scored: DataFrame, demand: str = DEMAND, plant: str = PLANT, cost: str = COST,
                   pred: str = "prediction", extra_keys: list[str] | None = None, order: str | None = None) -> DataFrame:
    """Per demand the plant with the lowest predicted cost (model pick),
    the plant with the lowest actual cost (oracle), their costs and the regret.
    Rows with a missing cost are ignored; rows with a missing prediction cannot
    be picked (a demand whose predictions are all missing has a null pick).
    ``extra_keys`` (e.g. a grid combination) are grouped along with the demand.
    Ties go to the first row by ``order`` (e.g. the input order of ``sources.ingest``), else
    to the smallest plant key."""
    tie = [F.col(order)] if order else []
    keys = list(extra_keys or []) + [demand]
    p = F.col(pred)
    valid = scored.filter(F.col(cost).isNotNull()).withColumn(
        "__pred", F.when(~F.isnan(p), p))
    agg = valid.groupBy(*keys).agg(
        F.min(cost).alias("Oracle_Cost"),
        F.min_by(F.col(plant), F.struct(F.col(cost), *tie, F.col(plant))).alias("Oracle_Selected_Plant"),
        F.min_by(F.struct(F.col(plant).alias("p"), F.col(cost).alias("c")),
                 F.when(F.col("__pred").isNotNull(), F.struct(F.col("__pred"), *tie, F.col(plant)))).alias("__pick"))
    return agg.select(
        *[F.col(k) for k in keys[:-1]],
        F.col(demand).alias("Demand_ID"),
        F.col("__pick.p").alias("Model_Selected_Plant"),
        F.col("Oracle_Selected_Plant"),
        F.col("__pick.c").alias("Model_Selected_Cost"),
        F.col("Oracle_Cost"),
        (F.col("__pick.c") - F.col("Oracle_Cost")).alias("Selection_Error"))


def selection_regret(scored: DataFrame, **kw) -> DataFrame:
    """(Demand_ID, Selection_Error) - a projection of the scenario table."""
    return scenario_table(scored, **kw).select("Demand_ID", "Selection_Error")


def regret_rmse_expr(err: str | Column = "Selection_Error") -> Column:
    """sqrt(mean(e^2))."""
    e = F.col(err) if isinstance(err, str) else err
    return F.sqrt(F.avg(e * e))


def error_stats(errors: DataFrame, err: str = "Selection_Error", group: list[str] | None = None,
                quantile_method: str = DEFAULT_METHOD) -> DataFrame:
    """A10: mean, median, population std, min, max, rmse, count of the
    non-missing errors. No errors: every statistic is 0 and count 0."""
    e = F.col(err)
    aggs = [F.avg(e).alias("mean"), F.stddev_pop(e).alias("std"), F.min(e).alias("min"),
            F.max(e).alias("max"), regret_rmse_expr(e).alias("rmse"), F.count(e).alias("count")]
    src = errors.filter(e.isNotNull())
    keep = list(group or [])
    if quantile_method in ("exact", "approx"):
        aggs.append(quantile_expr(err, 0.5, quantile_method).alias("median"))
        out = src.groupBy(*keep).agg(*aggs) if keep else src.agg(*aggs)
    else:
        src = reusable(src.select(*keep, err))
        med = grouped_quantiles(src, keep, err, {"median": 0.5}, quantile_method)
        if keep:
            out = src.groupBy(*keep).agg(*aggs).join(med, keep, "left")
        else:
            out = src.agg(*aggs).withColumn("median", med.select("median").scalar())
    return out.select(*keep, *[F.coalesce(F.col(c), F.lit(0.0)).alias(c) for c in STAT_NAMES[:-1]],
                      F.col("count"))


def selection_quality(scenario: DataFrame, err: str = "Selection_Error") -> DataFrame:
    """Perfect (= 0), near (<= 1, not 0), suboptimal (> 1) with shares."""
    e = F.col(err)
    counts = scenario.agg(F.count_if(e == 0).alias("perfect"),
                          F.count_if((e <= 1) & (e != 0)).alias("near_perfect"),
                          F.count_if(e > 1).alias("suboptimal"),
                          F.count(F.lit(1)).alias("total"))
    stacked = counts.select(F.expr(
        "stack(3, 'perfect', perfect, 'near_perfect', near_perfect, 'suboptimal', suboptimal) "
        "AS (category, n_demands)"), "total")
    return stacked.select("category", "n_demands",
                          F.round(safe_ratio(F.col("n_demands") * 100.0, F.col("total")), 6).alias("pct"))


# --------------------------------------------------------- folds / grids

def fold_summary(fold_rmse: DataFrame, combo: str = "combo_idx", value: str = "fold_rmse") -> DataFrame:
    """Per combination, the RMS of the fold RMSEs (named ``mean_rmse``)
    and their population std."""
    v = F.col(value)
    return fold_rmse.groupBy(combo).agg(F.sqrt(F.avg(v * v)).alias("mean_rmse"),
                                        F.stddev_pop(v).alias("std_rmse"),
                                        F.count(v).alias("n_folds"))


def leaderboard(summary: DataFrame, combo: str = "combo_idx") -> DataFrame:
    """Rank 1..n by ``mean_rmse``; ties keep grid order. The table has one
    row per grid combination (bounded by the grid), so one window is fine."""
    w = Window.orderBy(F.col("mean_rmse").asc_nulls_last(), F.col(combo))
    return summary.withColumn("rank", F.row_number().over(w))


def leaderboard_top(summary: DataFrame, k: int = 10, combo: str = "combo_idx") -> DataFrame:
    """L1: the ``k`` best combinations (TakeOrderedAndProject)."""
    return leaderboard(summary, combo).filter(F.col("rank") <= k)


def best_combo(summary: DataFrame, combo: str = "combo_idx") -> DataFrame:
    """The combination with the lowest ``mean_rmse``; the first in grid
    order wins ties."""
    return summary.filter(F.col("mean_rmse").isNotNull()).agg(
        F.min_by(F.struct(F.col(combo), F.col("mean_rmse"), F.col("std_rmse")),
                 F.struct(F.col("mean_rmse"), F.col(combo))).alias("b")).select("b.*")


def cumulative_rmse(folds: DataFrame, fold: str = "Fold", err: str = "Selection_Error", number: str | None = None) -> DataFrame:
    """RMSE over folds 1..i for every i (linear, not quadratic: one
    running sum of squared errors over the fold order). ``number`` adds the
    fold's place 1..n in that order."""
    sq = folds.select(fold, err).withColumn("__sq", F.col(err) * F.col(err))
    run = with_running_sums(sq, [fold], {"__run_sq": "__sq"}, "__i")
    numbered = [(F.col("__i") + 1).cast("int").alias(number)] if number else []
    return run.select(F.col(fold), *numbered, F.col(err),
                      F.sqrt(F.col("__run_sq") / (F.col("__i") + 1)).alias("cumulative_rmse"))


def improvement_pct(base: Column, opt: Column) -> Column:
    """(base - opt) / base x 100; null when base is 0."""
    return safe_ratio((base - opt) * 100.0, base)
