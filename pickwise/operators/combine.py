"""The combined training table.

Each cost row looks up its demand row and its plant row (equi, many-to-one).
Output columns use the reference's combined names: ``Demand_ID``,
``Plant_ID``, the demand features, the plant features, ``Cost``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.reuse import beside

DEMAND = "Demand_ID"
PLANT = "Plant_ID"
COST = "Cost"


def first_per_key(df: DataFrame, key: str, columns: list[str], order: str | None = None) -> DataFrame:
    """One row per key; with duplicates the row with the smallest ``order``
    wins (input order when an ordinal column is given), else the smallest row.
    Aggregated partially, so a duplicated hot key does not sit in one task."""
    payload = F.struct(*[F.col(c) for c in columns])
    rank = F.col(order) if order else payload
    picked = df.groupBy(key).agg(F.min_by(payload, rank).alias("__row"))
    return picked.select(key, *[F.col(f"__row.{c}").alias(c) for c in columns])


def combine(demand: DataFrame, plants: DataFrame, costs: DataFrame, demand_features: list[str],
            plant_features: list[str], demand_key: str = "demand_id", plant_key: str = "plant_id",
            cost: str = "cost", dedupe: bool = True, demand_order: str | None = None,
            plant_order: str | None = None, drop_missing: bool = True, flag: str | None = None) -> DataFrame:
    """Costs joined to demand and plant features (inner joins: a cost row whose
    demand or plant is unknown has nothing to look up and is dropped; count
    them with ``orphan_counts``). The plants are counted and broadcast if they are few; else, and for the
    demands, adaptive execution broadcasts a side by its measured size, or splits a hot key: the aggregated
    sides are rebalanced, so that they do not bring along a partitioning by the key. ``drop_missing`` drops rows with any
    missing value (P12); ``flag`` keeps them and names a column that tells the complete ones,
    so that ``counts_in_passing`` needs no second pass over the join."""
    d = demand.select(demand_key, *demand_features)
    p = plants.select(plant_key, *plant_features)
    if dedupe:
        d = first_per_key(demand, demand_key, demand_features, demand_order).hint("rebalance")
        p = beside(first_per_key(plants, plant_key, plant_features, plant_order))
    c = costs.select(F.col(demand_key), F.col(plant_key), F.col(cost).cast("double").alias(COST))
    joined = c.join(d, demand_key).join(p, plant_key)
    out = joined.select(F.col(demand_key).alias(DEMAND), F.col(plant_key).alias(PLANT),
                        *[F.col(f).cast("double").alias(f) for f in demand_features + plant_features],
                        F.col(COST))
    if flag:
        complete = F.lit(True)
        for f in out.schema.fields:
            c = F.col(f"`{f.name}`")
            complete = complete & c.isNotNull() & (~F.isnan(c) if f.dataType.typeName() in ("double", "float") else F.lit(True))
        return out.withColumn(flag, F.coalesce(complete, F.lit(False)))
    return out.na.drop(how="any") if drop_missing else out


def orphan_counts(demand: DataFrame, plants: DataFrame, costs: DataFrame,
                  demand_key: str = "demand_id", plant_key: str = "plant_id") -> DataFrame:
    """Cost rows whose demand or plant has no dimension row (anti joins)."""
    no_demand = costs.join(demand.select(demand_key), demand_key, "left_anti").agg(F.count(F.lit(1))).scalar()
    no_plant = costs.join(plants.select(plant_key), plant_key, "left_anti").agg(F.count(F.lit(1))).scalar()
    return costs.agg(F.count(F.lit(1)).alias("cost_rows")).select(
        "cost_rows", no_demand.alias("no_demand"), no_plant.alias("no_plant"))


def counts_in_passing(flagged: DataFrame, flag: str) -> DataFrame:
    """A4 and the P12 report from one aggregate over a combined table with its flag."""
    ok = F.col(flag)
    return flagged.agg(F.count_if(ok).alias("n_rows"), F.count_distinct(F.when(ok, F.col(DEMAND))).alias("n_demands"),
                       F.count_distinct(F.when(ok, F.col(PLANT))).alias("n_plants"), F.count_if(~ok).alias("n_dropped"))


def combined_counts(combined: DataFrame, before: DataFrame | None = None) -> DataFrame:
    """A4 and the P12 report: rows, distinct demands, distinct plants, and the
    rows dropped for missing values when the pre-drop table is given."""
    stats = combined.agg(F.count(F.lit(1)).alias("n_rows"),
                         F.count_distinct(DEMAND).alias("n_demands"),
                         F.count_distinct(PLANT).alias("n_plants"))
    if before is None:
        return stats
    n_before = before.agg(F.count(F.lit(1)).alias("n")).scalar()
    return stats.withColumn("n_dropped", n_before - F.col("n_rows"))
