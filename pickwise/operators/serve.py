"""Serving: best candidate for any number of new demands.

For a linear model the prediction splits into a demand part and a plant part,
``b + w_d . x_d + w_p . x_p``; the demand part is the same for every plant,
so the cheapest plant is the plant with the smallest ``w_p . x_p`` - one
aggregate over the plants, no (demand x plant) pairs. Models without that
split need more. Tree ensembles are searched by cells and boxes of their
thresholds (``tree_serve``). Any other model must score every candidate of a
demand (``best_plant_scored``): demands and candidates are dealt into blocks, block
meets block and the lowest prediction of a demand is kept by partial aggregation.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.ranking import with_global_index
from ..functions.reuse import reusable
from .combine import first_per_key
from .tree_serve import best_plant_trees, model_ensemble

#: Rows of one block of demands or candidates in the search of non-linear models.
BLOCK_ROWS = 2000


def linear_score(weights: dict[str, float], intercept: float = 0.0):
    """``intercept + sum w_f * f`` as one JVM expression (0.0 for no weights)."""
    expr = F.lit(float(intercept))
    for f, w in weights.items():
        expr = expr + F.lit(float(w)) * F.col(f).cast("double")
    return expr


def best_plant_linear(demands: DataFrame, plants: DataFrame, intercept: float, weights: dict[str, float],
                      demand_features: list[str], plant_features: list[str], demand_key: str = "demand_id",
                      plant_key: str = "plant_id", plant_info: list[str] | None = None,
                      plant_order: str | None = None) -> DataFrame:
    """I2/L6/J6 for a linear model: per demand the plant with the lowest
    predicted cost (ties: first by ``plant_order``, then smallest plant key; a plant with a missing feature
    has no prediction and is never picked), its descriptive columns, the raw
    prediction and the number of features used."""
    info = list(plant_info or [])
    pscore = linear_score({f: weights.get(f, 0.0) for f in plant_features})
    tie = [F.col(plant_order).alias("__po")] if plant_order else []
    scored = plants.select(plant_key, *info, *tie, pscore.alias("__ps")).filter(F.col("__ps").isNotNull())
    best = scored.agg(F.min_by(F.struct(F.col(plant_key).alias("k"), *[F.col(c) for c in info],
                                        F.col("__ps").alias("s")),
                               F.struct("__ps", *(["__po"] if tie else []), plant_key)).alias("b"))
    b = {name: best.select(f"b.{name}").scalar() for name in ["k", "s", *info]}
    dscore = linear_score({f: weights.get(f, 0.0) for f in demand_features}, intercept)
    return demands.select(
        demand_key,
        b["k"].alias("selected_plant"),
        *[b[c].alias(c) for c in info],
        (dscore + b["s"]).alias("raw_prediction"),
        F.lit(len(demand_features) + len(plant_features)).alias("feature_count"))


def best_plant_scored(model, demands: DataFrame, plants: DataFrame, demand_key: str = "demand_id",
                      plant_key: str = "plant_id", plant_info: list[str] | None = None,
                      feature_count: int | None = None, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """I2 for any model: every demand scored against every candidate, block by
    block, then the lowest prediction per demand (partial aggregate). A
    candidate with a missing feature is never picked; a demand with one gets
    no plant (null)."""
    info = list(plant_info or [])
    mine = [f for f in model.features if f in demands.columns]
    theirs = [f for f in model.features if f in plants.columns]
    demands = reusable(demands.select(demand_key, *mine))
    plants = reusable(plants.select(plant_key, *info, *theirs).na.drop(subset=[plant_key, *theirs]))
    known = first_per_key(demands.na.drop(subset=[demand_key, *mine]), demand_key, mine) if mine else \
        demands.na.drop(subset=[demand_key]).distinct()
    slices = max(1, math.ceil(known.count() / block_rows))
    blocks = max(1, math.ceil(plants.count() / block_rows))
    # Block pair (s, b): a slice of the demands meets a block of the candidates.
    left = known.select("*", F.pmod(F.xxhash64(demand_key), F.lit(slices)).alias("__s"),
                        F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(blocks - 1).cast("bigint"))).alias("__b"))
    right = plants.select("*", F.pmod(F.xxhash64(plant_key), F.lit(blocks)).alias("__b"),
                          F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(slices - 1).cast("bigint"))).alias("__s"))
    pairs = left.join(right, ["__s", "__b"])
    scored = model.transform(pairs).filter(F.col("prediction").isNotNull() & ~F.isnan("prediction"))
    agg = scored.groupBy(demand_key).agg(
        F.min_by(F.struct(F.col(plant_key).alias("selected_plant"), *[F.col(c) for c in info],
                          F.col("prediction").alias("raw_prediction")),
                 F.struct(F.col("prediction"), F.col(plant_key))).alias("b"))
    n = feature_count if feature_count is not None else len(model.features)
    return demands.select(demand_key).join(agg, demand_key, "left").select(
        demand_key, "b.*", F.lit(n).alias("feature_count"))


def best_plant(model, prep, demands: DataFrame, plants: DataFrame, candidates: str = "all",
               scale: bool = True, plant_info: list[str] | None = None, plant_order: str | None = None) -> DataFrame:
    """I2 through a fitted model and preprocessor. ``candidates='good'``
    restricts to the plants kept by the cost filter (the reference serves
    all plants); ``scale=False`` feeds raw features, as the reference's
    serving script ends up doing."""
    s = prep.settings
    d = prep.transform_demand(demands) if scale else demands
    p = prep.transform_plants(plants, only_good=(candidates == "good")) if scale else plants
    if not scale and candidates == "good":
        p = p.join(prep.flags.filter(F.col("is_good")).select(s.plant_key), s.plant_key, "left_semi")
    d = d.withColumnRenamed(s.demand_key, "__dk")
    p = p.withColumnRenamed(s.plant_key, "__pk")
    terms = model.linear_terms()
    if terms is not None:
        b, w = terms
        out = best_plant_linear(d, p, b, w, prep.demand_features, prep.plant_features, "__dk", "__pk", plant_info, plant_order)
    elif model.model_type in ("random_forest", "gradient_boosting"):
        found = best_plant_trees(model_ensemble(model, d.sparkSession), d, p, "__dk", "__pk", plant_info, plant_order)
        out = found.picks.withColumn("feature_count", F.lit(len(model.features)))
    else:
        out = best_plant_scored(model, d, p, "__dk", "__pk", plant_info)
    return out.withColumnRenamed("__dk", s.demand_key)


def score_pairs(model, demands: DataFrame, plants: DataFrame, pairs: DataFrame, demand_features: list[str],
                plant_features: list[str], demand_key: str = "demand_id", plant_key: str = "plant_id",
                demand_order: str | None = None, plant_order: str | None = None) -> DataFrame:
    """Predicted cost of given (demand, plant) pairs - the features of
    both sides are looked up by key, one row per key (see ``first_per_key``).
    A pair with a missing feature has no prediction."""
    d = first_per_key(demands, demand_key, demand_features, demand_order).hint("rebalance")
    p = first_per_key(plants, plant_key, plant_features, plant_order).hint("rebalance")
    joined = pairs.select(demand_key, plant_key).join(d, demand_key).join(p, plant_key)
    if model.linear_terms() is None:
        full = joined.na.drop(subset=demand_features + plant_features)
        gaps = joined.filter(F.greatest(*[F.col(f).isNull() for f in demand_features + plant_features]))
        return model.transform(full).select(demand_key, plant_key, "prediction").unionByName(
            gaps.select(demand_key, plant_key, F.lit(None).cast("double").alias("prediction")))
    return model.transform(joined).select(demand_key, plant_key, "prediction")


def position_lookup(preds: DataFrame, plants: DataFrame, value: str, plant_key: str = "plant_id",
                    plant_order: list[str] | None = None) -> DataFrame:
    """Treat a number as a 0-based plant position: half-even rounding,
    clamped to [0, n-1]; the plant at that position in plant order. A null
    number has no plant (null)."""
    order = plant_order or [plant_key]
    indexed = with_global_index(plants.select(plant_key, *[c for c in order if c != plant_key]), order, "__pos")
    n = indexed.agg(F.count(F.lit(1))).scalar()
    at = F.bround(F.col(value), 0).cast("bigint")
    # least and greatest skip nulls, so a missing number is kept apart.
    pos = F.when(at.isNotNull(), F.greatest(F.lit(0), F.least(at, n - 1)))
    looked = indexed.select(F.col("__pos"), F.col(plant_key).alias("selected_plant"))
    return preds.withColumn("__pos", pos).join(looked, "__pos", "left").drop("__pos")


def random_demands(spark: SparkSession, n: int, features: list[str], seed: int = 0,
                   key: str = "demand_id") -> DataFrame:
    """I4: ``n`` demands with standard-normal features (a test-data maker)."""
    return spark.range(n).select(F.col("id").alias(key),
                                 *[F.randn(seed + i).alias(f) for i, f in enumerate(features)])
