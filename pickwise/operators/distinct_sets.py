"""A4, U1, U2 on sets: distinct demands per split side, fold or plant and what the
sets share, from mergeable theta sketches; the exact counts beside them.

A theta sketch keeps the keys with the smallest hashes (at most 2 ** lg_k). Sketches of
parts merge into the sketch of the union, so the counts of sides, of their intersection
(a demand in train and test would be leakage) and of their difference come from one
partially aggregated pass; the shuffle carries one sketch per group and task, not the keys.

Error: up to 2 ** lg_k distinct keys the counts are exact. Beyond, a union's relative standard
error is 1 / sqrt(2 ** lg_k) (1.6 % for 12); that of an intersection or difference is the same
in relation to the union, not to the result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LG_K = 12


def _estimate(sketch: Column) -> Column:
    return F.theta_sketch_estimate(sketch)


def side_sketches(rows: DataFrame, key: str, side: Column, lg_k: int = LG_K) -> DataFrame:
    """One row: a, b (sketches of the keys of rows where side is true, and false)."""
    name = F.col(key).cast("string")
    return rows.select(name.alias("k"), side.alias("s")).filter("k is not null and s is not null").agg(
        F.theta_sketch_agg(F.when(F.col("s"), F.col("k")), F.lit(lg_k)).alias("a"),
        F.theta_sketch_agg(F.when(~F.col("s"), F.col("k")), F.lit(lg_k)).alias("b"))


def overlap_estimate(rows: DataFrame, key: str, side: Column, lg_k: int = LG_K) -> DataFrame:
    """n_true, n_false, n_union, n_both, n_only_true: distinct keys of the two sides of a split."""
    s = side_sketches(rows, key, side, lg_k)
    a, b = F.col("a"), F.col("b")
    return s.select(_estimate(a).alias("n_true"), _estimate(b).alias("n_false"), _estimate(F.theta_union(a, b, F.lit(lg_k))).alias("n_union"),
                    _estimate(F.theta_intersection(a, b)).alias("n_both"), _estimate(F.theta_difference(a, b)).alias("n_only_true"))


def overlap_exact(rows: DataFrame, key: str, side: Column) -> DataFrame:
    """The same counts exactly: one aggregate per key, then one over the keys."""
    per_key = rows.select(F.col(key).alias("k"), side.alias("s")).filter("k is not null and s is not null").groupBy("k").agg(
        F.bool_or("s").alias("t"), F.bool_or(~F.col("s")).alias("f"))
    return per_key.agg(F.count_if("t").alias("n_true"), F.count_if("f").alias("n_false"), F.count(F.lit(1)).alias("n_union"),
                       F.count_if(F.col("t") & F.col("f")).alias("n_both"), F.count_if(F.col("t") & ~F.col("f")).alias("n_only_true"))


def group_estimate(rows: DataFrame, group: str, key: str, lg_k: int = LG_K) -> DataFrame:
    """group, n_keys (distinct keys of a group) and n_total (distinct keys of all groups, from the merged sketches)."""
    per = rows.select(F.col(group).alias("__g"), F.col(key).cast("string").alias("k")).filter("k is not null").groupBy("__g").agg(
        F.theta_sketch_agg("k", F.lit(lg_k)).alias("s"))
    total = per.agg(_estimate(F.theta_union_agg("s", F.lit(lg_k))).alias("n")).select("n").scalar()
    return per.select(F.col("__g").alias(group), _estimate(F.col("s")).alias("n_keys"), total.alias("n_total"))
