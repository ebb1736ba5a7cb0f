"""Stand-in selection tables derived from the driver's TPC-H-like tables.

* costs   : one row per (customer, supplier) pair that traded; the cost is the
            mean unit price of the pair's order lines. A pair whose smallest
            line is a single unit has no reliable unit price: its cost is null.
* demands : one row per customer; ``segment`` is text (feature discovery must
            skip it); DF2 (mean order value) is unknown for customers in debt.
* plants  : one row per supplier with its nation name as region.
* predicted: a model stand-in - the plant's mean cost over its *other* demands.
* folds   : (combo, fold, fold_rmse) for the leaderboard operators.

Every view is expressed so that the big side is aggregated before it is
joined (partial aggregation, then a join on already-reduced rows).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F



def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fixture_costs(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey", "l_quantity", "l_extendedprice")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    pairs = (li.join(orders, li.l_orderkey == orders.o_orderkey)
             .groupBy(F.col("o_custkey").alias("demand_id"), F.col("l_suppkey").alias("plant_id"))
             .agg(F.avg(F.col("l_extendedprice") / F.col("l_quantity")).alias("unit"),
                  F.min("l_quantity").alias("min_qty")))
    return pairs.select("demand_id", "plant_id",
                        F.when(F.col("min_qty") != 1.0, F.col("unit")).alias("cost"))


def fixture_demands(spark: SparkSession, sf_dir: str) -> DataFrame:
    cust = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment", "c_acctbal", "c_nationkey")
    per_cust = (table(spark, sf_dir, "orders").groupBy("o_custkey")
                .agg(F.avg("o_totalprice").alias("avg_price"), F.count("o_orderkey").alias("n_orders")))
    j = cust.join(per_cust, cust.c_custkey == per_cust.o_custkey, "left")
    return j.select(
        F.col("c_custkey").alias("demand_id"),
        F.col("c_mktsegment").alias("segment"),
        F.col("c_acctbal").alias("DF1"),
        F.when(F.col("c_acctbal") >= 0, F.col("avg_price")).alias("DF2"),
        F.coalesce(F.col("n_orders"), F.lit(0)).cast("double").alias("DF3"),
        F.col("c_nationkey").cast("double").alias("DF4"))


def fixture_plants(spark: SparkSession, sf_dir: str) -> DataFrame:
    supp = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey", "s_acctbal")
    # nation is a plain file scan: the planner broadcasts it from its file size.
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    per_supp = (table(spark, sf_dir, "lineitem").groupBy("l_suppkey")
                .agg(F.avg("l_quantity").alias("avg_qty"), F.avg("l_discount").alias("avg_disc")))
    j = (supp.join(nation, supp.s_nationkey == nation.n_nationkey)
         .join(per_supp, supp.s_suppkey == per_supp.l_suppkey, "left"))
    return j.select(
        F.col("s_suppkey").alias("plant_id"),
        F.col("n_name").alias("region"),
        F.col("s_acctbal").alias("PF1"),
        F.col("s_nationkey").cast("double").alias("PF2"),
        F.col("avg_qty").alias("PF3"),
        F.col("avg_disc").alias("PF4"))


def fixture_predicted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leave-one-out plant mean as the prediction; null where the plant has a
    single cost. Per-plant totals are aggregated (partial, skew-safe) and
    joined back instead of a window partitioned by plant."""
    costs = fixture_costs(spark, sf_dir).filter(F.col("cost").isNotNull())
    return with_loo_plant_mean(costs)


def with_loo_plant_mean(costs: DataFrame, plant: str = "plant_id", cost: str = "cost",
                        out: str = "pred") -> DataFrame:
    totals = costs.groupBy(plant).agg(F.sum(cost).alias("__tot"), F.count(cost).alias("__n"))
    # Rebalanced totals have no partitioning by plant, so a hot plant can be split.
    j = costs.join(totals.hint("rebalance"), plant)
    pred = F.when(F.col("__n") > 1, (F.col("__tot") - F.col(cost)) / (F.col("__n") - 1))
    return j.select(*costs.columns, pred.alias(out))


def fixture_folds(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return (li.groupBy(F.col("l_linenumber").alias("combo_idx"),
                       F.month("l_shipdate").cast("int").alias("fold"))
            .agg(F.avg("l_extendedprice").alias("fold_rmse")))
