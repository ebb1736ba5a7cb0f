import math

import numpy as np
from pyspark.sql import functions as F

from pickwise.functions.ranking import with_global_index, with_running_sums
from pickwise.operators import split
from pickwise.operators.summaries import histogram


def rows_df(spark, n_groups=40, per=3, parts=4):
    rows = [(g, f"p{i}", float(g * per + i)) for g in range(n_groups) for i in range(per)]
    return spark.createDataFrame(rows, "Demand_ID long, Plant_ID string, Cost double").repartition(parts)


def test_group_split_whole_groups_and_count(spark):
    flagged = split.group_split(rows_df(spark), 0.05, 7)
    per = flagged.groupBy("Demand_ID").agg(F.countDistinct("is_test").alias("k")).collect()
    assert all(r.k == 1 for r in per)
    n_test = flagged.filter("is_test").select("Demand_ID").distinct().count()
    assert n_test == math.ceil(40 * 0.05)


def test_group_split_partition_independent(spark):
    got = []
    for parts in (1, 4, 17):
        f = split.split_groups(rows_df(spark, parts=parts), 0.2, 11)
        got.append(sorted(r.Demand_ID for r in f.filter("is_test").collect()))
    assert got[0] == got[1] == got[2] and len(got[0]) == 8


def test_logo_folds_first_n_ascending(spark):
    folds = split.logo_folds(rows_df(spark), 5).orderBy("Fold").collect()
    assert [(r.Fold, r.Group) for r in folds] == [(i + 1, i) for i in range(5)]


def test_global_index_matches_sorted_order(spark):
    rng = np.random.default_rng(5)
    vals = rng.permutation(500)
    df = spark.createDataFrame([(int(v),) for v in vals], "v long").repartition(7)
    out = with_global_index(df, ["v"], "i").collect()
    assert sorted((r.v, r.i) for r in out) == [(v, v) for v in range(500)]


def test_running_sums_brute_force(spark):
    vals = [float(x) for x in np.random.default_rng(1).integers(0, 9, 200)]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "k long, v double").repartition(5)
    out = with_running_sums(df, ["k"], {"run": "v"}).orderBy("k").collect()
    assert [r.run for r in out] == list(np.cumsum(vals))
    assert [r.idx for r in out] == list(range(200))


def test_histogram_matches_numpy(spark):
    vals = list(np.random.default_rng(2).normal(size=1000)) + [3.25, -2.5]
    df = spark.createDataFrame([(float(v),) for v in vals], "x double")
    h = histogram(df, "x", 50).orderBy("bin").collect()
    counts, edges = np.histogram(vals, bins=50)
    assert [r["count"] for r in h] == counts.tolist()
    assert np.allclose([r.bin_lo for r in h], edges[:-1]) and math.isclose(h[-1].bin_hi, edges[-1])


def test_histogram_constant_column(spark):
    df = spark.createDataFrame([(1.0,)] * 5, "x double")
    h = histogram(df, "x", 10).orderBy("bin").collect()
    counts, edges = np.histogram([1.0] * 5, bins=10)
    assert [r["count"] for r in h] == counts.tolist()
    assert math.isclose(h[0].bin_lo, 0.5) and math.isclose(h[-1].bin_hi, 1.5)


def test_histogram_values_on_edges_match_numpy(spark):
    vals = [i / 10 for i in range(11)]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    got = [r["count"] for r in histogram(df, "x", 10).orderBy("bin").collect()]
    assert got == np.histogram(vals, bins=10)[0].tolist()


def test_logo_folds_keep_ids_without_digits(spark):
    ids = ["north", "D8", "south", "D7", "east", "x10", "D7", None, "9" * 30]
    df = spark.createDataFrame([(i,) for i in ids], "Demand_ID string")
    got = [(r.Fold, r.Group) for r in split.logo_folds(df).orderBy("Fold").collect()]
    assert got == list(enumerate(["7", "8", "10", "9" * 30, "east", "north", "south"], 1))
