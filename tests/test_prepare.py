import math

import numpy as np
from pyspark.sql import functions as F

from pickwise.functions.columns import discover_features, group_key, nan_to_null
from pickwise.operators import prepare as prep


def test_feature_discovery_keeps_numeric_prefixed_in_schema_order(spark):
    df = spark.createDataFrame([("a", 1.0, "x", 2, True)], "DF0 string, DF2 double, DF3 string, DF1 int, DFb boolean")
    assert discover_features(df, "DF") == ["DF2", "DF1", "DFb"]


def test_nan_becomes_null(spark):
    df = nan_to_null(spark.createDataFrame([(float("nan"),), (1.0,)], "x double"))
    assert df.filter(F.col("x").isNull()).count() == 1


def test_impute_strategies(spark):
    df = spark.createDataFrame([(1, 1.0), (2, None), (3, 4.0), (4, 10.0)], "k int, DF1 double")
    got = {s: [r.DF1 for r in prep.impute(df, ["DF1"], s).orderBy("k").collect()] for s in ("mean", "median", "zero")}
    assert got["mean"][1] == 5.0
    assert got["median"][1] == 4.0
    assert got["zero"][1] == 0.0


def test_zero_strategy_scales_with_median_filled_stats(spark):
    demand = spark.createDataFrame([(1, 1.0), (2, None), (3, 4.0), (4, 10.0)], "demand_id int, DF1 double")
    plants = spark.createDataFrame([(1, 1.0), (2, 3.0)], "plant_id int, PF1 double")
    costs = spark.createDataFrame([(1, 1, 5.0), (1, 2, 6.0)], "demand_id int, plant_id int, cost double")
    m = prep.Preprocessor(75, "zero").fit(demand, plants, costs)
    filled = np.array([1.0, 4.0, 4.0, 10.0])
    assert math.isclose(m.demand_scaler.means[0], filled.mean())
    assert math.isclose(m.demand_scaler.stds[0], filled.std())
    out = {r.demand_id: r.DF1 for r in m.transform_demand(demand).collect()}
    assert math.isclose(out[2], (0.0 - filled.mean()) / filled.std())


def test_zero_std_divides_by_one(spark):
    df = spark.createDataFrame([(1, 3.0), (2, 3.0)], "k int, PF1 double")
    params = prep.fit_scaler(df, ["PF1"])
    assert [r.PF1 for r in params.apply(df).collect()] == [0.0, 0.0]


def test_plant_flags_threshold_equality_and_all_missing(spark):
    rows = [(d, "a", 1.0) for d in range(3)] + [(d, "b", 2.0) for d in range(3)] + \
           [(d, "c", 3.0) for d in range(3)] + [(0, "z", None), (1, "z", None)]
    costs = spark.createDataFrame(rows, "demand_id int, plant_id string, cost double")
    stats = prep.plant_cost_stats(costs)
    thr = prep.cost_threshold(stats, 50).first()["threshold"]
    assert thr == 2.0
    flags = {r.plant_id: r.is_good for r in prep.plant_flags(stats, thr).collect()}
    assert flags == {"a": True, "b": True, "c": False, "z": None}
    z = stats.filter("plant_id = 'z'").first()
    assert z.n_costs == 0 and z.median_cost is None


def test_sorted_quantiles_equal_exact(spark):
    rng = np.random.default_rng(3)
    rows = [(int(k), float(v)) for k, v in zip(rng.integers(0, 5, 400), rng.normal(size=400))]
    rows += [(9, 1.0)] * 50  # a group with many equal values
    df = spark.createDataFrame(rows, "k int, v double")
    a = prep.plant_cost_stats(df, "k", "v", "exact").orderBy("k").collect()
    b = prep.plant_cost_stats(df, "k", "v", "sorted").orderBy("k").collect()
    for x, y in zip(a, b):
        assert x.k == y.k and x.n_costs == y.n_costs
        assert math.isclose(x.median_cost, y.median_cost, rel_tol=1e-12, abs_tol=1e-12)
    for k in range(5):
        vals = np.array([v for kk, v in rows if kk == k])
        assert math.isclose([r for r in b if r.k == k][0].median_cost, float(np.median(vals)), rel_tol=1e-12)


def test_group_key_first_digit_run(spark):
    df = spark.createDataFrame([("D17",), ("X1y2",), ("none",)], "id string")
    assert [r.g for r in df.select(group_key("id").alias("g")).collect()] == [17, 1, None]


def test_sorted_quantiles_equal_exact_ones(spark):
    from pickwise.functions.quantiles import grouped_quantiles
    rng = np.random.default_rng(11)
    rows = [(0, float(v)) for v in rng.normal(size=300)] + [(1, float(v)) for v in rng.normal(size=7)] + \
           [(2, 5.0)] * 40
    df = spark.createDataFrame(rows, "k int, v double").repartition(5)
    qs = {"q1": 0.25, "med": 0.5}
    want = {r.k: (r.q1, r.med) for r in grouped_quantiles(df, ["k"], "v", qs, "exact").collect()}
    got = {r.k: (r.q1, r.med) for r in grouped_quantiles(df, ["k"], "v", qs, "sorted").collect()}
    assert want.keys() == got.keys()
    for k in want:
        assert all(math.isclose(a, b, rel_tol=1e-12, abs_tol=1e-12) for a, b in zip(want[k], got[k]))
    glob = grouped_quantiles(df, [], "v", {"med": 0.5}, "sorted").first().med
    assert math.isclose(glob, float(np.median([v for _, v in rows])), rel_tol=1e-12)


def test_median_impute_same_on_every_quantile_path(spark):
    rng = np.random.default_rng(8)
    rows = [(i, None if i % 4 == 0 else float(v), float(w)) for i, (v, w) in enumerate(rng.normal(size=(60, 2)))]
    df = spark.createDataFrame(rows, "k int, DF1 double, DF2 double")
    want = {r.k: (r.DF1, r.DF2) for r in prep.impute(df, ["DF1", "DF2"], "median", "exact").collect()}
    for method in ("sorted",):
        got = {r.k: (r.DF1, r.DF2) for r in prep.impute(df, ["DF1", "DF2"], "median", method).collect()}
        assert all(math.isclose(got[k][j], want[k][j], rel_tol=1e-12) for k in want for j in (0, 1))


def test_approx_quantiles_close_to_exact(spark):
    from pickwise.functions.quantiles import grouped_quantiles
    vals = [(int(i % 3), float(v)) for i, v in enumerate(np.random.default_rng(9).normal(size=3000))]
    df = spark.createDataFrame(vals, "k int, v double")
    exact = {r.k: r.m for r in grouped_quantiles(df, ["k"], "v", {"m": 0.5}, "exact").collect()}
    approx = {r.k: r.m for r in grouped_quantiles(df, ["k"], "v", {"m": 0.5}, "approx").collect()}
    assert exact.keys() == approx.keys() and all(abs(exact[k] - approx[k]) < 0.05 for k in exact)
