import random

import numpy as np
import pytest
from pickwise.functions.quantiles import grouped_quantiles
from pickwise.functions.selection import selected_quantiles

QS = {"p0": 0.0, "q1": 0.25, "med": 0.5, "q3": 0.75, "p99": 0.99, "p1": 1.0}


def table(spark, groups, parts=5):
    rows = [(k, v) for k, vs in groups.items() for v in vs]
    random.Random(1).shuffle(rows)
    return spark.createDataFrame(rows, "k string, v double").repartition(parts)


def expect(groups):
    return {k: [float(np.percentile([v for v in vs if v is not None], 100 * q)) for q in QS.values()]
            for k, vs in groups.items() if any(v is not None for v in vs)}


def result(df):
    return {r[0]: list(r[1:]) for r in df.collect()}


def same(got, want):
    assert got.keys() == want.keys()
    for k in want:
        assert got[k] == pytest.approx(want[k], rel=1e-12, abs=1e-12), k


def skewed():
    rng = random.Random(3)
    return {"hot": [rng.gauss(0, 10) for _ in range(6000)], "one value": [2.5] * 3000 + [1.0, 9.0],
            "ties": [float(rng.randint(0, 12)) for _ in range(2500)], "single": [7.0], "two": [1.0, 2.0], "nulls": [None, None],
            "some": [None, 3.0, 4.0, 5.0, -1.0], None: [5.0, 6.0, 8.0], "inf": [float("inf"), 1.0, 2.0], "negative": [-0.0, 0.0, -5.0]}


def test_equals_numpy(spark):
    groups = skewed()
    want = {k: v for k, v in expect(groups).items() if k != "inf"}
    got = result(selected_quantiles(table(spark, groups), ["k"], "v", QS))
    assert got.pop("inf")[2] == 2.0
    same(got, want)


def test_many_cells_are_cut_at_pivots(spark):
    groups = skewed()
    del groups["inf"]
    same(result(selected_quantiles(table(spark, groups), ["k"], "v", QS, limit=40)), expect(groups))


def test_missed_brackets_are_searched(spark):
    # Brackets of no width: nearly every rank falls beside them.
    groups = {"hot": [float(x * x % 9973) for x in range(5000)], "ties": [float(x % 7) for x in range(900)]}
    same(result(selected_quantiles(table(spark, groups), ["k"], "v", QS, k=8, margin=0.0)), expect(groups))
    same(result(selected_quantiles(table(spark, groups), ["k"], "v", QS, k=8, margin=0.0, limit=70)), expect(groups))


def test_without_keys_and_empty(spark):
    groups = {"a": [float(x * 37 % 1009) for x in range(4000)]}
    got = selected_quantiles(table(spark, groups).drop("k"), [], "v", QS).collect()
    assert list(got[0]) == pytest.approx(expect(groups)["a"])
    none = spark.createDataFrame([], "k string, v double")
    assert selected_quantiles(none, ["k"], "v", QS).collect() == []
    assert selected_quantiles(none, [], "v", QS).collect() == []


def test_same_on_any_partitioning_and_method(spark):
    groups = {k: v for k, v in skewed().items() if k not in ("inf", None)}
    want = result(grouped_quantiles(table(spark, groups, 1), ["k"], "v", QS, "exact"))
    for parts in (1, 4, 17):
        for method in ("selected", "sorted"):
            same(result(grouped_quantiles(table(spark, groups, parts), ["k"], "v", QS, method)), want)


def test_rows_are_not_sorted(spark):
    plan = selected_quantiles(table(spark, {"a": [1.0, 2.0]}), ["k"], "v", {"m": 0.5})._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in plan
