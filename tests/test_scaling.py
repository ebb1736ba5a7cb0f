"""What keeps the large runs small: shared inputs written once, partitions of bounded size, statistics by sorted chunks."""

import os
import sys

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as se  # noqa: E402
from pickwise.functions import reuse  # noqa: E402
from pickwise.plans import cv, gram, models  # noqa: E402


def small_tables(spark, folder, n_cust=12, n_supp=5):
    """Customers, suppliers, orders and lines of a few rows as Parquet; returns the folder."""
    customers = [(c, f"Customer#{c:09d}", "ABC"[c % 3], c % 4, float(c * 10 - 15)) for c in range(n_cust)]
    orders = [(o, o % n_cust, float(100 + o)) for o in range(4 * n_cust)]
    lines = [(o, (o * 3 + k) % 7, (o + 2 * k) % n_supp, k + 1, float(1 + (o + k) % 4), float(50 + (o * 7 + k * 11) % 40), 0.01 * (o % 5))
             for o, _, _ in orders for k in range(3)]
    tables = {
        "customer": (customers, "c_custkey long, c_name string, c_mktsegment string, c_nationkey int, c_acctbal double"),
        "supplier": ([(s, s % 2, float(s)) for s in range(n_supp)], "s_suppkey long, s_nationkey int, s_acctbal double"),
        "nation": ([(0, "A"), (1, "B")], "n_nationkey int, n_name string"),
        "orders": (orders, "o_orderkey long, o_custkey long, o_totalprice double"),
        "lineitem": (lines, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double"),
    }
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


@pytest.mark.parametrize("name", ["improvement_pct", "model_comparison"])
def test_error_tables_do_not_join_the_lines_again(spark, tmp_path, name):
    sf = small_tables(spark, tmp_path)
    df = se.queries()[name](spark, sf)
    assert "l_orderkey" not in df._jdf.queryExecution().optimizedPlan().toString()
    con = duckdb.connect()
    for t in ("customer", "supplier", "orders", "lineitem", "nation"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet/*.parquet')")
    found = con.execute(se.oracle_sql()[name])
    columns = [d[0] for d in found.description]
    key = lambda row: tuple(str(v) for v in row)
    want = sorted((tuple(r) for r in found.fetchall()), key=key)
    got = sorted((tuple(r[c] for c in columns) for r in df.collect()), key=key)
    assert len(got) == len(want) > 0
    for a, b in zip(got, want):
        for x, y in zip(a, b):
            assert x == (pytest.approx(y, abs=1e-5) if isinstance(y, float) else y)


def test_a_fit_reads_partitions_of_bounded_size(spark, monkeypatch):
    rows = spark.createDataFrame([(float(i), float(i % 7)) for i in range(100)], "DF1 double, Cost double").coalesce(1)
    assert reuse.spread(rows) is rows
    dealt = reuse.spread(rows, 30)
    sizes = [r[0] for r in dealt.groupBy(F.spark_partition_id()).count().select("count").collect()]
    assert len(sizes) == 4 and max(sizes) <= 31
    assert sorted(dealt.collect()) == sorted(rows.collect())
    read = []
    monkeypatch.setattr(models, "spread", lambda df: (read.append(df.columns), reuse.spread(df, 30))[1])
    models.fit_model("random_forest", {"n_estimators": 2, "max_depth": 2}, 1, rows, ["DF1"])
    assert read == [["DF1", "Cost"]]


def test_statistics_per_group_are_one_row_per_group(spark):
    rng = np.random.default_rng(3)
    rows = [(None if d == 5 else d, float(x), float(y)) for d in range(6) for x, y in rng.normal(size=(40 if d else 9000, 2))]
    df = spark.createDataFrame(rows, "g long, x double, y double").repartition(8)
    parts = gram.gram_parts(df, ["x"], "y", "g", count="rows")
    assert not any("HashAggregate" in line for line in parts._jdf.queryExecution().executedPlan().toString().splitlines())
    assert parts.count() == 6
    got = {r.g: r for r in gram.sum_by_key(parts, "g").collect()}
    for g in {r[0] for r in rows}:
        x, y = np.array([r[1:] for r in rows if r[0] == g]).T
        want = [len(x), y.sum(), (y * y).sum(), x.sum(), (x * y).sum(), (x * x).sum(), len(x)]
        assert [got[g][c] for c in [*gram.stat_columns(1), "rows"]] == pytest.approx(want, rel=1e-12)


def test_running_sums_carry_a_key_over_tables():
    tables = [pa.table({"k": [None, 1, 1], "v": [1.0, 2.0, None]}), pa.table({"k": [1], "v": [4.0]}), pa.table({"k": [1, 2], "v": [8.0, None]})]
    rows = pa.Table.from_batches(gram._running_sums(iter(tables), "k", ["v"])).to_pylist()
    assert rows == [{"k": None, "v": 1.0}, {"k": 1, "v": 14.0}, {"k": 2, "v": None}]


def test_few_candidates_are_broadcast(spark):
    few = spark.range(10)
    assert "strategy=broadcast" in spark.range(100).join(reuse.beside(few), "id")._jdf.queryExecution().optimizedPlan().toString()
    assert "Rebalance" in reuse.beside(few, 5)._jdf.queryExecution().optimizedPlan().toString()


def test_folds_may_start_from_another_solution():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(30, 200, 3))
    y = x @ np.array([1.0, 0.5, 0.0]) + rng.normal(size=(30, 200))
    g, c = np.einsum("bni,bnj->bij", x, x), np.einsum("bni,bn->bi", x, y)
    n = np.full(30, 200.0)
    cold = gram.lasso_cd_batch(g, c, n, 0.1)
    warm = gram.lasso_cd_batch(g, c, n, 0.1, np.repeat(cold[:1], 30, axis=0))
    one = np.array([gram.lasso_cd(a, b, 200.0, 0.1)[0] for a, b in zip(g, c)])
    assert np.allclose(cold, one, atol=1e-12) and np.allclose(warm, one, atol=1e-10)


def test_solutions_are_not_collected_per_fold(spark):
    rng = np.random.default_rng(5)
    rows = [(d, p, float(d), float(p), float(10 + d * p + rng.normal())) for d in range(10) for p in range(4)]
    comb = spark.createDataFrame(rows, "Demand_ID long, Plant_ID long, DF1 double, PF1 double, Cost double")
    out = cv.lasso_logo(comb, ["DF1", "PF1"], [0.01, 1.0], metric="rmse")
    assert "collect_list" not in out._jdf.queryExecution().optimizedPlan().toString()
    got = {(r.alpha, r.Demand_ID): r.Fold_RMSE for r in out.collect()}
    assert len(got) == 20
    for (alpha, d), rmse in got.items():
        model = models.fit_model("lasso", {"alpha": alpha}, 1, comb.filter(F.col("Demand_ID") != d), ["DF1", "PF1"])
        miss = [r.Cost - model.intercept - model.coef[0] * r.DF1 - model.coef[1] * r.PF1 for r in comb.filter(F.col("Demand_ID") == d).collect()]
        assert rmse == pytest.approx(float(np.sqrt(np.mean(np.square(miss)))), rel=1e-6)
