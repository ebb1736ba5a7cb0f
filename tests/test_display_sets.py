import hashlib
import random

from pyspark.sql import functions as F

from pickwise.operators.display import density_grid, hash_sample
from pickwise.operators.distinct_sets import group_estimate, overlap_estimate, overlap_exact
from pickwise.operators.serve import random_demands


def scored(spark, n=3000, parts=5):
    rng = random.Random(2)
    rows = [(i, "p%d" % (i % 9), rng.choice([None, rng.random() * 50]), rng.choice([rng.random() * 60, rng.random() * 60, None])) for i in range(n)]
    return rows, spark.createDataFrame(rows, "Demand_ID long, Plant_ID string, Cost double, prediction double").repartition(parts)


def test_density_grid_counts_all_pairs(spark):
    rows, df = scored(spark)
    pairs = [(c, p) for _, _, c, p in rows if c is not None and p is not None]
    lo, hi = min(map(min, pairs)), max(map(max, pairs))
    want = {}
    for c, p in pairs:
        cell = tuple(min(int((v - lo) / (hi - lo) * 20), 19) for v in (c, p))
        want[cell] = want.get(cell, 0) + 1
    got = {(r.bin_actual, r.bin_predicted): r.n_pairs for r in density_grid(df, 20).collect()}
    assert got == want and sum(got.values()) == len(pairs)


def test_density_grid_of_one_value_and_of_nothing(spark):
    one = spark.createDataFrame([(2.0, 2.0)] * 5, "Cost double, prediction double")
    assert [(r.bin_actual, r.bin_predicted, r.n_pairs) for r in density_grid(one).collect()] == [(0, 0, 5)]
    assert density_grid(one.limit(0)).collect() == []


def test_hash_sample_is_the_same_on_any_partitioning(spark):
    rows, df = scored(spark)
    want = sorted(sorted(rows, key=lambda r: hashlib.md5(f"{r[0]}|{r[1]}:7".encode()).hexdigest())[:50])
    for parts in (1, 13):
        assert sorted(tuple(r) for r in hash_sample(df.repartition(parts), ["Demand_ID", "Plant_ID"], 50, 7).collect()) == want
    assert hash_sample(df, ["Demand_ID"], 10 ** 6).count() == len(rows)


def test_sets_are_exact_while_small(spark):
    rows = [(i % 700, i % 3 == 0, i % 5) for i in range(4000)] + [(None, True, 1), (3, None, 1)]
    df = spark.createDataFrame(rows, "d long, test boolean, fold int").repartition(6)
    exact, sketch = overlap_exact(df, "d", F.col("test")).first(), overlap_estimate(df, "d", F.col("test")).first()
    a, b = {d for d, t, _ in rows if t and d is not None}, {d for d, t, _ in rows if t is False}
    assert tuple(exact) == tuple(sketch) == (len(a), len(b), len(a | b), len(a & b), len(a - b))
    per = {r.fold: (r.n_keys, r.n_total) for r in group_estimate(df, "fold", "d").collect()}
    assert per == {f: (len({d for d, _, g in rows if g == f and d is not None}), len({d for d, _, _ in rows if d is not None})) for f in range(5)}


def test_error_bound_beyond_the_sketch(spark):
    df = spark.range(200_000).select("id", (F.col("id") % 4 == 0).alias("test"))
    df = df.unionByName(spark.range(20_000).select((F.col("id") * 4 + 1).alias("id"), F.lit(True).alias("test")))
    exact, sketch = overlap_exact(df, "id", F.col("test")).first(), overlap_estimate(df, "id", F.col("test"), 10).first()
    bound = 4 * exact.n_union / 32          # four standard errors of a sketch of 2 ** 10 keys, in relation to the union
    assert all(abs(e - s) <= bound for e, s in zip(exact, sketch)) and exact.n_both == 20_000


def test_random_demands(spark):
    a, b = random_demands(spark, 500, ["DF1", "DF2"], 3), random_demands(spark, 500, ["DF1", "DF2"], 3)
    assert a.columns == ["demand_id", "DF1", "DF2"] and a.collect() == b.collect()
    r = a.agg(F.avg("DF1").alias("m"), F.stddev("DF2").alias("s"), F.count_distinct("demand_id").alias("n")).first()
    assert abs(r.m) < 0.2 and abs(r.s - 1) < 0.2 and r.n == 500
