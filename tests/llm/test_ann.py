import numpy as np
from pickwise.llm import ann
from pyspark.sql import functions as F


def table(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>, rank string, point string")


def test_nearest_equal_brute_force_on_one_block(spark):
    rng = np.random.default_rng(3)
    x = {i: rng.normal(size=8) for i in range(300)}
    x.update({i: x[7] for i in range(300, 330)})          # a common vector
    odd = [(1000, None), (1001, []), (1002, [0.0] * 8), (1003, [float("nan")] * 8), (1004, [None] * 8), (None, [1.0] * 8), (1005, [1.0, 2.0])]
    rows = [(i, v.tolist(), "r", "p") for i, v in x.items()] + [(i, v, "r", "p") for i, v in odd]
    got = {}
    for r in ann.nearest(table(spark, rows), F.col("id") % 100 == 0).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    assert sorted(got) == [0, 100, 200, 300]
    for q, found in got.items():
        want = sorted((float(ann.distances(x[q], v[None])[0]), i) for i, v in x.items() if i != q)[:10]
        assert [(n, i) for n, i, _ in sorted(found)] == [(n, i) for n, (_, i) in enumerate(want, 1)]
        assert np.allclose([s for _, _, s in sorted(found)], [s for s, _ in want], rtol=1e-12)


def test_empty_table(spark):
    assert ann.nearest(table(spark, []), F.col("id") % 100 == 0).collect() == []
