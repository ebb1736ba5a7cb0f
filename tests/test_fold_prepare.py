import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from pickwise.functions.selection import middle_values
from pickwise.operators.prepare import Preprocessor
from pickwise.plans import fold_prepare as fp
from pickwise.plans import gram


def tables(seed, n_demands=14, n_plants=9, dense=0.7):
    rng = np.random.default_rng(seed)
    demand = [(d, "s", float(rng.normal(5, 3)), None if d % 4 == 1 else float(rng.normal(-2, 9)), 1.0 if d else 2.0) for d in range(n_demands)]
    plants = [(p, "r", float(rng.normal()), None if p == 3 else float(rng.integers(0, 3))) for p in range(n_plants)]
    costs = [(d, p, None if rng.random() < 0.1 else float(rng.integers(10, 40)))
             for d in range(n_demands + 1) for p in range(n_plants + 1) if rng.random() < dense]
    costs += [(0, 50, 12.0), (None, 2, 31.0), (None, 2, 8.0), (5, None, 3.0)]          # plant 50 has one cost
    return demand, plants, costs


def frames(spark, demand, plants, costs):
    return (spark.createDataFrame(demand, "demand_id long, segment string, DF1 double, DF2 double, DF3 double"),
            spark.createDataFrame(plants, "plant_id long, region string, PF1 double, PF2 double"),
            spark.createDataFrame(costs, "demand_id long, plant_id long, cost double"))


def refit(demand, plants, costs, out, alpha=0.05):
    """Everything again without one demand, in plain Python."""
    left = [r for r in demand if r[0] != out]
    scale = []
    for f in (2, 3, 4):
        v = [r[f] for r in left if r[f] is not None]
        mean = float(np.mean(v))
        scale.append((mean, float(np.std([mean if r[f] is None else r[f] for r in left]))))
    med = {}
    for p in {c[1] for c in costs if c[1] is not None}:
        v = [c[2] for c in costs if c[1] == p and c[0] != out and c[2] is not None]
        if v:
            med[p] = float(np.median(v))
    cut = float(np.quantile(list(med.values()), 0.75)) if med else None
    good = {p for p, m in med.items() if m <= cut}
    pf = {}
    for f in (2, 3):
        v = [r[f] for r in plants if r[f] is not None]
        for r in plants:
            if r[f] is not None:
                pf.setdefault(r[0], []).append((r[f] - np.mean(v)) / np.std(v))
    pf = {p: v for p, v in pf.items() if len(v) == 2}
    df = {r[0]: [0.0 if r[i + 2] is None else (r[i + 2] - m) / (s or 1.0) for i, (m, s) in enumerate(scale)] for r in demand}
    rows = [(c[0], c[1], c[2], df[c[0]] + pf[c[1]]) for c in costs if c[2] is not None and c[0] in df and c[1] in good and c[1] in pf]
    train, held = [r for r in rows if r[0] != out], [r for r in rows if r[0] == out]
    regret = None
    if held and train:
        x, y = np.array([r[3] for r in train]), np.array([r[2] for r in train])
        b, w = gram.solve_lasso(len(y), x.sum(0), y.sum(), x.T @ x, x.T @ y, [alpha])[alpha]
        pick = min(held, key=lambda r: (round(b + float(np.dot(w, r[3])), 9), r[1]))
        regret = pick[2] - min(r[2] for r in held)
    return scale, cut, len(train), len(held), regret


@pytest.mark.parametrize("seed,reach", [(1, 256), (2, 1), (3, 2)])
def test_every_fold_equals_a_refit(spark, seed, reach):
    demand, plants, costs = tables(seed)
    d, p, c = frames(spark, demand, plants, costs)
    fitted = fp.fit_folds(d, p, c, Preprocessor(75.0), reach=reach)
    systems = fp.fold_systems(fitted, d, p)
    par = {r.demand_id: r for r in fitted.parameters().collect()}
    counts = {r.Demand_ID: r for r in fp.fold_counts(systems).collect()}
    regrets = {r.Demand_ID: r for r in fp.lasso_logo_refit(systems, 0.05).collect()}
    assert sorted(par) == [r[0] for r in demand]
    for out in par:
        scale, cut, n_train, n_held, regret = refit(demand, plants, costs, out)
        for (mean, std), f in zip(scale, ("DF1", "DF2", "DF3")):
            assert math.isclose(par[out][f"{f}__mean"], mean, rel_tol=1e-9, abs_tol=1e-9)
            assert math.isclose(par[out][f"{f}__std"], std, rel_tol=1e-9, abs_tol=1e-9)
        assert math.isclose(par[out].threshold, cut, rel_tol=1e-12)
        assert (counts[out].n_train, counts[out].n_held_out) == (n_train, n_held)
        if regret is None:
            assert out not in regrets
        else:
            assert math.isclose(regrets[out].Selection_Error, regret, abs_tol=1e-9), out
            assert math.isclose(regrets[out].Fold_RMSE, abs(regret), abs_tol=1e-9)


def test_equal_medians_far_beyond_the_window(spark):
    # All plants tie, and one demand's cost moves every plant: windows must widen.
    costs = [(d, p, 5.0 if d < 2 else 90.0) for d in range(3) for p in range(30)] + [(9, p, 5.0) for p in range(30)]
    demand = [(d, "s", float(d), 1.0, 1.0) for d in range(3)]
    d, p, c = frames(spark, demand, [(p, "r", 1.0, float(p)) for p in range(30)], costs)
    fitted = fp.fit_folds(d, p, c, Preprocessor(75.0), reach=1)
    got = {r.demand_id: r.threshold for r in fitted.parameters().collect()}
    assert got == {0: 5.0, 1: 5.0, 2: 5.0}
    mixed = [(0, p, 1.0) for p in range(30)] + [(1, p, 50.0 + p) for p in range(30)]
    fitted = fp.fit_folds(d, p, frames(spark, demand, [], mixed)[2], Preprocessor(75.0), reach=1)
    got = {r.demand_id: r.threshold for r in fitted.parameters().collect()}
    assert got[0] == np.quantile([50.0 + p for p in range(30)], 0.75) and got[1] == 1.0
    assert math.isclose(got[2], np.quantile([(51.0 + p) / 2 for p in range(30)], 0.75))


def test_middle_values_equal_sorting(spark):
    rng = np.random.default_rng(4)
    groups = {g: [float(x) for x in rng.integers(0, 2000, size=n)] for g, n in (("a", 1), ("b", 2), ("c", 5), ("d", 5000), ("e", 4001))}
    groups["f"] = [7.0] * 3000 + [1.0] * 900
    rows = spark.createDataFrame([(g, v) for g, vs in groups.items() for v in vs] + [("z", None)], "g string, v double")
    got = {r.g: (r.n, r.below, r["at"], r.above) for r in middle_values(rows, ["g"], "v", limit=100, k=20).collect()}
    for g, vs in groups.items():
        vs, mid = sorted(vs), (len(vs) - 1) // 2
        assert got[g] == (len(vs), vs[mid - 1] if mid else None, vs[mid], vs[mid + 1] if mid + 1 < len(vs) else None)
    assert "z" not in got


def test_empty_tables(spark):
    d, p, c = frames(spark, [], [], [])
    fitted = fp.fit_folds(d, p, c)
    systems = fp.fold_systems(fitted, d, p)
    assert fitted.parameters().collect() == [] and fp.fold_counts(systems).collect() == []
    assert fp.lasso_logo_refit(systems).collect() == []


def test_one_demand_and_a_feature_without_values(spark):
    d, p, c = frames(spark, [(1, "s", 2.0, None, 3.0)], [(1, "r", 1.0, 2.0)], [(1, 1, 4.0)])
    fitted = fp.fit_folds(d, p, c)
    systems = fp.fold_systems(fitted, d, p)
    row = fitted.parameters().first()
    assert row.threshold is None and row.DF1__mean is None and row.DF2__mean is None
    assert [(r.n_train, r.n_held_out) for r in fp.fold_counts(systems).collect()] == [(0, 0)]
    assert fp.lasso_logo_refit(systems).collect() == []


def test_other_strategies_are_refused(spark):
    with pytest.raises(ValueError):
        fp.fit_folds(*frames(spark, [], [], []), Preprocessor(75.0, "zero"))


def test_pairs_are_not_written_with_their_features(spark, monkeypatch):
    # Plants far apart: only few of them can come or go with a fold, so only few pairs are judged.
    rng = np.random.default_rng(6)
    demand, plants, _ = tables(6, 40, 24)
    costs = [(d, p, float(100 * p + rng.normal())) for d in range(40) for p in range(24)] + [(None, 2, 200.0), (None, 2, 200.0), (7, 3, 301.0)]
    d, p, c = frames(spark, demand, plants, costs)
    written, real = [], fp.materialize
    monkeypatch.setattr(fp, "materialize", lambda df: (written.append((real(df), df.columns)), written[-1][0])[1])
    per_plant, grams = [], gram.gram_stats
    monkeypatch.setattr(gram, "gram_stats", lambda df, features, label, group=None: (per_plant.append(df.select(group).distinct().count()), grams(df, features, label, group))[1])
    systems = fp.fold_systems(fp.fit_folds(d, p, c), d, p)
    regrets = {r.Demand_ID: r for r in fp.lasso_logo_refit(systems, 0.05).collect()}
    pairs = [columns for df, columns in written if df.count() >= 40 * 24 / 2]
    assert pairs == [["demand_id", "plant_id", "cost"]]
    assert max(per_plant) <= 6
    for out in range(0, 40, 9):
        _, _, n_train, n_held, regret = refit(demand, plants, costs, out)
        assert (regrets[out].n_train, regrets[out].n_held_out) == (n_train, n_held)
        assert math.isclose(regrets[out].Selection_Error, regret, abs_tol=1e-9)


def test_sums_of_shared_features(spark):
    rng = np.random.default_rng(8)
    rows = [(float(a), float(b), float(y)) for a, b, y in rng.normal(size=(30, 3))]
    df = spark.createDataFrame(rows, "a double, b double, y double").selectExpr("2.5D as x", "-1.5D as u", "*")
    narrow = df.agg(*gram.stat_aggs(["a", "b"], "y"), F.first("x").alias("x"), F.first("u").alias("u"))
    got = narrow.select(*gram.widened([F.col("x"), F.col("u")], [F.col(c) for c in gram.stat_columns(2)], 2)).first()
    assert list(got) == pytest.approx(list(df.agg(*gram.stat_aggs(["x", "u", "a", "b"], "y")).first()), rel=1e-12, abs=1e-12)
    doubled = df.agg(*[F.sum(c).alias(n) for n, c in zip(gram.stat_columns(2), gram.stat_products(["a", "b"], "y", F.lit(2)))]).first()
    assert [v / 2 for v in doubled] == pytest.approx(list(df.agg(*gram.stat_aggs(["a", "b"], "y")).first()), rel=1e-12)
