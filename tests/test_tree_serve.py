import random

import pytest
from pickwise.operators import serve
from pickwise.operators.tree_serve import best_plant_trees, ensemble_of, model_ensemble
from pickwise.plans.models import fit_model

FEATURES = ["DF1", "DF2", "PF1", "PF2", "PF3"]


def random_ensemble(seed, trees=6, depth=4, grid=12):
    """Trees over all features with thresholds on a grid and values that repeat (ties)."""
    rng, nodes = random.Random(seed), []

    def grow(t, i, d):
        if d == 0 or rng.random() < 0.15:
            nodes.append((t, i, float(rng.randint(0, 6)), -1, -1, -1, 0.0))
            return
        nodes.append((t, i, 0.0, 2 * i + 1, 2 * i + 2, rng.randrange(len(FEATURES)), rng.randint(1, grid) / 2))
        grow(t, 2 * i + 1, d - 1)
        grow(t, 2 * i + 2, d - 1)

    for t in range(trees):
        grow(t, 0, depth)
    return nodes


def predict(nodes, x, weights=None, divisor=1.0):
    by = {(n[0], n[1]): n for n in nodes}
    total = 0.0
    for t in sorted({n[0] for n in nodes}):
        n = by[(t, 0)]
        while n[5] >= 0:
            n = by[(t, n[3] if x[FEATURES[n[5]]] <= n[6] else n[4])]
        total += (weights or {}).get(t, 1.0) * n[2]
    return total / divisor


def tables(spark, seed, n_demands=60, n_plants=230):
    rng = random.Random(seed)
    draw = lambda: rng.choice([None] + [rng.randint(0, 14) / 2 for _ in range(25)])
    d = [(i // 2 if i < 10 else i, draw(), draw()) for i in range(n_demands)]         # some demands come twice
    p = [(f"p{i // 2 if i < 6 else i:04d}", rng.choice("xyz"), draw(), draw(), draw()) for i in range(n_plants)]
    demands = spark.createDataFrame(d, "demand_id long, DF1 double, DF2 double")
    plants = spark.createDataFrame(p, "plant_id string, region string, PF1 double, PF2 double, PF3 double")
    return d, p, demands, plants


def by_force(nodes, d, p, weights=None, divisor=1.0):
    out = []
    for key, *df in d:
        best = None
        for pk, region, *pf in p:
            if None in df or None in pf:
                continue
            rank = (predict(nodes, dict(zip(FEATURES, df + pf)), weights, divisor), pk, region)
            best = rank if best is None or rank < best else best
        out.append((key, best[1], best[2], best[0]) if best else (key, None, None, None))
    return sorted(out, key=repr)


def got(serving):
    return sorted((tuple(r) for r in serving.picks.select("demand_id", "selected_plant", "region", "raw_prediction").collect()), key=repr)


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(spark, seed):
    nodes = random_ensemble(seed)
    weights = {t: w for t, w in enumerate([1.0, 0.5, -0.25, 0.1, 2.0, 0.3])}
    d, p, demands, plants = tables(spark, seed)
    out = best_plant_trees(ensemble_of(nodes, FEATURES, weights, 3.0), demands, plants, plant_info=["region"], leaf=4, fanout=3)
    assert got(out) == by_force(nodes, d, p, weights, 3.0)
    assert len(out.bounded) > 2


def test_far_fewer_pairs_than_all(spark):
    rng = random.Random(4)
    # Costs that follow the plant's first feature: most boxes cannot hold the best plant.
    nodes = [(0, i, 0.0, 2 * i + 1, 2 * i + 2, 2, float(t)) for i, t in ((0, 50), (1, 25), (2, 75))]
    nodes += [(0, i, float(v), -1, -1, -1, 0.0) for i, v in ((3, 1), (4, 5), (5, 9), (6, 20))]
    nodes += [(1, 0, 0.0, 1, 2, 0, 3.0), (1, 1, 1.0, -1, -1, -1, 0.0), (1, 2, 2.0, -1, -1, -1, 0.0)]
    nodes += [(2, 0, 0.0, 1, 2, 3, 40.5), (2, 1, 0.5, -1, -1, -1, 0.0), (2, 2, 1.5, -1, -1, -1, 0.0)]
    d = [(i, rng.random() * 6, rng.random()) for i in range(400)]
    p = [(f"p{i:05d}", "r", rng.random() * 100, rng.random() * 100, 0.0) for i in range(3000)]
    demands = spark.createDataFrame(d, "demand_id long, DF1 double, DF2 double")
    plants = spark.createDataFrame(p, "plant_id string, region string, PF1 double, PF2 double, PF3 double")
    out = best_plant_trees(ensemble_of(nodes, FEATURES), demands, plants, plant_info=["region"])
    assert got(out) == by_force(nodes, d, p)
    assert out.all_pairs == 400 * 3000 and sum(out.bounded) < out.all_pairs / 100


@pytest.mark.parametrize("kind", ["random_forest", "gradient_boosting"])
def test_fitted_models(spark, kind):
    rng = random.Random(8)
    d, p, demands, plants = tables(spark, 5, 40, 90)
    rows = [(a[0], b[0], a[1], a[2], b[2], b[3], b[4], rng.random() * 5 + a[1] + b[2] * b[3]) for a in d for b in p if None not in a + b]
    train = spark.createDataFrame(rows, "Demand_ID long, Plant_ID string, DF1 double, DF2 double, PF1 double, PF2 double, PF3 double, Cost double")
    model = fit_model(kind, {"n_estimators": 4, "max_depth": 4, "learning_rate": 0.3}, 1, train, FEATURES)
    want = serve.best_plant_scored(model, demands, plants, plant_info=["region"])
    want = {r.demand_id: (r.selected_plant, r.raw_prediction) for r in want.collect()}
    out = best_plant_trees(model_ensemble(model, spark), demands, plants, plant_info=["region"])
    seen = out.picks.collect()
    assert len(seen) == len(d)
    first = {}
    for key, *features in d:
        first.setdefault(key, []).append(features)
    for r in seen:
        if len(first[r.demand_id]) == 1:
            plant, prediction = want[r.demand_id]
            assert r.selected_plant == plant and (prediction is None) == (r.raw_prediction is None)
            assert prediction is None or r.raw_prediction == pytest.approx(prediction, abs=1e-12)


def test_no_candidates_and_one_sided_ensembles(spark):
    d, p, demands, plants = tables(spark, 3, 20, 15)
    nodes = random_ensemble(3)
    none = best_plant_trees(ensemble_of(nodes, FEATURES), demands, plants.limit(0), plant_info=["region"])
    assert {r[1:] for r in got(none)} == {(None, None, None)} and len(got(none)) == 20
    assert best_plant_trees(ensemble_of(nodes, FEATURES), demands.limit(0), plants, plant_info=["region"]).picks.count() == 0
    leaf = [(0, 0, 4.0, -1, -1, -1, 0.0)]
    assert got(best_plant_trees(ensemble_of(leaf, FEATURES), demands, plants, plant_info=["region"])) == by_force(leaf, d, p)
