import math
import os
import tempfile


from pickwise.operators import serve
from pickwise.operators.combine import combine, first_per_key, orphan_counts
from pickwise.plans.models import FittedModel
from pickwise.sources.tables import plants_schema, read_csv


def test_linear_serving_equals_pair_scoring(spark):
    demands = spark.createDataFrame([(d, float(d) / 3, float(d % 4)) for d in range(30)],
                                    "demand_id long, DF1 double, DF2 double")
    plants = spark.createDataFrame([(p, "r" + str(p % 3), float(p % 5) - 2, float(p) / 7) for p in range(12)],
                                   "plant_id long, region string, PF1 double, PF2 double")
    feats = ["DF1", "DF2", "PF1", "PF2"]
    model = FittedModel("lasso", {}, feats, intercept=5.0, coef=[0.5, -1.0, 2.0, -3.0])
    fast = serve.best_plant_linear(demands, plants, 5.0, dict(zip(feats, model.coef)), feats[:2], feats[2:],
                                   plant_info=["region"])
    brute = serve.best_plant_scored(model, demands, plants, plant_info=["region"], feature_count=4)
    a = {r.demand_id: (r.selected_plant, r.region, r.raw_prediction) for r in fast.collect()}
    b = {r.demand_id: (r.selected_plant, r.region, r.raw_prediction) for r in brute.collect()}
    assert a.keys() == b.keys()
    for k in a:
        assert a[k][:2] == b[k][:2] and math.isclose(a[k][2], b[k][2], rel_tol=1e-12)


def test_block_search_of_a_tree_model(spark):
    from pickwise.plans.models import fit_model
    rows = [(float(d), float(p), abs(d - p) + 0.1 * p) for d in range(12) for p in range(9)]
    train = spark.createDataFrame(rows, "DF1 double, PF1 double, Cost double")
    model = fit_model("random_forest", {"n_estimators": 3, "max_depth": 4}, 1, train, ["DF1", "PF1"])
    demands = spark.createDataFrame([(d, None if d == 11 else float(d)) for d in range(12)], "demand_id long, DF1 double")
    plants = spark.createDataFrame([(p, "r", None if p == 0 else float(p)) for p in range(9)],
                                   "plant_id long, region string, PF1 double")
    got = {r.demand_id: r.selected_plant for r in serve.best_plant_scored(
        model, demands, plants, plant_info=["region"], block_rows=4).collect()}
    pairs = model.transform(demands.na.drop().crossJoin(plants.na.drop())).collect()
    want = {d: min((r.prediction, r.plant_id) for r in pairs if r.demand_id == d)[1] for d in range(11)}
    assert got == want | {11: None}


def test_pairs_with_duplicate_dimension_rows(spark):
    demands = spark.createDataFrame([(1, 1.0), (1, 2.0), (2, 3.0)], "demand_id long, DF1 double")
    plants = spark.createDataFrame([(1, 1.0), (1, 1.0)], "plant_id long, PF1 double")
    pairs = spark.createDataFrame([(1, 1), (2, 1)], "demand_id long, plant_id long")
    model = FittedModel("lasso", {}, ["DF1", "PF1"], intercept=0.0, coef=[1.0, 1.0])
    got = sorted((r.demand_id, r.prediction) for r in serve.score_pairs(model, demands, plants, pairs, ["DF1"], ["PF1"]).collect())
    assert got == [(1, 2.0), (2, 4.0)]


def test_position_lookup_rounds_half_even_and_clamps(spark):
    plants = spark.createDataFrame([(p,) for p in (10, 20, 30, 40)], "plant_id long")
    preds = spark.createDataFrame([(1, -3.0), (2, 0.5), (3, 1.5), (4, 2.4), (5, 99.0), (6, None)], "k int, v double")
    got = {r.k: r.selected_plant for r in serve.position_lookup(preds, plants, "v").collect()}
    assert got == {1: 10, 2: 10, 3: 30, 4: 30, 5: 40, 6: None}


def test_csv_na_stays_value_empty_is_null(spark):
    folder = tempfile.mkdtemp(prefix="pw-csv-")
    path = os.path.join(folder, "plants.csv")
    with open(path, "w") as f:
        f.write("Plant ID,Plant Type,Region,PF1,PF2\nP1,Gas,NA,1.5,\nP2,Coal,,NaN,2.0\n")
    df = read_csv(spark, path, plants_schema(2)).orderBy("Plant ID").collect()
    assert df[0]["Region"] == "NA" and df[0]["PF2"] is None
    assert df[1]["Region"] is None and df[1]["PF1"] is None


def test_duplicate_dimension_key_first_row_wins(spark):
    plants = spark.createDataFrame([(1, 0, 5.0), (1, 1, 7.0), (2, 0, 1.0)], "plant_id long, ord int, PF1 double")
    got = {r.plant_id: r.PF1 for r in first_per_key(plants, "plant_id", ["PF1"], "ord").collect()}
    assert got == {1: 5.0, 2: 1.0}


def test_orphans_dropped_and_counted(spark):
    demand = spark.createDataFrame([(1, 0.1)], "demand_id long, DF1 double")
    plants = spark.createDataFrame([(1, 0.2)], "plant_id long, PF1 double")
    costs = spark.createDataFrame([(1, 1, 3.0), (1, 9, 4.0), (8, 1, 5.0)], "demand_id long, plant_id long, cost double")
    comb = combine(demand, plants, costs, ["DF1"], ["PF1"])
    assert comb.count() == 1
    r = orphan_counts(demand, plants, costs).first()
    assert (r.cost_rows, r.no_demand, r.no_plant) == (3, 1, 1)
