import json
import math
import tempfile

import pytest
from pyspark.sql import functions as F

from pickwise import catalog
from pickwise.operators.prepare import PreprocessModel
from pickwise.operators.serve import best_plant
from pickwise.plans.models import FittedModel, create_estimator
from pickwise.plans.run import SelectionOptions, run_selection

SF = "/root/testdata/sf0.001"


def test_run_writes_and_reloads_artifacts(spark):
    out = tempfile.mkdtemp(prefix="pw-run-")
    d, p, c = catalog.inputs(spark, SF)
    run = run_selection(spark, d, p, c, SelectionOptions(model_type="lasso", cv_n_folds=20, hyperparam_cv_folds=10,
                                                         tuning_grid={"alpha": [0.1, 1.0]}, output_dir=out))
    assert set(run.timings) >= {"preprocess_fit", "combine", "split", "baseline", "grid_search", "optimized"}
    meta = spark.read.json(f"{out}/results/run_metadata").first()
    assert meta.model_type == "lasso" and meta.n_logo_folds == 20
    assert json.loads(meta.final_params)["alpha"] in (0.1, 1.0)
    head = spark.read.json(f"{out}/results/report_header").first()
    assert head.model_name == "Lasso Regression" and head.description.startswith("Linear regression")
    folds = spark.read.option("header", True).csv(f"{out}/results/logo_cv_folds")
    assert folds.count() == 20
    board = spark.read.option("header", True).csv(f"{out}/results/hyperparameter_leaderboard")
    assert sorted(int(r["rank"]) for r in board.collect()) == [1, 2]

    model = FittedModel.load(spark, f"{out}/artifacts/final_model")
    prep = PreprocessModel.load(spark, f"{out}/artifacts/preprocessor")
    assert model.coef == run.final.model.coef and prep.threshold == run.prep.threshold
    served = best_plant(model, prep, d, p, plant_info=["region"])
    again = best_plant(run.final.model, run.prep, d, p, plant_info=["region"])
    a = {r.demand_id: (r.selected_plant, r.raw_prediction) for r in served.collect()}
    b = {r.demand_id: (r.selected_plant, r.raw_prediction) for r in again.collect()}
    assert a.keys() == b.keys() and all(a[k][0] == b[k][0] and math.isclose(a[k][1], b[k][1]) for k in a)

    comp = run.comparison.filter(F.col("metric") == "rmse").collect()
    assert {(r.model, r.evaluation) for r in comp} == {("baseline", "test"), ("baseline", "logo"),
                                                        ("optimized", "test"), ("optimized", "logo")}
    assert len(run.summaries) == 17 and set(run.summaries) >= {"cost_histogram", "boxplot_stats", "plant_performance"}
    assert {f"{side}_{view}" for side in ("train", "test") for view in ("density", "sample")} <= set(run.summaries)
    assert spark.read.option("header", True).csv(f"{out}/results/summaries/cost_histogram").count() == 50
    cum = run.summaries["cumulative_rmse"].orderBy("Fold").collect()
    last = run.final.logo_stats.first()["rmse"]
    assert math.isclose(cum[-1].cumulative_rmse, last, rel_tol=1e-9)


def test_forest_run_end_to_end(spark):
    d, p, c = catalog.inputs(spark, SF)
    run = run_selection(spark, d, p, c, SelectionOptions(
        model_type="random_forest", model_params={"n_estimators": 5, "max_depth": 3, "min_samples_split": 2},
        tuning_grid={"n_estimators": [3, 5], "max_depth": [2]}, cv_n_folds=3, hyperparam_cv_folds=2,
        parallelism=3))
    board = run.final.leaderboard.orderBy("rank").collect()
    assert [r["rank"] for r in board] == [1, 2] and all(r.n_folds == 2 for r in board)
    assert run.final.params["max_depth"] == 2
    folds = run.final.logo_folds.orderBy("Fold").collect()
    assert [r.Fold for r in folds] == [1, 2, 3] and all(r.Selection_Error >= 0 for r in folds)
    imp = run.summaries["feature_importance"].collect()
    assert len(imp) == 8 and math.isclose(sum(r.importance for r in imp), 1.0, rel_tol=1e-9)
    assert run.summaries["regret_histogram"].agg(F.sum("count")).first()[0] == run.final.test.scenario.count()


def test_options_are_checked_before_any_job(spark):
    assert SelectionOptions().fold_mode == "kfold" and SelectionOptions(model_type="lasso").fold_mode == "logo"
    with pytest.raises(ValueError):
        SelectionOptions(model_type="random_forest", fold_mode="logo")
    with pytest.raises(ValueError):
        create_estimator("random_forest", {"max_depth": 50}, 1)


def test_orphan_costs_stop_the_run_if_asked(spark):
    d, p, c = catalog.inputs(spark, SF)
    with pytest.raises(ValueError, match="plant row"):
        run_selection(spark, d, p.filter("plant_id > 3"), c, SelectionOptions(model_type="lasso", on_orphan="error"))
