import os
import tempfile

import numpy as np
from pyspark.sql import functions as F

from pickwise.plans.run import SelectionOptions, run_selection
from pickwise.sources.tables import read_selection_inputs


def write_inputs(folder):
    rng = np.random.default_rng(4)
    with open(os.path.join(folder, "demand.csv"), "w") as f:
        f.write("Demand ID,DF1,DF2,Note\n")
        for d in range(1, 13):
            df2 = "" if d % 5 == 0 else f"{rng.normal():.6f}"
            f.write(f"D{d},{rng.normal():.6f},{df2},x\n")
    with open(os.path.join(folder, "plants.csv"), "w") as f:
        f.write("Plant ID,Plant Type,Region,PF1,PF2\n")
        for p in range(1, 7):
            region = "NA" if p % 2 else "EU"
            f.write(f"P{p},Gas,{region},{rng.normal():.6f},{rng.normal():.6f}\n")
    with open(os.path.join(folder, "generation_costs.csv"), "w") as f:
        f.write("Demand ID,Plant ID,Cost_USD_per_MWh\n")
        for d in range(1, 13):
            for p in range(1, 7):
                cost = "" if (d, p) == (3, 2) else f"{50 + 5 * p + d + rng.normal():.4f}"
                f.write(f"D{d},P{p},{cost}\n")


def test_reference_style_csv_run(spark):
    folder = tempfile.mkdtemp(prefix="pw-ref-")
    write_inputs(folder)
    demand, plants, costs = read_selection_inputs(
        spark, f"{folder}/demand.csv", f"{folder}/plants.csv", f"{folder}/generation_costs.csv")
    assert plants.filter(F.col("Region") == "NA").count() == 3
    run = run_selection(spark, demand, plants, costs, SelectionOptions(
        model_type="lasso", demand_key="Demand ID", plant_key="Plant ID", cost="Cost_USD_per_MWh",
        test_size_percent=25, cv_n_folds=None, hyperparam_cv_folds=None, tuning_grid={"alpha": [0.01, 1.0]}))
    assert run.prep.demand_features == ["DF1", "DF2"] and run.prep.plant_features == ["PF1", "PF2"]
    scen = run.final.test.scenario.collect()
    assert len(scen) == 3 and all(r.Selection_Error >= 0 for r in scen)
    folds = run.final.logo_folds.orderBy("Fold").collect()
    # groups are the digit runs of the ids, folds in ascending group order
    assert [r.Demand_ID for r in folds] == list(range(1, 13))
    good = run.prep.flags.filter("is_good").count()
    assert good == 4  # linear 75th percentile of 6 medians sits at position 3.75: 4 plants at or below
