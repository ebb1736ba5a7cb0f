"""Bench: run the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS] and
print one JSON line. Each query runs to completion through the ``noop`` sink
(full plan, nothing collected)."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pickwise import catalog  # noqa: E402
from pickwise.session import local_session  # noqa: E402

HEADLINE = [
    "full_run",             # E1: preprocess, combine, split, Lasso fit, LOGO over all demands, grid
    "lasso_logo_cv",        # G3: exact leave-one-demand-out over every demand
    "lasso_grid_search",    # G4: 5 alphas x every demand
    "scenario_table",       # A8: argmin per demand
    "plant_cost_stats",     # A1: per-plant median/mean/count
    "plant_cost_stats_sorted",  # A1 via the skew-safe exact quantile
    "combined_dataset",     # J1 + P1-P12
    "group_split",          # G1
    "serve_best_plant",     # I2 (linear, pair-free)
    "serve_pair_cost",      # I3
    "cumulative_rmse",      # W2
    "boxplot_stats",        # A17
    "forest_fit",           # M1
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cores=cpus, shuffle_partitions=int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", "16")))
    # Warm-up (not timed): JVM class loading, code generation and the Python
    # workers of the Arrow solver, on the smallest tables when present so no
    # data of the timed scale is touched.
    warm_dir = os.environ.get("BENCH_WARMUP_DIR", "/root/testdata/sf0.001")
    warm_dir = warm_dir if os.path.isdir(warm_dir) else sf_dir
    for name in ("standardize_demands", "scenario_table", "plant_cost_stats", "lasso_logo_cv"):
        catalog.QUERIES[name](spark, warm_dir).write.format("noop").mode("overwrite").save()
    times = {}
    for name in HEADLINE:
        t0 = time.perf_counter()
        df = catalog.QUERIES[name](spark, sf_dir)
        df.write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": sf}))


if __name__ == "__main__":
    main()
