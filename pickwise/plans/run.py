"""The whole selection run as one call.

``run_selection`` returns lazy DataFrames and fitted models; the only driver
values are model parameters, scaler parameters, the cut-off and a handful of
RMSE numbers.
"""

from __future__ import annotations

import time
from dataclasses import dataclass, field
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.quantiles import DEFAULT_METHOD
from ..operators.combine import DEMAND, combine, orphan_counts
from ..operators.prepare import STRATEGIES, Preprocessor
from ..operators.regret import error_stats
from ..operators.split import flag_test, group_split, split_cut
from ..operators.summaries import model_comparison, summary_bundle
from ..sources import sinks
from .cv import evaluate, gram_folds, grid_search, logo_cv, materialize
from .models import DEFAULT_GRIDS, DEFAULT_PARAMS, check_model_type, fit_model, model_description, model_name


@dataclass
class SelectionOptions:
    """The run's settings, checked on creation."""
    model_type: str = "random_forest"
    random_seed: int = 1072002
    plant_filter_percentile: float = 75.0
    missing_value_strategy: str = "mean"
    test_size_percent: float = 5.0
    cv_n_folds: int | None = None
    parallelism: int = 4
    model_params: dict | None = None
    tuning_grid: dict | None = None
    hyperparam_enabled: bool = True
    hyperparam_cv_folds: int | None = None
    hyperparam_scoring: str = "regret"
    fold_mode: str | None = None
    kfold_k: int = 5
    quantile_method: str = DEFAULT_METHOD
    demand_key: str = "demand_id"
    plant_key: str = "plant_id"
    cost: str = "cost"
    output_dir: str | None = None
    on_orphan: str = "drop"
    #: 'all' fits the preprocessor on every demand (as the reference does), 'train' on the training demands only.
    fit_on: str = "all"
    fill_from: str = "transform"
    #: Folder of the ledgers of tree fits; a stopped run that is started again with it goes on.
    ledger_dir: str | None = None
    extra: dict = field(default_factory=dict)

    def __post_init__(self):
        check_model_type(self.model_type)
        if self.missing_value_strategy not in STRATEGIES:
            # The reference treats any other string as 'zero'; keep that.
            self.missing_value_strategy = "zero"
        if not 0 < float(self.test_size_percent) < 100:
            raise ValueError("test_size_percent must be in (0, 100)")
        if self.hyperparam_scoring not in ("regret", "rmse"):
            raise ValueError("hyperparam_scoring must be 'regret' or 'rmse'")
        if self.on_orphan not in ("drop", "error"):
            raise ValueError("on_orphan must be 'drop' or 'error'")
        if self.fit_on not in ("all", "train"):
            raise ValueError("fit_on must be 'all' or 'train'")
        if self.fill_from not in ("transform", "fit"):
            raise ValueError("fill_from must be 'transform' or 'fit'")
        # A tree model is fitted once per fold, so it cannot leave out every
        # group in turn: without fold counts its folds are hashed groups.
        bounded = self.cv_n_folds is not None and (not self.hyperparam_enabled or self.hyperparam_cv_folds is not None)
        if self.fold_mode is None:
            self.fold_mode = "logo" if self.model_type == "lasso" or bounded else "kfold"
        if self.fold_mode not in ("logo", "kfold"):
            raise ValueError("fold_mode must be 'logo' or 'kfold'")
        if self.fold_mode == "logo" and self.model_type != "lasso" and not bounded:
            raise ValueError("leave-one-group-out with fitted models needs cv_n_folds and hyperparam_cv_folds; "
                             "use fold_mode='kfold' to cover every group")
        if self.model_params is None:
            self.model_params = dict(DEFAULT_PARAMS[self.model_type])
        if self.tuning_grid is None:
            self.tuning_grid = dict(DEFAULT_GRIDS[self.model_type])


@dataclass
class ModelResults:
    params: dict
    model: object
    test: object
    logo_folds: DataFrame
    quantile_method: str = DEFAULT_METHOD
    leaderboard: DataFrame | None = None
    best_rmse: float | None = None

    @cached_property
    def logo_stats(self) -> DataFrame:
        """A10 over the fold regrets (built on first access)."""
        return error_stats(self.logo_folds, quantile_method=self.quantile_method)


@dataclass
class SelectionRun:
    options: SelectionOptions
    ingest: DataFrame
    prep: object
    combined: DataFrame
    train: DataFrame
    test: DataFrame
    baseline: ModelResults
    optimized: ModelResults | None
    final: ModelResults
    summaries: dict
    timings: dict = field(default_factory=dict)
    orphans: DataFrame | None = None

    @cached_property
    def comparison(self) -> DataFrame:
        """A20 for baseline vs optimized, test and LOGO (built on first access)."""
        errors = {("baseline", "test"): self.baseline.test.scenario, ("baseline", "logo"): self.baseline.logo_folds}
        if self.optimized is not None:
            errors[("optimized", "test")] = self.optimized.test.scenario
            errors[("optimized", "logo")] = self.optimized.logo_folds
        return model_comparison(errors)


def model_key(params: dict) -> str:
    """A folder name for a parameter set."""
    return "-".join(f"{k}={params[k]}" for k in sorted(params))


def _ledger(opts: SelectionOptions, name: str) -> str | None:
    return f"{opts.ledger_dir.rstrip('/')}/{name}" if opts.ledger_dir else None


def _results(opts: SelectionOptions, params: dict, combined, train, test, features, prepared,
             folds: DataFrame | None = None) -> ModelResults:
    model = fit_model(opts.model_type, params, opts.random_seed, train, features)
    ev = evaluate(model, test, opts.quantile_method)
    if folds is None:
        folds = logo_cv(opts.model_type, params, combined, features, opts.random_seed, opts.cv_n_folds,
                        opts.parallelism, opts.fold_mode, opts.kfold_k, prepared=prepared.get(opts.cv_n_folds),
                        ledger=_ledger(opts, "cv-" + model_key(params)))
        folds = materialize(folds)
    return ModelResults(params, model, ev, folds, opts.quantile_method)


def run_selection(spark: SparkSession, demand: DataFrame, plants: DataFrame, costs: DataFrame,
                  options: SelectionOptions | None = None, **overrides) -> SelectionRun:
    """Ingest report, preprocess, combine, split, baseline fit + test
    evaluation + LOGO CV, optional grid search and optimized model, final
    choice, optional artifacts, summaries."""
    opts = options or SelectionOptions(**overrides)
    clock = _Clock()
    orphans = orphan_counts(demand, plants, costs, opts.demand_key, opts.plant_key)
    if opts.on_orphan == "error":
        found = orphans.first()
        if found["no_demand"] or found["no_plant"]:
            raise ValueError(f"costs without a demand row: {found['no_demand']}, without a plant row: {found['no_plant']}")
    ingest = sinks.ingest_report({"demand": demand, "plants": plants, "costs": costs})
    fraction = float(opts.test_size_percent) / 100.0
    cut, seen, seen_costs = None, demand, costs
    if opts.fit_on == "train":
        # The split comes first; test demands and their costs are not seen by the fit.
        ids = demand.select(opts.demand_key).filter(F.col(opts.demand_key).isNotNull()).distinct()
        cut = materialize(split_cut(ids, opts.demand_key, fraction, opts.random_seed))
        seen, seen_costs = (flag_test(df, cut, opts.demand_key, opts.random_seed).filter("not is_test").drop("is_test")
                            for df in (demand, costs))
    prep = Preprocessor(opts.plant_filter_percentile, opts.missing_value_strategy, opts.demand_key, opts.plant_key, opts.cost,
                        quantile_method=opts.quantile_method, fill_from=opts.fill_from).fit(seen, plants, seen_costs)
    clock.lap("preprocess_fit")
    d, p, c = prep.transform(demand, plants, costs)
    features = prep.all_features
    combined = materialize(combine(d, p, c, prep.demand_features, prep.plant_features,
                                   opts.demand_key, opts.plant_key, opts.cost))
    # The flag is a projection of the (checkpointed) combined rows against a
    # one-row cut, so it is cheap to recompute and is not written again.
    clock.lap("combine")
    flagged = group_split(combined, fraction, opts.random_seed) if cut is None else flag_test(
        combined, cut.withColumnRenamed(opts.demand_key, DEMAND), DEMAND, opts.random_seed)
    clock.lap("split")
    train = flagged.filter(~F.col("is_test")).drop("is_test")
    test = flagged.filter(F.col("is_test")).drop("is_test")

    # Lasso LOGO and grid share one set of group statistics; only the fold
    # table differs between the LOGO and the tuning fold counts.
    prepared = {}
    if opts.model_type == "lasso" and opts.fold_mode == "logo":
        for nf in {opts.cv_n_folds, opts.hyperparam_cv_folds}:
            first = next(iter(prepared.values()), None)
            prepared[nf] = gram_folds(combined, features, nf, like=first)
    clock.lap("group_statistics")
    baseline = _results(opts, dict(opts.model_params), combined, train, test, features, prepared)
    clock.lap("baseline")
    optimized = None
    if opts.hyperparam_enabled:
        g = grid_search(opts.model_type, opts.tuning_grid, combined, features, opts.random_seed,
                        opts.hyperparam_cv_folds, opts.parallelism, opts.hyperparam_scoring,
                        opts.fold_mode, opts.kfold_k, defaults=opts.model_params,
                        prepared=prepared.get(opts.hyperparam_cv_folds), ledger=_ledger(opts, "grid"))
        clock.lap("grid_search")
        # Grid values over the defaults (the reference drops non-grid defaults).
        best = {**opts.model_params, **g.best_params}
        reuse = None
        if (opts.model_type == "lasso" and opts.fold_mode == "logo" and opts.hyperparam_scoring == "regret"
                and opts.cv_n_folds == opts.hyperparam_cv_folds and set(opts.tuning_grid) <= {"alpha"}
                and g.best_combo is not None):
            # The grid already ran every fold of the best alpha on the same folds.
            reuse = (g.fold_scores.filter(F.col("combo_idx") == g.best_combo)
                     .select("Fold", "Demand_ID", "Selection_Error", "Fold_RMSE"))
        optimized = _results(opts, best, combined, train, test, features, prepared, reuse)
        optimized.leaderboard, optimized.best_rmse = g.leaderboard, g.best_rmse
        clock.lap("optimized")
    final = optimized if optimized is not None else baseline

    scored_train = final.model.transform(train)
    imp = final.model.feature_importances()
    from ..operators.summaries import feature_importance
    importances = feature_importance(imp, features, spark) if imp is not None else None
    summaries = summary_bundle(costs, scored_train, final.test.scored, final.test.scenario, final.logo_folds,
                               opts.plant_key, opts.cost, importances, opts.quantile_method)
    clock.lap("summaries")
    run = SelectionRun(opts, ingest, prep, combined, train, test, baseline, optimized, final,
                       summaries, clock.laps, orphans)
    if opts.output_dir:
        write_artifacts(spark, run)
        clock.lap("artifacts")
    return run


class _Clock:
    """Wall time of the eager steps (fits, checkpoints) per stage."""

    def __init__(self):
        self.laps: dict[str, float] = {}
        self._t = time.perf_counter()

    def lap(self, name: str) -> None:
        now = time.perf_counter()
        self.laps[name] = round(now - self._t, 3)
        self._t = now


def write_artifacts(spark: SparkSession, run: SelectionRun) -> None:
    """S4-S10 under ``output_dir``."""
    o, f = run.options, run.final
    out = o.output_dir
    sinks.write_table(f.test.scenario, f"{out}/results/scenario_selections", "csv")
    sinks.write_table(f.logo_folds, f"{out}/results/logo_cv_folds", "csv")
    if f.leaderboard is not None:
        sinks.write_table(f.leaderboard, f"{out}/results/hyperparameter_leaderboard", "csv")
    sinks.write_table(run.comparison, f"{out}/results/model_comparison", "csv")
    sinks.write_table(sinks.report_header_frame(spark, o.model_type, model_name(o.model_type),
                                                model_description(o.model_type), run.baseline.params, f.params,
                                                o.hyperparam_enabled), f"{out}/results/report_header", "json")
    f.model.save(spark, f"{out}/artifacts/final_model")
    run.prep.save(f"{out}/artifacts/preprocessor")
    sinks.write_table(sinks.feature_names_frame(spark, run.prep.demand_features, run.prep.plant_features),
                      f"{out}/artifacts/feature_names", "json")
    for name, summary in run.summaries.items():
        sinks.write_table(summary, f"{out}/results/summaries/{name}", "csv")
    sinks.write_table(run.orphans, f"{out}/results/orphan_counts", "csv")
    test_rmse = f.test.stats.select("rmse").first()[0]
    logo_rmse = f.logo_stats.select("rmse").first()[0]
    n_folds = f.logo_folds.select("Fold").distinct().count()
    sinks.append_json(sinks.run_metadata_frame(spark, o.model_type, o.random_seed, f.params, test_rmse,
                                               logo_rmse, n_folds, o.hyperparam_enabled),
                      f"{out}/results/run_metadata")
