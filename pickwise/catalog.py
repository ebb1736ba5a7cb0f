"""Registered queries: every operator run end to end on the stand-in tables
derived from the driver's tables (see ``sources.fixtures``).

Each function takes ``(spark, sf_dir)`` and returns a DataFrame over the whole
tables. Computed doubles are rounded to 6 places so that results compare
across engines; column names equal those of the SQL oracle.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .functions.columns import group_key
from .operators import combine as cmb
from .operators import prepare as prep
from .operators import display, distinct_sets, regret, serve, split, summaries
from .operators.tree_serve import best_plant_trees, ensemble_of
from .plans import cv, fold_prepare, gram
from .plans.models import FittedModel, fit_model
from .plans.run import SelectionOptions, run_selection
from .session import ensure_checkpoint_dir
from .sources import fixtures as fx
from .sources import ingest, sinks

SEED = 1072002
TEST_FRACTION = 0.05
PERCENTILE = 75.0

# Fixed linear scorer used by the serving queries (fixed values).
SERVE_INTERCEPT = 1000.0
SERVE_WEIGHTS = {"DF1": 0.5, "DF2": -2.0, "DF3": 1.5, "DF4": 0.25,
                 "PF1": 3.0, "PF2": -1.0, "PF3": -4.0, "PF4": 2.0}


def round_sig(c, digits: int = 9):
    """Round to ``digits`` significant digits (for sums whose magnitude makes
    a fixed number of decimals depend on summation order)."""
    x = F.col(c)
    e = F.floor(F.log10(F.abs(x)))
    scale = F.pow(F.lit(10.0), e)
    return F.when(x == 0, F.lit(0.0)).otherwise(F.round(x / scale, digits - 1) * scale).alias(c)


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every double column (for cross-engine comparison)."""
    return df.select(*[F.round(F.col(f.name), digits).alias(f.name) if isinstance(f.dataType, T.DoubleType)
                       else F.col(f.name) for f in df.schema.fields])


# ------------------------------------------------------------------ inputs

def inputs(spark: SparkSession, sf: str):
    return fx.fixture_demands(spark, sf), fx.fixture_plants(spark, sf), fx.fixture_costs(spark, sf)


def staged_inputs(spark: SparkSession, sf: str):
    """The three inputs written once to the checkpoint folder, for queries
    that read them in several jobs (fit, transform, combine)."""
    return tuple(cv.materialize(df) for df in inputs(spark, sf))


def fitted(spark: SparkSession, sf: str, strategy: str = "mean"):
    d, p, c = staged_inputs(spark, sf)
    model = prep.Preprocessor(PERCENTILE, strategy).fit(d, p, c)
    return model, d, p, c


def combined(spark: SparkSession, sf: str, reuse: bool = False) -> DataFrame:
    """The combined table; ``reuse`` writes it to the checkpoint folder once
    for queries that read it several times."""
    model, d, p, c = fitted(spark, sf)
    dd, pp, cc = model.transform(d, p, c)
    out = cmb.combine(dd, pp, cc, model.demand_features, model.plant_features)
    return cv.materialize(out) if reuse else out


def predicted(spark: SparkSession, sf: str) -> DataFrame:
    """The stand-in model's scored rows in combined naming."""
    return fx.fixture_predicted(spark, sf).select(
        F.col("demand_id").alias(cmb.DEMAND), F.col("plant_id").alias(cmb.PLANT),
        F.col("cost").alias(cmb.COST), F.col("pred").alias("prediction"))


def scenario(spark: SparkSession, sf: str) -> DataFrame:
    return regret.scenario_table(predicted(spark, sf))


def segment_predicted(costs: DataFrame, demands: DataFrame) -> DataFrame:
    """Second stand-in: the plant's mean cost over the other demands of the
    same market segment."""
    rows = costs.join(demands.select("demand_id", "segment"), "demand_id")
    tot = rows.groupBy("plant_id", "segment").agg(F.sum("cost").alias("tot"), F.count("cost").alias("n"))
    j = rows.join(tot.hint("rebalance"), ["plant_id", "segment"])
    return j.select(F.col("demand_id").alias(cmb.DEMAND), F.col("plant_id").alias(cmb.PLANT),
                    F.col("cost").alias(cmb.COST),
                    F.when(F.col("n") > 1, (F.col("tot") - F.col("cost")) / (F.col("n") - 1)).alias("prediction"))


def demand_split(df: DataFrame) -> DataFrame:
    return split.group_split(df, TEST_FRACTION, SEED)


# ----------------------------------------------------------------- queries

def q_ingest_report(spark, sf):
    d, p, c = inputs(spark, sf)
    return sinks.ingest_report({"demand": d, "plants": p, "costs": c})


def _impute(strategy):
    def q(spark, sf):
        d = fx.fixture_demands(spark, sf)
        feats = prep.discover_features(d, "DF")
        return rounded(prep.impute(d, feats, strategy).select("demand_id", *feats))
    return q


def q_standardize_demands(spark, sf):
    model, d, _, _ = fitted(spark, sf)
    return rounded(model.transform_demand(d).select("demand_id", *model.demand_features))


def q_standardize_plants(spark, sf):
    model, _, p, _ = fitted(spark, sf)
    return rounded(model.transform_plants(p, only_good=False).select("plant_id", *model.plant_features))


def q_preprocess_summary(spark, sf):
    model, _, _, _ = fitted(spark, sf)
    return rounded(model.summary())


def q_plant_cost_stats(spark, sf):
    return rounded(prep.plant_cost_stats(fx.fixture_costs(spark, sf)))


def q_plant_cost_stats_sorted(spark, sf):
    """A1 through the skew-safe exact quantile (same values as A1)."""
    return rounded(prep.plant_cost_stats(fx.fixture_costs(spark, sf), quantile_method="sorted"))


def q_plant_threshold(spark, sf):
    return rounded(prep.cost_threshold(prep.plant_cost_stats(fx.fixture_costs(spark, sf)), PERCENTILE))


def q_plant_good_flag(spark, sf):
    model, _, _, _ = fitted(spark, sf)
    return rounded(model.flags.select("plant_id", "median_cost", "is_good"))


def q_filter_plants(spark, sf):
    model, _, p, _ = fitted(spark, sf)
    return rounded(model.transform_plants(p).select("plant_id", "region", *model.plant_features))


def q_filter_costs(spark, sf):
    model, d, p, c = fitted(spark, sf)
    return rounded(model.transform(d, p, c)[2].select("demand_id", "plant_id", "cost"))


def q_combined_dataset(spark, sf):
    return rounded(combined(spark, sf))


def q_combined_counts(spark, sf):
    model, d, p, c = fitted(spark, sf)
    dd, pp, cc = model.transform(d, p, c)
    flagged = cmb.combine(dd, pp, cc, model.demand_features, model.plant_features, flag="complete")
    return cmb.counts_in_passing(flagged, "complete")


def q_group_key(spark, sf):
    cust = fx.table(spark, sf, "customer").select("c_name")
    return cust.select(F.col("c_name").alias("demand_text"), group_key("c_name").alias("group_key"))


def q_group_split(spark, sf):
    return split.split_groups(combined(spark, sf, reuse=True), TEST_FRACTION, SEED)


def q_split_counts(spark, sf):
    return split.split_counts(demand_split(combined(spark, sf, reuse=True)))


def q_logo_folds(spark, sf):
    return split.logo_folds(combined(spark, sf, reuse=True), None)


def q_logo_first_folds(spark, sf):
    """L2: the first 100 LOGO folds (the reference's tuning fold count)."""
    return split.logo_folds(combined(spark, sf, reuse=True), 100)


def q_logo_folds_text(spark, sf):
    """G2 over text ids: customers in debt have an id without digits."""
    spelled = F.translate("c_name", "0123456789", "abcdefghij")
    ids = fx.table(spark, sf, "customer").select(
        F.when(F.col("c_acctbal") < 0, spelled).otherwise(F.col("c_name")).alias(cmb.DEMAND))
    return split.logo_folds(ids, None)


def q_orphan_counts(spark, sf):
    """Cost rows without a demand in credit, and without a plant."""
    d, p, c = inputs(spark, sf)
    return cmb.orphan_counts(d.filter("DF1 >= 0"), p.filter("PF1 >= 0"), c)


def accounting_text(spark: SparkSession, sf: str) -> DataFrame:
    """Customers as text cells; a debt is written the way accountants do, ``(1234 cents)``."""
    cust = fx.table(spark, sf, "customer")
    cents = F.round(F.col("c_acctbal") * 100).cast("bigint")
    money = F.when(cents < 0, F.concat(F.lit("("), (-cents).cast("string"), F.lit(" cents)"))).otherwise(cents.cast("string"))
    return cust.select(F.col("c_custkey").cast("string").alias("demand_id"), "c_mktsegment", money.alias("DF1"), F.col("c_nationkey").cast("string").alias("DF4"))


ACCOUNTING = T.StructType([T.StructField("demand_id", T.LongType()), T.StructField("c_mktsegment", T.StringType()),
                           T.StructField("DF1", T.DoubleType()), T.StructField("DF4", T.DoubleType())])


def q_ingest_rejects(spark, sf):
    """The cells that are not numbers, by row and column."""
    return ingest.split_rejects(ingest.coerce(accounting_text(spark, sf), ACCOUNTING), "demand_id")[1]


def q_ingest_clean(spark, sf):
    """All rows by type, a bad cell missing."""
    return ingest.split_rejects(ingest.coerce(accounting_text(spark, sf), ACCOUNTING))[0]


def q_first_row_in_file(spark, sf):
    """Repeated keys of the line table, the first row in file order wins."""
    lines = ingest.scan_with_order(spark, f"{sf}/lineitem.parquet")
    lines = lines.withColumn("line", F.concat_ws("-", "l_orderkey", "l_linenumber"))
    return cmb.first_per_key(lines, "line", ["l_partkey", "l_suppkey", "l_extendedprice"], ingest.ORD)


def q_fit_on_train(spark, sf):
    """E2 fit_on='train': scaler of the training demands and the cut-off from their costs."""
    d, p, c = staged_inputs(spark, sf)
    cut = cv.materialize(split.split_cut(d.select("demand_id").distinct(), "demand_id", TEST_FRACTION, SEED))
    seen, costs = (split.flag_test(x, cut, "demand_id", SEED).filter("not is_test").drop("is_test") for x in (d, c))
    model = prep.Preprocessor(PERCENTILE, "mean").fit(seen, p, costs)
    scaler = spark.createDataFrame(model.demand_scaler.to_rows("demand"), "side string, feature string, mean double, std double")
    return rounded(scaler.select("feature", "mean", "std", F.lit(model.threshold).alias("threshold")))


def q_fill_from_fit(spark, sf):
    """P8 fill_from='fit': customers in debt, filled with the values stored when all were fitted."""
    d, p, c = staged_inputs(spark, sf)
    model = prep.Preprocessor(PERCENTILE, "mean", fill_from="fit").fit(d, p, c)
    return rounded(model.transform_demand(d.filter("DF1 < 0")).select("demand_id", *model.demand_features))


def _saved(spark) -> str:
    """A new folder in the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/saved-{uuid.uuid4()}"


def q_preprocessor_round_trip(spark, sf):
    """A preprocessor saved, loaded and applied."""
    model, _, p, _ = fitted(spark, sf)
    path = _saved(spark)
    model.save(path)
    loaded = prep.PreprocessModel.load(spark, path)
    return rounded(loaded.transform_plants(p).select("plant_id", "region", *loaded.plant_features))


def q_scenario_round_trip(spark, sf):
    """The scenario table written as CSV and read back by its schema."""
    table, path = scenario(spark, sf), _saved(spark)
    sinks.write_table(table, path, "csv")
    return rounded(spark.read.schema(table.schema).option("header", True).csv(path))


def q_model_round_trip(spark, sf):
    """A linear model saved, loaded and applied to every cost row."""
    model, d, p, c = fitted(spark, sf)
    path = _saved(spark)
    serve_model(model).save(spark, path)
    dd, pp = model.transform_demand(d), model.transform_plants(p, only_good=False)
    return rounded(serve.score_pairs(FittedModel.load(spark, path), dd, pp, c, model.demand_features, model.plant_features))


def q_mean_lines(spark, sf):
    """The mean reference lines of the cost and regret views."""
    costs = summaries.mean_line(fx.fixture_costs(spark, sf), "cost").select(F.col("mean").alias("mean_cost"))
    regret_mean = summaries.mean_line(scenario(spark, sf), "Selection_Error").select("mean").scalar()
    return rounded(costs.select("mean_cost", regret_mean.alias("mean_regret")))


def q_scenario_table(spark, sf):
    return rounded(scenario(spark, sf))


def q_selection_regret(spark, sf):
    return rounded(regret.selection_regret(predicted(spark, sf)))


def q_error_stats(spark, sf):
    return rounded(regret.error_stats(scenario(spark, sf)))


def q_regret_rmse(spark, sf):
    """Regret RMSE per market segment."""
    seg = fx.fixture_demands(spark, sf).select(F.col("demand_id").alias("Demand_ID"), "segment")
    scen = scenario(spark, sf).join(seg, "Demand_ID")
    return rounded(scen.groupBy("segment").agg(regret.regret_rmse_expr().alias("rmse"),
                                              F.count(F.lit(1)).alias("n_demands")))


def q_selection_quality(spark, sf):
    return rounded(regret.selection_quality(scenario(spark, sf)))


def q_cumulative_rmse(spark, sf):
    scen = scenario(spark, sf).filter(F.col("Selection_Error").isNotNull())
    # One sort numbers the folds (ascending demand) and gives their running RMSE.
    run = regret.cumulative_rmse(scen.select("Demand_ID", "Selection_Error"), fold="Demand_ID", number="Fold")
    return rounded(run.drop("Demand_ID"))


def q_leaderboard_rank(spark, sf):
    return rounded(regret.leaderboard(regret.fold_summary(fx.fixture_folds(spark, sf))))


def q_leaderboard_top10(spark, sf):
    return rounded(regret.leaderboard_top(regret.fold_summary(fx.fixture_folds(spark, sf)), 10))


def q_best_combo(spark, sf):
    return rounded(regret.best_combo(regret.fold_summary(fx.fixture_folds(spark, sf))))


def _two_predictors(spark, sf):
    # The pairs feed both predictors, and each scenario table (one row per demand) feeds two error
    # tables and the split: written once, so that no error table joins the lines again.
    costs = cv.materialize(fx.fixture_costs(spark, sf).filter(F.col("cost").isNotNull()))
    base = fx.with_loo_plant_mean(costs).select(
        F.col("demand_id").alias(cmb.DEMAND), F.col("plant_id").alias(cmb.PLANT),
        F.col("cost").alias(cmb.COST), F.col("pred").alias("prediction"))
    sb = cv.materialize(regret.scenario_table(base))
    so = cv.materialize(regret.scenario_table(segment_predicted(costs, fx.fixture_demands(spark, sf))))
    flags = split.split_groups(sb, TEST_FRACTION, SEED)
    test_ids = flags.filter("is_test").select("Demand_ID")
    return {("baseline", "test"): sb.join(test_ids, "Demand_ID", "left_semi"),
            ("baseline", "all"): sb,
            ("optimized", "test"): so.join(test_ids, "Demand_ID", "left_semi"),
            ("optimized", "all"): so}


def q_improvement_pct(spark, sf):
    errs = _two_predictors(spark, sf)
    rows = None
    for ev in ("test", "all"):
        b = errs[("baseline", ev)].agg(regret.regret_rmse_expr().alias("b"))
        o = errs[("optimized", ev)].agg(regret.regret_rmse_expr().alias("o"))
        r = b.select(F.lit(ev).alias("evaluation"), F.col("b").alias("baseline_rmse"),
                     o.select("o").scalar().alias("optimized_rmse"))
        r = r.withColumn("improvement_pct", regret.improvement_pct(F.col("baseline_rmse"), F.col("optimized_rmse")))
        rows = r if rows is None else rows.unionByName(r)
    return rounded(rows)


def q_model_comparison(spark, sf):
    return rounded(summaries.model_comparison(_two_predictors(spark, sf)))


def q_plant_performance(spark, sf):
    return rounded(summaries.plant_performance(fx.fixture_costs(spark, sf)))


def q_cheapest_plants(spark, sf):
    return rounded(summaries.cheapest_plants(fx.fixture_costs(spark, sf), 10))


def q_boxplot_stats(spark, sf):
    return rounded(summaries.boxplot_stats(fx.fixture_costs(spark, sf), 10))


def q_cost_histogram(spark, sf):
    return rounded(summaries.histogram(fx.fixture_costs(spark, sf), "cost", 50))


def q_regret_histogram(spark, sf):
    return rounded(summaries.histogram(scenario(spark, sf), "Selection_Error", 30))


def q_residual_histogram(spark, sf):
    res = summaries.residuals(predicted(spark, sf).filter(F.col("prediction").isNotNull()))
    return rounded(summaries.histogram(res, "residual", 50))


def q_prediction_pairs_bounds(spark, sf):
    return rounded(summaries.prediction_bounds(predicted(spark, sf).filter(F.col("prediction").isNotNull())))


def _pairs(spark, sf):
    return predicted(spark, sf).filter(F.col("prediction").isNotNull())


def q_prediction_density(spark, sf):
    """Actual against predicted as counts on a 50 x 50 grid."""
    return rounded(display.density_grid(_pairs(spark, sf), 50))


def q_prediction_sample(spark, sf):
    """The 200 pairs of smallest hash."""
    return rounded(display.hash_sample(_pairs(spark, sf), [cmb.DEMAND, cmb.PLANT], 200))


def _returned(spark, sf):
    return fx.table(spark, sf, "lineitem").select("l_partkey", "l_suppkey", (F.col("l_returnflag") == "R").alias("side"))


def q_set_overlap(spark, sf):
    """Parts with and without returned lines, exactly."""
    return distinct_sets.overlap_exact(_returned(spark, sf), "l_partkey", F.col("side"))


def q_set_overlap_sketch(spark, sf):
    """The same from theta sketches (exact up to 4,096 parts)."""
    return distinct_sets.overlap_estimate(_returned(spark, sf), "l_partkey", F.col("side"))


def q_demands_per_plant_sketch(spark, sf):
    """A4: distinct demands of every plant and of all, from one merged sketch per plant."""
    return distinct_sets.group_estimate(fx.fixture_costs(spark, sf), "plant_id", "demand_id")


def q_position_lookup(spark, sf):
    d = fx.fixture_demands(spark, sf).select("demand_id", F.when(F.col("DF3") > 0, F.col("DF1") / 100).alias("raw_prediction"))
    return rounded(serve.position_lookup(d, fx.fixture_plants(spark, sf), "raw_prediction"))


def serve_model(model) -> FittedModel:
    feats = model.all_features
    return FittedModel("lasso", {}, feats, intercept=SERVE_INTERCEPT, coef=[SERVE_WEIGHTS[f] for f in feats])


def q_serve_best_plant(spark, sf):
    model, d, p, _ = fitted(spark, sf)
    out = serve.best_plant(serve_model(model), model, d, p, candidates="all", plant_info=["region"])
    return rounded(out)


# A small fixed ensemble over raw features (fixed values): per tree its nodes in
# order (id, value, left, right, feature, threshold), and its weight.
SERVE_TREES = [
    ([(0, 0, 1, 2, "DF1", 3000), (1, 0, 3, 4, "PF1", 4000), (2, 0, 5, 6, "PF3", 25.5),
      (3, 10, -1, -1, "", 0), (4, 14, -1, -1, "", 0), (5, 9, -1, -1, "", 0), (6, 13, -1, -1, "", 0)], 1.0),
    ([(0, 0, 1, 2, "PF1", 1000), (1, 0, 3, 4, "DF3", 9), (2, 0, 5, 6, "PF1", 7000),
      (3, 3, -1, -1, "", 0), (4, 7, -1, -1, "", 0), (5, 5, -1, -1, "", 0), (6, 2, -1, -1, "", 0)], 0.5),
    ([(0, 0, 1, 2, "DF2", 150000), (1, 0, 3, 4, "PF4", 0.05), (2, 0, 5, 6, "PF3", 25.4),
      (3, 1, -1, -1, "", 0), (4, 4, -1, -1, "", 0), (5, 6, -1, -1, "", 0), (6, 2.5, -1, -1, "", 0)], 0.25),
    ([(0, 0, 1, 2, "PF3", 25.6), (1, 0.5, -1, -1, "", 0), (2, 1.25, -1, -1, "", 0)], 0.1),
]


def serve_ensemble():
    features = ["DF1", "DF2", "DF3", "PF1", "PF3", "PF4"]
    nodes = [(t, i, float(v), left, right, features.index(f) if f else -1, float(cut))
             for t, (tree, _) in enumerate(SERVE_TREES) for i, v, left, right, f, cut in tree]
    return ensemble_of(nodes, features, {t: w for t, (_, w) in enumerate(SERVE_TREES)})


def q_serve_best_plant_trees(spark, sf):
    """I2/L6 through a fixed tree ensemble: cells and boxes instead of all pairs."""
    d, p, _ = inputs(spark, sf)
    return rounded(best_plant_trees(serve_ensemble(), d, p, plant_info=["region"]).picks)


def q_serve_pair_cost(spark, sf):
    model, d, p, c = fitted(spark, sf)
    dd, pp = model.transform_demand(d), model.transform_plants(p, only_good=False)
    return rounded(serve.score_pairs(serve_model(model), dd, pp, c, model.demand_features, model.plant_features))


def q_group_gram(spark, sf):
    comb = split.with_group(combined(spark, sf, reuse=True))
    feats = [c for c in comb.columns if c[:2] in ("DF", "PF")]
    stats = gram.gram_stats(comb, feats, cmb.COST, group="Group")
    return stats.select("Group", *[round_sig(c) for c in stats.columns if c != "Group"])


# ----------------------------------------------- model queries (rows check)

def q_serve_best_plant_forest(spark, sf):
    """I2 through a fitted forest."""
    model, d, p, c = fitted(spark, sf)
    comb = cv.materialize(cmb.combine(*model.transform(d, p, c), model.demand_features, model.plant_features))
    m = fit_model("random_forest", {"n_estimators": 5, "max_depth": 4}, SEED, comb, model.all_features)
    return rounded(serve.best_plant(m, model, d, p, candidates="all", plant_info=["region"]))


def _features(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c[:2] in ("DF", "PF")]


def _train_test(spark, sf):
    # The flag compares each row with a literal cut, so the split is a cheap
    # projection of the checkpointed combined table and is not written again.
    comb = demand_split(combined(spark, sf, reuse=True))
    return comb.filter(~F.col("is_test")).drop("is_test"), comb.filter(F.col("is_test")).drop("is_test")


def q_lasso_fit(spark, sf):
    train, _ = _train_test(spark, sf)
    m = fit_model("lasso", {"alpha": 1.0}, SEED, train, _features(train))
    rows = [("intercept", m.intercept)] + list(zip(m.features, m.coef))
    return spark.createDataFrame(rows, "term string, weight double")


def _tree_fit(model_type, params):
    def q(spark, sf):
        train, _ = _train_test(spark, sf)
        m = fit_model(model_type, params, SEED, train, _features(train))
        return summaries.feature_importance(m.feature_importances(), m.features, spark, 20)
    return q


def q_test_evaluation(spark, sf):
    train, test = _train_test(spark, sf)
    m = fit_model("lasso", {"alpha": 1.0}, SEED, train, _features(train))
    return cv.evaluate(m, test).scenario


def q_lasso_logo_cv(spark, sf):
    comb = combined(spark, sf)
    return cv.logo_cv("lasso", {"alpha": 1.0}, comb, _features(comb), SEED, n_folds=None)


def _folds_prepared(spark, sf):
    # The costs are read once, on the way to the table of pairs that the folds keep.
    d, p, c = inputs(spark, sf)
    d, p = cv.materialize(d), cv.materialize(p)
    return d, p, fold_prepare.fit_folds(d, p, c, prep.Preprocessor(PERCENTILE))


def q_fold_parameters(spark, sf):
    """P5, A1-A2 without each demand in turn: scaler and cut-off of every fold."""
    return rounded(_folds_prepared(spark, sf)[2].parameters())


def q_fold_training_rows(spark, sf):
    """A3, P10-P12 without each demand in turn: training and held-out rows of every fold."""
    d, p, fitted_folds = _folds_prepared(spark, sf)
    return rounded(fold_prepare.fold_counts(fold_prepare.fold_systems(fitted_folds, d, p)))


def q_lasso_logo_refit(spark, sf):
    """G3 without leakage: every fold's preprocessing and Lasso leave its demand out."""
    d, p, fitted_folds = _folds_prepared(spark, sf)
    return rounded(fold_prepare.lasso_logo_refit(fold_prepare.fold_systems(fitted_folds, d, p), 1.0))


def q_lasso_grid_search(spark, sf):
    comb = combined(spark, sf)
    return cv.grid_search("lasso", {"alpha": [0.001, 0.01, 0.1, 1.0, 10.0]}, comb, _features(comb), SEED,
                          n_folds=None).leaderboard


def q_forest_kfold_cv(spark, sf):
    comb = combined(spark, sf)
    return cv.logo_cv("random_forest", {"n_estimators": 10, "max_depth": 5, "min_samples_split": 2}, comb,
                      _features(comb), SEED, fold_mode="kfold", k=3, parallelism=3)


def q_forest_grid_ledger(spark, sf):
    """A forest grid over three group folds, every fit a cell of a ledger."""
    comb = combined(spark, sf, reuse=True)
    return cv.grid_search("random_forest", {"n_estimators": [5, 10], "max_depth": [3, 6]}, comb, _features(comb), SEED,
                          fold_mode="kfold", k=3, parallelism=3).leaderboard


def q_tuner_regret(spark, sf):
    """MLlib's tuner with the regret evaluator over whole-demand folds."""
    comb = combined(spark, sf, reuse=True)
    return rounded(cv.cross_validate("lasso", {"alpha": [0.01, 1.0, 100.0]}, comb, _features(comb), SEED, k=3))


def q_full_run(spark, sf):
    d, p, c = staged_inputs(spark, sf)
    run = run_selection(spark, d, p, c, SelectionOptions(model_type="lasso", cv_n_folds=None,
                                                         hyperparam_cv_folds=None))
    return run.final.test.scenario


QUERIES = {
    "ingest_report": q_ingest_report,
    "impute_mean": _impute("mean"),
    "impute_median": _impute("median"),
    "impute_zero": _impute("zero"),
    "standardize_demands": q_standardize_demands,
    "standardize_plants": q_standardize_plants,
    "preprocess_summary": q_preprocess_summary,
    "plant_cost_stats": q_plant_cost_stats,
    "plant_cost_stats_sorted": q_plant_cost_stats_sorted,
    "plant_threshold": q_plant_threshold,
    "plant_good_flag": q_plant_good_flag,
    "filter_plants": q_filter_plants,
    "filter_costs": q_filter_costs,
    "combined_dataset": q_combined_dataset,
    "combined_counts": q_combined_counts,
    "group_key": q_group_key,
    "group_split": q_group_split,
    "split_counts": q_split_counts,
    "logo_folds": q_logo_folds,
    "logo_first_folds": q_logo_first_folds,
    "logo_folds_text": q_logo_folds_text,
    "orphan_counts": q_orphan_counts,
    "scenario_table": q_scenario_table,
    "selection_regret": q_selection_regret,
    "error_stats": q_error_stats,
    "regret_rmse": q_regret_rmse,
    "selection_quality": q_selection_quality,
    "ingest_rejects": q_ingest_rejects,
    "ingest_clean": q_ingest_clean,
    "first_row_in_file": q_first_row_in_file,
    "fit_on_train": q_fit_on_train,
    "fill_from_fit": q_fill_from_fit,
    "preprocessor_round_trip": q_preprocessor_round_trip,
    "scenario_round_trip": q_scenario_round_trip,
    "model_round_trip": q_model_round_trip,
    "mean_lines": q_mean_lines,
    "cumulative_rmse": q_cumulative_rmse,
    "leaderboard_rank": q_leaderboard_rank,
    "leaderboard_top10": q_leaderboard_top10,
    "best_combo": q_best_combo,
    "improvement_pct": q_improvement_pct,
    "model_comparison": q_model_comparison,
    "plant_performance": q_plant_performance,
    "cheapest_plants": q_cheapest_plants,
    "boxplot_stats": q_boxplot_stats,
    "cost_histogram": q_cost_histogram,
    "regret_histogram": q_regret_histogram,
    "residual_histogram": q_residual_histogram,
    "prediction_pairs_bounds": q_prediction_pairs_bounds,
    "prediction_density": q_prediction_density,
    "prediction_sample": q_prediction_sample,
    "set_overlap": q_set_overlap,
    "set_overlap_sketch": q_set_overlap_sketch,
    "demands_per_plant_sketch": q_demands_per_plant_sketch,
    "position_lookup": q_position_lookup,
    "serve_best_plant": q_serve_best_plant,
    "serve_best_plant_trees": q_serve_best_plant_trees,
    "serve_pair_cost": q_serve_pair_cost,
    "serve_best_plant_forest": q_serve_best_plant_forest,
    "group_gram": q_group_gram,
    "lasso_fit": q_lasso_fit,
    "forest_fit": _tree_fit("random_forest", {"n_estimators": 20, "max_depth": 5, "min_samples_split": 2}),
    "gbt_fit": _tree_fit("gradient_boosting", {"n_estimators": 10, "max_depth": 3, "learning_rate": 0.1,
                                               "min_samples_split": 2}),
    "test_evaluation": q_test_evaluation,
    "lasso_logo_cv": q_lasso_logo_cv,
    "fold_parameters": q_fold_parameters,
    "fold_training_rows": q_fold_training_rows,
    "lasso_logo_refit": q_lasso_logo_refit,
    "lasso_grid_search": q_lasso_grid_search,
    "forest_kfold_cv": q_forest_kfold_cv,
    "forest_grid_ledger": q_forest_grid_ledger,
    "tuner_regret": q_tuner_regret,
    "full_run": q_full_run,
}
