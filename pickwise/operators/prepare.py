"""Feature preparation and candidate filtering.

``Preprocessor.fit`` returns a ``PreprocessModel``: the scaler parameters
(two numbers per feature, the only values brought to the driver), the cost
cut-off (one number), and the plant table with its good/worst flag, which
stays a DataFrame however many plants there are.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import discover_features
from ..functions.quantiles import DEFAULT_METHOD, grouped_quantiles, quantile_expr
from ..functions.reuse import beside, reusable
from ..session import ensure_checkpoint_dir

STRATEGIES = ("mean", "median", "zero")


# ---------------------------------------------------------------- imputation

def fill_stats(df: DataFrame, features: list[str], strategy: str,
               quantile_method: str = DEFAULT_METHOD) -> DataFrame:
    """One-row table with the fill value of every feature: column mean or
    median over the non-missing values (``zero``/others: 0)."""
    if strategy == "mean":
        return df.agg(*[F.avg(F.col(c).cast("double")).alias(c) for c in features])
    if strategy == "median":
        if quantile_method not in ("exact", "approx"):
            long = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("f"), F.col(c).cast("double").alias("v"))
                                                 for c in features])).alias("fv")).select("fv.f", "fv.v")
            med = grouped_quantiles(long, ["f"], "v", {"m": 0.5}, quantile_method)
            return med.groupBy().agg(*[F.max(F.when(F.col("f") == c, F.col("m"))).alias(c) for c in features])
        return df.agg(*[quantile_expr(F.col(c).cast("double"), 0.5, quantile_method).alias(c) for c in features])
    return df.sparkSession.range(1).select(*[F.lit(0.0).alias(c) for c in features])


def fill_values(df: DataFrame, features: list[str], strategy: str,
                quantile_method: str = DEFAULT_METHOD) -> dict[str, float | None]:
    """The fill value of every feature as numbers (one aggregate job, one row
    of ``len(features)`` numbers to the driver)."""
    if strategy not in ("mean", "median") or not features:
        return {c: 0.0 for c in features}
    row = fill_stats(df, features, strategy, quantile_method).first()
    return {c: row[c] for c in features}


def impute(df: DataFrame, features: list[str], strategy: str = "mean",
           quantile_method: str = DEFAULT_METHOD, eager: bool = True, known: dict[str, float | None] | None = None) -> DataFrame:
    """Fill missing feature values. The fill values are computed on
    ``df`` itself, unless ``known`` has those of a fit. ``eager`` (default) computes them
    now - like MLlib's Imputer - so later plans carry literals; ``eager=False``
    keeps them as lazy scalar subqueries (merged by Catalyst into one
    aggregate, but re-run by every job that reads the result)."""
    if known is not None:
        fills = {c: F.lit(known[c]).cast("double") for c in features}
    elif strategy in ("mean", "median") and not eager:
        stats = fill_stats(df, features, strategy, quantile_method)
        fills = {c: stats.select(c).scalar() for c in features}
    else:
        fills = {c: F.lit(v).cast("double") for c, v in fill_values(df, features, strategy, quantile_method).items()}
    return df.withColumns({c: F.coalesce(F.col(c).cast("double"), fills[c]) for c in features})


# ------------------------------------------------------------------- scaling

@dataclass
class ScalerParams:
    """Mean and population std per feature (scikit-learn StandardScaler)."""
    features: list[str]
    means: list[float]
    stds: list[float]

    def scale_expr(self, c: str) -> Column:
        i = self.features.index(c)
        s = self.stds[i]
        s = 1.0 if (s is None or s == 0.0) else s  # zero spread: divide by one
        return (F.col(c).cast("double") - F.lit(self.means[i])) / F.lit(s)

    def apply(self, df: DataFrame) -> DataFrame:
        """``(x - mean) / std``; missing stays missing."""
        return df.withColumns({c: self.scale_expr(c) for c in self.features})

    def to_rows(self, side: str) -> list[tuple]:
        return [(side, f, m, s) for f, m, s in zip(self.features, self.means, self.stds)]


def scaler_stats(df: DataFrame, features: list[str]) -> DataFrame:
    """One aggregate: mean and population std per feature, nulls skipped.
    (MLlib's StandardScaler uses the sample std, so it is not used.)"""
    aggs = []
    for c in features:
        aggs += [F.avg(F.col(c).cast("double")).alias(f"{c}__mean"),
                 F.stddev_pop(F.col(c).cast("double")).alias(f"{c}__std")]
    return df.agg(*aggs)


def fit_scaler(df: DataFrame, features: list[str]) -> ScalerParams:
    """Collects one row of 2 x features numbers."""
    if not features:
        return ScalerParams([], [], [])
    row = scaler_stats(df, features).first()
    return ScalerParams(list(features), [row[f"{c}__mean"] for c in features],
                        [row[f"{c}__std"] for c in features])


def fit_scaler_mean_filled(df: DataFrame, features: list[str]) -> ScalerParams:
    """P5 for the ``mean`` strategy in one pass: filling with the mean keeps
    the mean, and the population variance of the filled column is the
    variance of the present values times present/all rows."""
    if not features:
        return ScalerParams([], [], [])
    aggs = [F.count(F.lit(1)).alias("__n")]
    for c in features:
        x = F.col(c).cast("double")
        aggs += [F.avg(x).alias(f"{c}__mean"), F.var_pop(x).alias(f"{c}__var"), F.count(x).alias(f"{c}__cnt")]
    row = df.agg(*aggs).first()
    stds = []
    for c in features:
        var, cnt = row[f"{c}__var"], row[f"{c}__cnt"]
        stds.append(None if var is None else (var * cnt / row["__n"]) ** 0.5)
    return ScalerParams(list(features), [row[f"{c}__mean"] for c in features], stds)


def standardize_lazy(df: DataFrame, features: list[str], fit_df: DataFrame | None = None) -> DataFrame:
    """Standardise with statistics of ``fit_df`` (default ``df``) as scalar
    subqueries, without bringing anything to the driver."""
    stats = scaler_stats(fit_df if fit_df is not None else df, features)
    out = {}
    for c in features:
        m = stats.select(f"{c}__mean").scalar()
        s = stats.select(F.when(F.col(f"{c}__std") == 0, F.lit(1.0)).otherwise(F.col(f"{c}__std"))).scalar()
        out[c] = (F.col(c).cast("double") - m) / s
    return df.withColumns(out)


# ------------------------------------------------------ candidate statistics

def plant_cost_stats(costs: DataFrame, plant_key: str = "plant_id", cost: str = "cost",
                     quantile_method: str = DEFAULT_METHOD) -> DataFrame:
    """A1: per plant, over all (unfiltered) cost rows: median, mean and count
    of the non-missing costs. Plants whose costs are all missing get null
    median/mean and count 0. Rows without a plant key are ignored."""
    keyed = costs.filter(F.col(plant_key).isNotNull()).select(plant_key, cost)
    if quantile_method not in ("exact", "approx"):
        keyed = reusable(keyed)     # read by the plain aggregates and by the selection
        basic = keyed.groupBy(plant_key).agg(F.avg(cost).alias("mean_cost"), F.count(cost).alias("n_costs"))
        med = grouped_quantiles(keyed, [plant_key], cost, {"median_cost": 0.5}, quantile_method)
        return basic.join(med, plant_key, "left").select(plant_key, "median_cost", "mean_cost", "n_costs")
    return keyed.groupBy(plant_key).agg(
        quantile_expr(cost, 0.5, quantile_method).alias("median_cost"),
        F.avg(cost).alias("mean_cost"),
        F.count(cost).alias("n_costs"))


def cost_threshold(stats: DataFrame, percentile: float = 75.0, quantile_method: str = DEFAULT_METHOD) -> DataFrame:
    """A2: one row, ``threshold`` = the percentile/100 quantile (linear) of the
    plant medians."""
    q = float(percentile) / 100.0
    if quantile_method not in ("exact", "approx"):
        return grouped_quantiles(stats, [], "median_cost", {"threshold": q}, quantile_method)
    return stats.agg(quantile_expr("median_cost", q, quantile_method).alias("threshold"))


def plant_flags(stats: DataFrame, threshold: Column | float) -> DataFrame:
    """A3: ``is_good`` = median <= cut-off; null for plants without costs
    (they are neither good nor worst)."""
    t = threshold if isinstance(threshold, Column) else F.lit(float(threshold))
    return stats.withColumn("is_good", F.col("median_cost") <= t)


# ------------------------------------------------------------------ filters

def filter_plants(plants: DataFrame, flags: DataFrame, plant_key: str = "plant_id") -> DataFrame:
    """Keep good plants (left-semi join)."""
    good = flags.filter(F.col("is_good")).select(plant_key)
    return plants.join(good, plant_key, "left_semi")


def filter_costs(costs: DataFrame, demand: DataFrame, flags: DataFrame, demand_key: str = "demand_id",
                 plant_key: str = "plant_id", cost: str = "cost") -> DataFrame:
    """Cost rows of known demands and good plants, with a cost."""
    good = flags.filter(F.col("is_good")).select(plant_key)
    return (costs.filter(F.col(cost).isNotNull())
            .join(demand.select(demand_key), demand_key, "left_semi")
            .join(beside(good), plant_key, "left_semi"))


# --------------------------------------------------------------- the fitter

@dataclass
class Preprocessor:
    plant_filter_percentile: float = 75.0
    missing_value_strategy: str = "mean"
    demand_key: str = "demand_id"
    plant_key: str = "plant_id"
    cost: str = "cost"
    demand_prefix: str = "DF"
    plant_prefix: str = "PF"
    quantile_method: str = DEFAULT_METHOD
    #: 'transform': fill values come from the data being transformed; 'fit': from the fit.
    fill_from: str = "transform"

    def __post_init__(self):
        if self.fill_from not in ("transform", "fit"):
            raise ValueError("fill_from must be 'transform' or 'fit'")

    def fit(self, demand: DataFrame, plants: DataFrame, costs: DataFrame) -> "PreprocessModel":
        dfeat = discover_features(demand, self.demand_prefix)
        pfeat = discover_features(plants, self.plant_prefix)
        # Scaler fit data: mean-filled for 'mean', median-filled otherwise
        # (also for 'zero', whose transform then fills 0).
        fit_fill = "mean" if self.missing_value_strategy == "mean" else "median"
        if fit_fill == "mean":
            dscaler = fit_scaler_mean_filled(demand, dfeat)
        else:
            dscaler = fit_scaler(impute(demand, dfeat, fit_fill, self.quantile_method), dfeat)
        pscaler = fit_scaler(plants, pfeat)
        fills = fill_values(demand, dfeat, self.missing_value_strategy, self.quantile_method) if self.fill_from == "fit" else None
        return PreprocessModel(self, dfeat, pfeat, dscaler, pscaler, costs=costs, fills=fills)

    def plant_cut(self, costs: DataFrame) -> tuple[float | None, DataFrame]:
        """A1-A3: the cut-off and the flagged plants. The per-plant statistics (one
        row per plant) are written once to the checkpoint folder: the cut-off and
        every later transform read them."""
        ensure_checkpoint_dir(costs.sparkSession)
        stats = plant_cost_stats(costs, self.plant_key, self.cost, self.quantile_method).checkpoint(eager=True)
        row = cost_threshold(stats, self.plant_filter_percentile, self.quantile_method).first()
        threshold = row["threshold"] if row is not None else None
        return threshold, plant_flags(stats, F.lit(threshold).cast("double"))


@dataclass
class PreprocessModel:
    settings: Preprocessor
    demand_features: list[str]
    plant_features: list[str]
    demand_scaler: ScalerParams
    plant_scaler: ScalerParams
    cut: tuple[float | None, DataFrame] | None = None
    costs: DataFrame | None = None
    fills: dict[str, float | None] | None = None
    extra: dict = field(default_factory=dict)

    def _plant_cut(self) -> tuple[float | None, DataFrame]:
        # Serving and scaling never ask for it, so it is computed on first use.
        if self.cut is None:
            self.cut = self.settings.plant_cut(self.costs)
        return self.cut

    @property
    def threshold(self) -> float | None:
        return self._plant_cut()[0]

    @property
    def flags(self) -> DataFrame:
        return self._plant_cut()[1]

    @property
    def all_features(self) -> list[str]:
        return self.demand_features + self.plant_features

    def transform_demand(self, demand: DataFrame) -> DataFrame:
        s = self.settings
        filled = impute(demand, self.demand_features, s.missing_value_strategy, s.quantile_method, known=self.fills)
        return self.demand_scaler.apply(filled)

    def transform_plants(self, plants: DataFrame, only_good: bool = True) -> DataFrame:
        scaled = self.plant_scaler.apply(plants)
        return filter_plants(scaled, self.flags, self.settings.plant_key) if only_good else scaled

    def transform(self, demand: DataFrame, plants: DataFrame, costs: DataFrame):
        s = self.settings
        d = self.transform_demand(demand)
        p = self.transform_plants(plants)
        c = filter_costs(costs, demand, self.flags, s.demand_key, s.plant_key, s.cost)
        return d, p, c

    def summary(self) -> DataFrame:
        """One-row summary of the fit."""
        s = self.settings
        counts = self.flags.agg(
            F.count_if(F.col("is_good").isNotNull()).alias("total_plants_before"),
            F.count_if(F.col("is_good")).alias("good_plants_count"),
            F.count_if(~F.col("is_good")).alias("filtered_plants_count"))
        return counts.select(
            F.lit(len(self.demand_features)).alias("demand_features_count"),
            F.lit(len(self.plant_features)).alias("plant_features_count"),
            "total_plants_before", "good_plants_count", "filtered_plants_count",
            F.lit(self.threshold).cast("double").alias("cost_threshold"),
            F.lit(float(s.plant_filter_percentile)).alias("plant_filter_percentile"),
            F.lit(s.missing_value_strategy).alias("missing_value_strategy"))

    # ---- S8: parameter tables instead of a pickle
    def save(self, path: str) -> None:
        spark = self.flags.sparkSession
        rows = self.demand_scaler.to_rows("demand") + self.plant_scaler.to_rows("plant")
        spark.createDataFrame(rows, "side string, feature string, mean double, std double") \
            .coalesce(1).write.mode("overwrite").parquet(f"{path}/scaler")
        self.flags.write.mode("overwrite").parquet(f"{path}/plant_flags")
        s = self.settings
        meta = {"plant_filter_percentile": s.plant_filter_percentile,
                "missing_value_strategy": s.missing_value_strategy,
                "demand_key": s.demand_key, "plant_key": s.plant_key, "cost": s.cost,
                "demand_prefix": s.demand_prefix, "plant_prefix": s.plant_prefix,
                "quantile_method": s.quantile_method, "fill_from": s.fill_from, "fills": self.fills, "threshold": self.threshold,
                "demand_features": self.demand_features, "plant_features": self.plant_features}
        spark.createDataFrame([(json.dumps(meta),)], "meta string").coalesce(1) \
            .write.mode("overwrite").text(f"{path}/settings")

    @staticmethod
    def load(spark: SparkSession, path: str) -> "PreprocessModel":
        meta = json.loads(spark.read.text(f"{path}/settings").first()[0])
        scal = spark.read.parquet(f"{path}/scaler").collect()  # 2 x features rows

        def params(side, feats):
            by = {r["feature"]: r for r in scal if r["side"] == side}
            return ScalerParams(feats, [by[f]["mean"] for f in feats], [by[f]["std"] for f in feats])

        settings = Preprocessor(meta["plant_filter_percentile"], meta["missing_value_strategy"],
                                meta["demand_key"], meta["plant_key"], meta["cost"],
                                meta["demand_prefix"], meta["plant_prefix"], meta["quantile_method"],
                                meta.get("fill_from", "transform"))
        return PreprocessModel(settings, meta["demand_features"], meta["plant_features"],
                               params("demand", meta["demand_features"]),
                               params("plant", meta["plant_features"]),
                               (meta["threshold"], spark.read.parquet(f"{path}/plant_flags")), fills=meta.get("fills"))
