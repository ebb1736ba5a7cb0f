"""Sinks and the ingest report."""

from __future__ import annotations

import json
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def ingest_report(tables: dict[str, DataFrame]) -> DataFrame:
    """S3: row count per input table (one count aggregate per table)."""
    parts = [df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows")
             for name, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite") -> None:
    """Write a result table (CSV with a header, or any other format)."""
    w = df.write.mode(mode)
    if fmt == "csv":
        w = w.option("header", True)
    w.format(fmt).save(path)


def feature_names_frame(spark: SparkSession, demand_features: list[str], plant_features: list[str]) -> DataFrame:
    """The three feature lists as one row of arrays."""
    return spark.createDataFrame(
        [(demand_features, plant_features, demand_features + plant_features)],
        "demand_features array<string>, plant_features array<string>, all_features array<string>")


def run_metadata_frame(spark: SparkSession, model_type: str, random_seed: int, final_params: dict,
                       test_rmse: float | None, logo_cv_rmse: float | None, n_logo_folds: int,
                       tuning_enabled: bool) -> DataFrame:
    """One row of run metadata; ``n_logo_folds`` is the number of folds
    actually run."""
    return spark.createDataFrame(
        [(datetime.now(timezone.utc).isoformat(), model_type, int(random_seed), json.dumps(final_params),
          test_rmse, logo_cv_rmse, int(n_logo_folds), bool(tuning_enabled))],
        "timestamp string, model_type string, random_seed bigint, final_params string, test_rmse double, "
        "logo_cv_rmse double, n_logo_folds bigint, hyperparameter_optimization_enabled boolean")


def report_header_frame(spark: SparkSession, model_type: str, model_name: str, description: str,
                        baseline_params: dict, final_params: dict, tuning_enabled: bool) -> DataFrame:
    """The report's header (model name/description M5, parameters, date) as one row."""
    return spark.createDataFrame(
        [(model_type, model_name, description, datetime.now(timezone.utc).isoformat(),
          json.dumps(baseline_params), json.dumps(final_params), bool(tuning_enabled))],
        "model_type string, model_name string, description string, generated string, baseline_params string, "
        "final_params string, hyperparameter_optimization_enabled boolean")


def append_json(df: DataFrame, path: str) -> None:
    df.coalesce(1).write.mode("append").json(path)
