"""Scans of the three selection inputs (demand, candidates, costs).

CSV is read with a declared schema, a header, and only the empty field as
missing: the text ``NA`` (a region) stays a value. Parquet keeps its own
schema. In both cases floating NaN is turned into null at ingest so that every
later aggregate skips it, as pandas does.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..functions.columns import nan_to_null
from .ingest import Ingested, ingest_table

# Column names of the reference's CSV inputs (fixed values).
DEMAND_ID = "Demand ID"
PLANT_ID = "Plant ID"
PLANT_TYPE = "Plant Type"
REGION = "Region"
COST_USD = "Cost_USD_per_MWh"


def demand_schema(n_features: int = 12) -> T.StructType:
    return T.StructType([T.StructField(DEMAND_ID, T.StringType())] +
                        [T.StructField(f"DF{i}", T.DoubleType()) for i in range(1, n_features + 1)])


def plants_schema(n_features: int = 18) -> T.StructType:
    return T.StructType([T.StructField(PLANT_ID, T.StringType()),
                         T.StructField(PLANT_TYPE, T.StringType()),
                         T.StructField(REGION, T.StringType())] +
                        [T.StructField(f"PF{i}", T.DoubleType()) for i in range(1, n_features + 1)])


def costs_schema() -> T.StructType:
    return T.StructType([T.StructField(DEMAND_ID, T.StringType()),
                         T.StructField(PLANT_ID, T.StringType()),
                         T.StructField(COST_USD, T.DoubleType())])


def read_csv(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Header CSV where only ``""`` is missing. Without a schema the types are
    inferred (costs one extra pass over the file)."""
    reader = (spark.read.option("header", True).option("nullValue", "")
              .option("nanValue", "NaN").option("mode", "FAILFAST"))
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
    return nan_to_null(reader.csv(path))


def read_table(spark: SparkSession, path: str, fmt: str = "parquet",
               schema: T.StructType | None = None) -> DataFrame:
    if fmt == "csv":
        return read_csv(spark, path, schema)
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return nan_to_null(reader.format(fmt).load(path))


def read_selection_inputs(spark: SparkSession, demand_path: str, plants_path: str, costs_path: str,
                          fmt: str = "csv", n_demand_features: int | None = None,
                          n_plant_features: int | None = None, on_bad: str = "fail"
                          ) -> tuple[DataFrame, DataFrame, DataFrame] | tuple[Ingested, Ingested, Ingested]:
    """The three inputs. For CSV, pass the feature counts to get a declared
    schema (recommended at scale); ``None`` infers the schema. With
    ``on_bad='reject'`` (needs the feature counts) cells that cannot be read become missing and
    every input comes as ``Ingested``: clean rows in input order and rejects."""
    if on_bad not in ("fail", "reject"):
        raise ValueError("on_bad must be 'fail' or 'reject'")
    if on_bad == "reject":
        if not n_demand_features or not n_plant_features:
            raise ValueError("on_bad='reject' needs the feature counts")
        schemas = demand_schema(n_demand_features), plants_schema(n_plant_features), costs_schema()
        return tuple(ingest_table(spark, path, s, fmt) for path, s in zip((demand_path, plants_path, costs_path), schemas))
    ds = demand_schema(n_demand_features) if fmt == "csv" and n_demand_features else None
    ps = plants_schema(n_plant_features) if fmt == "csv" and n_plant_features else None
    cs = costs_schema() if fmt == "csv" else None
    return (read_table(spark, demand_path, fmt, ds),
            read_table(spark, plants_path, fmt, ps),
            read_table(spark, costs_path, fmt, cs))
