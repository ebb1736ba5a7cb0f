"""S1, P15 with rejects: a text-first scan that no bad cell can end.

Every declared column is read as text, then cast on its own (``try_cast``, the
reference's coercion): a cell that is not a number becomes missing and is listed in a
rejects table with its file, place, column and raw text. A CSV line with too few or too many fields keeps the cells it
has and is listed with its raw line. Both outputs come from one written pass.

Rows carry ``ORD``, their place in the input: file, place of the block (CSV) or the
row (Parquet) in it, and place of the row in the block. It comes from hidden
file columns and is written with the rows, so it is the same for every later job and
retry; "first row wins" (``first_per_key``, ``scenario_table``, serving) takes it as its order.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import NUMERIC_TYPES, to_number
from ..functions.reuse import materialize

ORD = "__ord"
_LINE = "__line"
FORMATS = ("csv", "parquet")


@dataclass
class Ingested:
    """clean: declared columns by type, and ORD; rejects: file, ord, column (null: the whole line), raw."""
    clean: DataFrame
    rejects: DataFrame


def file_order(df: DataFrame, fmt: str) -> Column:
    """The place of a scanned row in its input, as a struct that compares in file order."""
    if fmt == "parquet":
        block, row = F.col("_metadata.row_index"), F.lit(0).cast("long")
    else:
        # A block is read by one task from its start to its end.
        block, row = F.col("_metadata.file_block_start"), F.monotonically_increasing_id()
    return F.struct(F.col("_metadata.file_path").alias("file"), block.alias("block"), row.alias("row"))


def scan_with_order(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """A Parquet table with ORD; text formats need ``text_scan``, other formats have no stable order."""
    if fmt != "parquet":
        raise ValueError(f"no input order for format {fmt!r}; read CSV through ingest_table")
    df = spark.read.parquet(path)
    return df.select("*", file_order(df, fmt).alias(ORD))


def text_scan(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    """All columns as text (only the empty field is missing), with ORD and the raw line of a
    malformed CSV row."""
    if fmt not in FORMATS:
        raise ValueError(f"cannot ingest format {fmt!r}")
    if fmt == "parquet":
        df = spark.read.parquet(path)
        return df.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in df.columns], F.lit(None).cast("string").alias(_LINE),
                         file_order(df, fmt).alias(ORD))
    header = spark.read.option("header", True).csv(path).columns      # names in the files' own order
    schema = T.StructType([T.StructField(c, T.StringType()) for c in [*header, _LINE]])
    df = (spark.read.schema(schema).option("header", True).option("nullValue", "").option("mode", "PERMISSIVE")
          .option("columnNameOfCorruptRecord", _LINE).option("columnPruning", False).csv(path))
    return df.select("*", file_order(df, fmt).alias(ORD))


def _is_number(t: T.DataType) -> bool:
    return isinstance(t, NUMERIC_TYPES) and not isinstance(t, T.BooleanType)


def coerce(text: DataFrame, schema: T.StructType, keep: tuple[str, ...] = ()) -> DataFrame:
    """Text columns cast to the schema (a missing column is null), the columns ``keep``,
    and ``__rejects``: an array of (column, raw) of the cells that could not be cast.
    NaN is missing, not rejected."""
    columns, bad = [], []
    for f in schema.fields:
        raw = F.col(f"`{f.name}`") if f.name in text.columns else F.lit(None).cast("string")
        if isinstance(f.dataType, T.StringType):
            columns.append(raw.alias(f.name))
            continue
        number = to_number(raw)
        value = F.when(~F.isnan(number), number) if _is_number(f.dataType) else raw.try_cast(f.dataType)
        cast = number if _is_number(f.dataType) else value
        columns.append(value.cast(f.dataType).alias(f.name) if isinstance(f.dataType, (T.DoubleType, T.FloatType))
                       else value.try_cast(f.dataType).alias(f.name))
        bad.append(F.when(raw.isNotNull() & (F.trim(raw) != "") & cast.isNull(), F.struct(F.lit(f.name).alias("column"), raw.alias("raw"))))
    none = F.array().cast("array<struct<column:string,raw:string>>")
    rejects = F.filter(F.array(*bad), lambda x: x.isNotNull()) if bad else none
    return text.select(*columns, *keep, rejects.alias("__rejects"))


def split_rejects(coerced: DataFrame, *keys: str) -> tuple[DataFrame, DataFrame]:
    """The clean rows of a coerced table, and one row (keys, column, raw) per rejected cell."""
    cells = coerced.filter(F.size("__rejects") > 0).select(*keys, F.explode("__rejects").alias("r")).select(*keys, "r.*")
    return coerced.drop("__rejects"), cells


def ingest_table(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "csv") -> Ingested:
    """Scan, coerce and write a table once; no bad cell or line ends the run."""
    done = materialize(coerce(text_scan(spark, path, fmt), schema, (ORD, _LINE)))
    clean, cells = split_rejects(done, ORD)
    lines = done.filter(F.col(_LINE).isNotNull()).select(ORD, F.lit(None).cast("string").alias("column"), F.col(_LINE).alias("raw"))
    rejects = cells.unionByName(lines).select(F.col(f"{ORD}.file").alias("file"), F.col(ORD).alias("ord"), "column", "raw")
    return Ingested(clean.drop(_LINE), rejects)


def reject_report(rejects: dict[str, DataFrame]) -> DataFrame:
    """Rejected cells per table and column (null: malformed lines)."""
    parts = [r.groupBy("column").agg(F.count(F.lit(1)).alias("n_rejected")).select(F.lit(name).alias("table_name"), "column", "n_rejected")
             for name, r in rejects.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
