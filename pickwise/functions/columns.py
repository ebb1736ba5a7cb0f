"""Column-level helpers shared by the operators (all JVM-side expressions)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

NUMERIC_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType,
                 T.DoubleType, T.DecimalType, T.BooleanType)
FLOAT_TYPES = (T.FloatType, T.DoubleType)


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def discover_features(df: DataFrame, prefix: str) -> list[str]:
    """Columns whose name starts with ``prefix`` and whose type is numeric,
    in schema order. Booleans count as numeric (they are cast to double).
    Reads only the schema; no job runs."""
    return [f.name for f in df.schema.fields
            if f.name.startswith(prefix) and isinstance(f.dataType, NUMERIC_TYPES)]


def nan_to_null(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Turn floating NaN into null so that Spark aggregates skip it the way
    pandas does (Spark's avg/max would otherwise return NaN)."""
    targets = [f.name for f in df.schema.fields
               if isinstance(f.dataType, FLOAT_TYPES) and (columns is None or f.name in columns)]
    if not targets:
        return df
    return df.withColumns({c: F.when(~F.isnan(F.col(c)), F.col(c)) for c in targets})


def to_number(c: str | Column) -> Column:
    """Coerce to double, bad values become null (``to_numeric(errors='coerce')``)."""
    return col(c).try_cast("double")


def group_key(c: str | Column) -> Column:
    """Numeric group key = first run of digits in the id, as bigint.

    ``'D17'`` -> 17. Ids without digits give null instead of an error; callers that
    need a total key fall back to the raw id."""
    digits = F.regexp_extract(col(c).cast("string"), r"(\d+)", 1)
    return F.when(digits != "", digits).try_cast("bigint")


def safe_ratio(num: str | Column, den: str | Column) -> Column:
    """Division that gives null on a zero denominator (ANSI mode would raise)."""
    return F.try_divide(col(num), col(den))


def rounded(c: str | Column, digits: int = 6) -> Column:
    return F.round(col(c), digits)


def stable_hash(key: str | Column, seed: int | str) -> Column:
    """Order-defining hash for seeded group shuffles: md5 of ``'<key>:<seed>'``.
    Same value in any engine and on any partitioning."""
    return F.md5(F.concat(col(key).cast("string"), F.lit(f":{seed}")))
