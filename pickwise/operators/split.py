"""Splits by whole demand.

* Grouped shuffle split: groups are ordered by ``md5('<key>:<seed>')`` and the
  first ``ceil(n * fraction)`` groups are the test set (scikit-learn rounds the
  test count up). The cut is found once as the k-th group of that order; rows
  are then flagged by comparing their own hash with it, so the split needs no
  join back to the (large) row table and is the same on any partitioning.
* Leave-one-group-out: groups ascending by numeric group key, the first
  ``n_folds`` are folds 1..n. Folds are a (group, fold) table, never
  ``n_folds`` copies of the data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import group_key, stable_hash
from ..functions.ranking import with_global_index
from .combine import DEMAND


def split_cut(groups: DataFrame, key: str, test_fraction: float, seed: int) -> DataFrame:
    """Zero or one row: (``__h``, ``key``) of the last test group in hash order."""
    hashed = groups.select(key, stable_hash(key, seed).alias("__h"))
    indexed = with_global_index(hashed, ["__h", key], "__i")
    n = indexed.agg(F.count(F.lit(1))).scalar()
    k = F.ceil(n.cast("double") * F.lit(float(test_fraction)))
    return indexed.filter(F.col("__i") == k - 1).select("__h", key)


def flag_test(df: DataFrame, cut: DataFrame, key: str, seed: int, out: str = "is_test") -> DataFrame:
    """Add ``out``: true for rows whose group is at or before the cut. The cut
    is one row, computed once; rows are compared with it as literals, so
    later jobs on either side of the split do not recompute it."""
    row = cut.first()
    if row is None:
        return df.withColumn(out, F.lit(False))
    ch, ck = F.lit(row["__h"]), F.lit(row[key]).cast(df.schema[key].dataType)
    h = stable_hash(key, seed)
    before = (h < ch) | ((h == ch) & (F.col(key) <= ck))
    return df.withColumn(out, F.coalesce(before, F.lit(False)))


def group_split(df: DataFrame, test_fraction: float, seed: int, key: str = DEMAND,
                out: str = "is_test") -> DataFrame:
    """G1: every row of ``df`` with its test flag (whole groups only)."""
    groups = df.select(key).filter(F.col(key).isNotNull()).distinct()
    return flag_test(df, split_cut(groups, key, test_fraction, seed), key, seed, out)


def split_groups(df: DataFrame, test_fraction: float, seed: int, key: str = DEMAND) -> DataFrame:
    """The distinct groups with their flag (train = not test)."""
    groups = df.select(key).filter(F.col(key).isNotNull()).distinct()
    return flag_test(groups, split_cut(groups, key, test_fraction, seed), key, seed)


def split_counts(flagged: DataFrame, key: str = DEMAND, flag: str = "is_test") -> DataFrame:
    """Rows and distinct groups per side."""
    return flagged.groupBy(flag).agg(F.count(F.lit(1)).alias("n_rows"),
                                     F.count_distinct(key).alias("n_groups"))


def group_column(df: DataFrame, key: str = DEMAND) -> Column:
    """The LOGO group of a row: the id itself when integral, else the number
    in its first digit run (P14). If some ids of ``df`` hold no such number,
    all groups are text: the number's where there is one, else the id."""
    dtype = df.schema[key].dataType
    if isinstance(dtype, (T.IntegerType, T.LongType, T.ShortType, T.ByteType)):
        return F.col(key).cast("bigint")
    number = group_key(key)
    if df.filter(F.col(key).isNotNull() & number.isNull()).isEmpty():
        return number
    return F.coalesce(number.cast("string"), F.col(key).cast("string"))


def logo_folds(df: DataFrame, n_folds: int | None = None, key: str = DEMAND) -> DataFrame:
    """``(Fold, Group)`` for the first ``n_folds`` groups in
    ascending group order, numbers before other texts (all groups when ``None``)."""
    groups = df.select(group_column(df, key).alias("Group")).filter(F.col("Group").isNotNull()).distinct()
    order = [F.col("Group").cast("string").try_cast("bigint").asc_nulls_last(), F.col("Group")]
    indexed = with_global_index(groups, order, "__i")
    if n_folds is not None:
        indexed = indexed.filter(F.col("__i") < n_folds)
    return indexed.select((F.col("__i") + 1).cast("int").alias("Fold"), "Group")


def with_group(df: DataFrame, key: str = DEMAND, out: str = "Group") -> DataFrame:
    return df.withColumn(out, group_column(df, key))
