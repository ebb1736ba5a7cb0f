"""Lineage cuts for inputs that an operator reads several times."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir


def materialize(df: DataFrame) -> DataFrame:
    """Cut lineage in the shared checkpoint folder (survives executor loss)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def reusable(df: DataFrame) -> DataFrame:
    """Input read several times by a multi-pass operator: checkpoint it once
    unless it already is a checkpoint (a plain scan of checkpoint files)."""
    node = df._jdf.queryExecution().analyzed()
    # Look through projections, filters and aliases to the source.
    while node.getClass().getSimpleName() in ("Project", "Filter", "SubqueryAlias") and node.children().size() == 1:
        node = node.children().head()
    if node.getClass().getSimpleName() in ("LogicalRDD", "LogicalRelation"):
        return df
    return materialize(df)


#: Rows that one task of a model fit reads, pass after pass, from its cached partitions.
ROWS_PER_TASK = 1_000_000


def spread(df: DataFrame, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """The rows dealt evenly over as many partitions as their number needs, if a partition holds
    more than ``rows_per_task``; else as they are. Adaptive execution sizes partitions by compressed
    shuffle bytes and joins may widen their rows afterwards, so that a fit's tasks would grow with the table."""
    n, most = df.groupBy(F.spark_partition_id().alias("p")).agg(F.count(F.lit(1)).alias("n")).agg(F.sum("n"), F.max("n")).first()
    if not n or most <= rows_per_task:
        return df
    return df.repartition(math.ceil(n / rows_per_task))


#: Rows of a table that every task of a join may hold.
BROADCAST_ROWS = 500_000


def few(df: DataFrame, most: int = BROADCAST_ROWS) -> bool:
    """Whether the rows, counted, may be sent to all tasks."""
    return df.count() <= most


def beside(df: DataFrame, most: int = BROADCAST_ROWS) -> DataFrame:
    """The smaller side of a join, of one row per candidate or less: sent to all tasks if it is counted to
    have few rows, so that the other side is not shuffled before its size is known; else rebalanced,
    without a partitioning by the key, so that a hot key can be split. Read twice."""
    return F.broadcast(df) if few(df, most) else df.hint("rebalance")
