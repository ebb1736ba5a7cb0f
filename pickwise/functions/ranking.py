"""Positions and running totals over a total order, without a window that has
no PARTITION BY (which Spark runs in a single task).

The rows are range-partitioned and sorted (``orderBy``), the sorted result is
checkpointed to the shared checkpoint folder, and then:

* the position inside a partition is ``monotonically_increasing_id() -
  (partition_id << 33)`` (Spark packs exactly these two numbers into the id);
* the offset of a partition is the number of rows in all earlier partitions,
  taken from a per-partition count table that has one row per partition, so
  broadcasting it is bounded by ``spark.sql.shuffle.partitions``, not by data.

The checkpoint makes partition ids and in-partition positions stable: if an
executor is lost, the recomputed tasks read the same files in the same order.
The order columns must make the order total (end with a unique key).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

_PID = "__pw_pid"
_POS = "__pw_pos"


def sorted_checkpoint(df: DataFrame, order: list[str | Column]) -> DataFrame:
    """Globally sort ``df`` and cut the lineage in the shared checkpoint folder."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.orderBy(*order).checkpoint(eager=True)


def _tag(sorted_df: DataFrame) -> DataFrame:
    pid = F.spark_partition_id()
    return sorted_df.select(
        "*", pid.alias(_PID),
        (F.monotonically_increasing_id() - F.shiftleft(pid.cast("bigint"), 33)).alias(_POS))


def _offsets(tagged: DataFrame, sums: dict[str, str]) -> DataFrame:
    """Per-partition counts/sums and their exclusive prefix over partition order.
    One row per partition; the window runs over that small table only."""
    aggs = [F.count(F.lit(1)).alias("__pw_n")] + [F.sum(c).alias(f"__pw_s_{k}") for k, c in sums.items()]
    per_part = tagged.groupBy(_PID).agg(*aggs)
    before = Window.orderBy(_PID).rowsBetween(Window.unboundedPreceding, -1)
    cols = [F.col(_PID), F.coalesce(F.sum("__pw_n").over(before), F.lit(0)).alias("__pw_off")]
    cols += [F.coalesce(F.sum(f"__pw_s_{k}").over(before), F.lit(0.0)).alias(f"__pw_off_{k}") for k in sums]
    return per_part.select(*cols)


def with_global_index(df: DataFrame, order: list[str | Column], name: str = "idx") -> DataFrame:
    """Add ``name`` = 0-based position of each row in the total ``order``."""
    tagged = _tag(sorted_checkpoint(df, order))
    offsets = _offsets(tagged, {})
    out = tagged.join(F.broadcast(offsets), _PID)
    return out.select(*df.columns, (F.col("__pw_off") + F.col(_POS)).alias(name))


def with_running_sums(df: DataFrame, order: list[str | Column], sums: dict[str, str],
                      index_name: str = "idx") -> DataFrame:
    """Add the 0-based position and, for every ``out -> value column`` pair in
    ``sums``, the inclusive running sum of the value in ``order``.

    Inside a partition the running sum is a window partitioned by the partition
    id (bounded by the size of one range partition); the sums of all earlier
    partitions come from the small offsets table."""
    tagged = _tag(sorted_checkpoint(df, order))
    offsets = _offsets(tagged, sums)
    within = Window.partitionBy(_PID).orderBy(_POS).rowsBetween(Window.unboundedPreceding, 0)
    local = tagged.select("*", *[F.sum(c).over(within).alias(f"__pw_loc_{k}") for k, c in sums.items()])
    out = local.join(F.broadcast(offsets), _PID)
    cols = [F.col(c) for c in df.columns] + [(F.col("__pw_off") + F.col(_POS)).alias(index_name)]
    cols += [(F.col(f"__pw_off_{k}") + F.col(f"__pw_loc_{k}")).alias(k) for k in sums]
    return out.select(*cols)


def kth_row(df: DataFrame, order: list[str | Column], k: Column | int) -> DataFrame:
    """The row at 0-based position ``k`` of the total order (zero or one row)."""
    indexed = with_global_index(df, order, "__pw_k")
    kk = F.lit(k) if isinstance(k, int) else k
    return indexed.filter(F.col("__pw_k") == kk).drop("__pw_k")
