"""Quantiles with linear interpolation (numpy's default, pandas' ``quantile``).

Four ways, same meaning:

* ``exact``  - Spark's ``percentile`` aggregate. Exact and partially
  aggregated, but its buffer is a value->count map per group, so one group's
  memory grows with its number of distinct values.
* ``approx`` - ``percentile_approx`` with a fixed-size sketch (rank error
  ``1/accuracy``); bounded memory for any group size.
* ``sorted`` - exact and skew-safe: a global sort on (group, value), then the
  two rows around the quantile position of each group are picked by their
  global position (see ``ranking``). No group is ever held by one task.
* ``selected`` - exact and skew-safe without a sort: mergeable sketches bracket
  each wanted rank, a second aggregated pass counts (see ``selection``; default).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ranking import with_global_index
from .selection import selected_quantiles

METHODS = ("exact", "approx", "sorted", "selected")
DEFAULT_METHOD = "selected"


def quantile_expr(value: str | Column, q: float, method: str = "exact",
                  accuracy: int = 10_000) -> Column:
    """Aggregate expression for the ``q`` quantile (``exact`` or ``approx``)."""
    v = F.col(value) if isinstance(value, str) else value
    if method == "exact":
        return F.percentile(v, F.lit(float(q)))
    if method == "approx":
        return F.percentile_approx(v, F.lit(float(q)), F.lit(accuracy))
    raise ValueError(f"quantile_expr supports 'exact' and 'approx', not {method!r}")


def grouped_quantiles(df: DataFrame, keys: list[str], value: str, qs: dict[str, float],
                      method: str = DEFAULT_METHOD, accuracy: int = 10_000) -> DataFrame:
    """One row per group (``keys``) with one column per ``name -> q`` in ``qs``;
    null values are skipped, groups without values are absent."""
    if method not in METHODS:
        raise ValueError(f"unknown quantile method {method!r}")
    if method == "selected":
        return selected_quantiles(df, keys, value, qs)
    present = df.filter(F.col(value).isNotNull())
    if method != "sorted":
        grouped = present.groupBy(*keys) if keys else present
        return grouped.agg(*[quantile_expr(value, q, method, accuracy).alias(n) for n, q in qs.items()])
    return _sorted_quantiles(present.select(*keys, value), keys, value, qs)


def _sorted_quantiles(df: DataFrame, keys: list[str], value: str, qs: dict[str, float]) -> DataFrame:
    # Rows of a group are contiguous in the global (keys, value) order; a group
    # starts at the smallest global position it holds. Copies of one value are
    # interchangeable, so a tie-break on the input position spreads a value
    # that fills a third of the table over many range partitions. The input
    # is first made a written table (unless it is a file scan or checkpoint),
    # so positions - and the tie-break - are the same on any task retry.
    from .reuse import reusable
    df = reusable(df.select(*keys, value)).withColumn("__q_tb", F.monotonically_increasing_id())
    indexed = with_global_index(df, [*keys, value, "__q_tb"], "__q_pos")
    grouped = indexed.groupBy(*keys) if keys else indexed
    spans = grouped.agg(F.min("__q_pos").alias("__q_first"), F.count(F.lit(1)).alias("__q_n"))
    targets = []
    for name, q in qs.items():
        rank = (F.col("__q_n") - 1).cast("double") * F.lit(float(q))
        lo, hi = F.floor(rank), F.ceil(rank)
        for side, r in (("lo", lo), ("hi", hi)):
            targets.append(spans.select(*keys, F.lit(name).alias("__q_name"), F.lit(side).alias("__q_side"),
                                        (rank - lo).alias("__q_frac"),
                                        (F.col("__q_first") + r).alias("__q_pos")))
    wanted = targets[0]
    for t in targets[1:]:
        wanted = wanted.unionByName(t)
    # Join on the unique global position: no key can be skewed here.
    picked = wanted.join(indexed.select("__q_pos", value), "__q_pos")
    pair = picked.groupBy(*keys, "__q_name").agg(
        F.max(F.when(F.col("__q_side") == "lo", F.col(value))).alias("__lo"),
        F.max(F.when(F.col("__q_side") == "hi", F.col(value))).alias("__hi"),
        F.max("__q_frac").alias("__frac"))
    interp = pair.select(*keys, "__q_name",
                         (F.col("__lo") + (F.col("__hi") - F.col("__lo")) * F.col("__frac")).alias("__v"))
    grouped_out = interp.groupBy(*keys) if keys else interp
    return grouped_out.agg(*[F.max(F.when(F.col("__q_name") == n, F.col("__v"))).alias(n) for n in qs])
