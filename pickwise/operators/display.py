"""What an actual-against-predicted view shows, at a fixed size.

``density_grid`` counts all pairs in ``bins x bins`` cells over common bounds (a
mergeable aggregate: partial counts per cell). ``hash_sample`` takes the k rows
with the smallest hash of their key: the same rows on any partitioning and in any
engine, found by a bounded top-k per task. Both outputs are set by a parameter, not by the data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .summaries import prediction_bounds


def _bin(v: Column, lo: Column, hi: Column, bins: int) -> Column:
    """Bin 0..bins-1 of a value; both ends belong to the grid, a grid without width is one bin."""
    at = F.floor((v - lo) / (hi - lo) * bins)
    return F.when(hi > lo, F.least(F.greatest(at, F.lit(0)), F.lit(bins - 1))).otherwise(F.lit(0)).cast("int")


def density_grid(scored: DataFrame, bins: int = 50, actual: str = "Cost", pred: str = "prediction") -> DataFrame:
    """bin_actual, bin_predicted, n_pairs of the cells that hold pairs (missing values
    left out), with the lower corner of each cell; n_pairs adds up to all pairs."""
    pairs = scored.select(F.col(actual).cast("double").alias("Cost"), F.col(pred).cast("double").alias("prediction")).na.drop()
    bounds = prediction_bounds(pairs).first()      # one row: the common ends
    if bounds is None or bounds["lo"] is None:
        return scored.sparkSession.createDataFrame([], "bin_actual int, bin_predicted int, n_pairs long, actual_from double, predicted_from double")
    lo, hi = F.lit(float(bounds["lo"])), F.lit(float(bounds["hi"]))
    cells = pairs.groupBy(_bin(F.col("Cost"), lo, hi, bins).alias("bin_actual"), _bin(F.col("prediction"), lo, hi, bins).alias("bin_predicted")) \
        .agg(F.count(F.lit(1)).alias("n_pairs"))
    edge = lambda c: lo + F.col(c) * ((hi - lo) / bins)
    return cells.select("bin_actual", "bin_predicted", "n_pairs", edge("bin_actual").alias("actual_from"), edge("bin_predicted").alias("predicted_from"))


def hash_sample(df: DataFrame, keys: list[str], k: int = 1000, seed: int = 0) -> DataFrame:
    """The k rows with the smallest md5 of ``'<key>|<key>...:<seed>'`` (equal hashes by key);
    fewer than k rows give all. A null key counts as an empty text."""
    text = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in keys])
    order = F.md5(F.concat(text, F.lit(f":{seed}")))
    return df.orderBy(order, *keys).limit(k)
