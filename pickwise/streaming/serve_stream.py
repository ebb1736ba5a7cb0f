"""Micro-batch serving: new demands arriving on a stream get their best
plant through the batch operator in ``foreachBatch`` (stateless per demand,
so no state store is needed). The fitted model, the preprocessor and the
plant table are fixed for the life of the query."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from ..operators.serve import best_plant


def serve_stream(demands: DataFrame, model, prep, plants: DataFrame, output_path: str, checkpoint: str,
                 candidates: str = "all", plant_info: list[str] | None = None, fmt: str = "parquet",
                 trigger: dict | None = None) -> StreamingQuery:
    """Start a streaming query that appends the best plant of every new demand
    to ``output_path``. ``checkpoint`` is the query's progress folder (a
    shared folder on a cluster), so a restarted query resumes where it
    stopped; each micro-batch owns the folder ``batch=<id>``."""
    def write_batch(batch: DataFrame, batch_id: int) -> None:
        picks = best_plant(model, prep, batch, plants, candidates=candidates, plant_info=plant_info)
        # A replayed batch (after a failure) rewrites its own folder: the sink
        # is idempotent per batch id, so no pick is written twice.
        picks.write.mode("overwrite").format(fmt).save(f"{output_path}/batch={batch_id}")

    writer = demands.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint)
    writer = writer.trigger(**(trigger or {"availableNow": True}))
    return writer.start()
