"""Streaming ingest metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from plateflow.streaming.ingest import FLUSH_INTERVAL


def start_metric(
    metric: DataFrame,
    out: str,
    checkpoint: str,
    mode: str = "append",
    interval: str = FLUSH_INTERVAL,
    available_now: bool = False,
) -> StreamingQuery:
    """Write a windowed metric stream to Parquet.

    ``append`` writes a window once, when the watermark has passed it.  ``complete`` replaces the
    whole table after each batch, open windows included; use it for bounded input only.
    """
    stream = metric.writeStream.option("checkpointLocation", checkpoint).outputMode(mode)
    if mode == "complete":

        def replace(batch: DataFrame, _: int) -> None:
            batch.write.mode("overwrite").parquet(out)

        stream = stream.foreachBatch(replace)
    else:
        stream = stream.format("parquet").option("path", out)
    trigger = {"availableNow": True} if available_now else {"processingTime": interval}
    return stream.trigger(**trigger).start()
