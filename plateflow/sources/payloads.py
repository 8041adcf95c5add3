"""Raw payload source: one JSON text per row, in the column ``value``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# A micro-batch is kept in memory or on disk while it lands.
MAX_BATCH_BYTES = 8 << 30


def read_payloads(
    spark: SparkSession,
    path: str,
    streaming: bool = False,
    max_bytes_per_trigger: int | None = MAX_BATCH_BYTES,
) -> DataFrame:
    """Payload lines below ``path``, as a batch or as a stream.

    ``max_bytes_per_trigger`` caps a micro-batch, so a first start on a large folder walks through it in
    batches of bounded size; it delays payloads and drops none.  Spark does not start a batch early when
    the cap is reached, so with a timed trigger the cap also limits throughput.
    """
    if not streaming:
        return spark.read.text(path)
    reader = spark.readStream.format("text")
    if max_bytes_per_trigger is not None:
        reader = reader.option("maxBytesPerTrigger", int(max_bytes_per_trigger))
    return reader.load(path)
