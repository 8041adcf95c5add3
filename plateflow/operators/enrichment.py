"""Server-side enrichment and the two record shapes that leave the validator."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plateflow.functions.json_text import members_except
from plateflow.functions.temporal import arrival_columns, parse_iso_timestamp
from plateflow.operators.validation import accepted_events, rejected_events
from plateflow.schema import (
    ARRIVAL_PARTITIONS,
    EVENT_COLUMNS,
    QUARANTINE_FIELDS,
    REQUIRED_FIELDS,
    SERVER_FIELDS,
)

EXCERPT_LENGTH = 200


def enrich(df: DataFrame, now: Column | None = None) -> DataFrame:
    """Stamp the arrival time and its partition columns, replacing any ``ingested_at``.

    On a stream, call it on the streaming DataFrame: the batch time is kept in the checkpoint, so a
    replayed batch gets the same stamp and the same folders.
    """
    stamped = df.withColumn("ingested_at", F.current_timestamp() if now is None else now)
    return stamped.withColumns(arrival_columns(F.col("ingested_at")))


def event_records(validated: DataFrame) -> DataFrame:
    """Accepted payloads as rows of the event table.  Unknown fields stay in ``extra``."""
    records = accepted_events(validated).withColumns(
        {
            "event_ts": parse_iso_timestamp(F.col("timestamp")),
            "extra": members_except(F.col("payload"), REQUIRED_FIELDS + SERVER_FIELDS),
        }
    )
    return records.select(*EVENT_COLUMNS, *ARRIVAL_PARTITIONS)


def quarantine_records(validated: DataFrame) -> DataFrame:
    """Rejected payloads with the reason, a short excerpt and the whole raw text."""
    rejected = rejected_events(validated).withColumn(
        "raw_excerpt", F.left(F.col("value"), F.lit(EXCERPT_LENGTH))
    )
    columns = [field.name for field in QUARANTINE_FIELDS]
    return rejected.select(*columns, *ARRIVAL_PARTITIONS, "error_type")
