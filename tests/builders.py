"""Small hand-made inputs."""

from __future__ import annotations

import json
from datetime import datetime

from pyspark.sql import functions as F

from plateflow.functions.temporal import arrival_columns, parse_iso_timestamp
from plateflow.schema import ARRIVAL_PARTITIONS, EVENT_COLUMNS

VALID = {
    "event_id": "e1",
    "restaurant_id": "harbour",
    "session_id": "s1",
    "timestamp": "2024-03-15T08:05:44.250Z",
    "event_type": "view",
    "menu_item_id": "p7",
    "menu_item_name": "Four cheeses",
    "category": "Pizza",
    "price": 11.25,
    "device_type": "mobile",
}


def payload(**changes):
    """A valid event with changes; ``...`` removes a field."""
    event = {**VALID, **changes}
    return {name: value for name, value in event.items() if value is not ...}


def payload_text(**changes):
    return json.dumps(payload(**changes))


def payload_frame(spark, texts):
    rows = [(number, text) for number, text in enumerate(texts)]
    return spark.createDataFrame(rows, "row int, value string")


def event_frame(spark, events):
    """Event table rows.  Each event is a dict of changes; ``ingested_at`` defaults to its time."""
    rows = []
    for number, changes in enumerate(events):
        event = {**VALID, "event_id": f"e{number}", "extra": None, **changes}
        event["ingested_at"] = event.get("ingested_at", event["timestamp"])
        rows.append(tuple(event[name] for name in EVENT_COLUMNS if name != "event_ts"))
    schema = ", ".join(
        f"`{name}` {'double' if name == 'price' else 'string'}"
        for name in EVENT_COLUMNS
        if name != "event_ts"
    )
    df = spark.createDataFrame(rows, schema).withColumns(
        {
            "event_ts": parse_iso_timestamp(F.col("timestamp")),
            "ingested_at": F.to_timestamp("ingested_at"),
            "extra": F.try_parse_json("extra"),
        }
    )
    return df.withColumns(arrival_columns(F.col("ingested_at"))).select(
        *EVENT_COLUMNS, *ARRIVAL_PARTITIONS
    )


def at(day, hour=12, minute=0):
    return datetime.fromisoformat(f"{day}T{hour:02d}:{minute:02d}:00").strftime(
        "%Y-%m-%dT%H:%M:%SZ"
    )


def rows_of(df):
    return [row.asDict() for row in df.collect()]
