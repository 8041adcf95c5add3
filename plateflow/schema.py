"""The event record: field names, domains and table schemas."""

from __future__ import annotations

from pyspark.sql import types as T

# Required fields in the order they are checked, and the value domains.
REQUIRED_FIELDS = (
    "event_id",
    "restaurant_id",
    "session_id",
    "timestamp",
    "event_type",
    "menu_item_id",
    "menu_item_name",
    "category",
    "price",
    "device_type",
)
EVENT_TYPES = ("view", "click", "add_to_cart", "order")
CATEGORIES = ("Burgers", "Pizza", "Salads", "Drinks", "Desserts")
DEVICE_TYPES = ("mobile", "tablet", "kiosk", "web")
WEEKDAYS = ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")

# Fields the server owns; a client value never reaches the table.
SERVER_FIELDS = ("ingested_at",)

ARRIVAL_PARTITIONS = ("year", "month", "day", "hour")

# The write that landed a row.  It is a column, not a folder, so the
# number of folders doesn't depend on the number of writes.
WRITE_KEY = "batch_id"

PARTITION_FIELDS = [T.StructField(name, T.StringType()) for name in ARRIVAL_PARTITIONS]

EVENT_FIELDS = [
    T.StructField("event_id", T.StringType()),
    T.StructField("restaurant_id", T.StringType()),
    T.StructField("session_id", T.StringType()),
    T.StructField("timestamp", T.StringType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("menu_item_id", T.StringType()),
    T.StructField("menu_item_name", T.StringType()),
    T.StructField("category", T.StringType()),
    T.StructField("price", T.DoubleType()),
    T.StructField("device_type", T.StringType()),
    T.StructField("event_ts", T.TimestampType()),
    T.StructField("ingested_at", T.TimestampType()),
    T.StructField("extra", T.VariantType()),
]

QUARANTINE_FIELDS = [
    T.StructField("error", T.StringType()),
    T.StructField("field", T.StringType()),
    T.StructField("event_id", T.StringType()),
    T.StructField("restaurant_id", T.StringType()),
    T.StructField("raw_excerpt", T.StringType()),
    T.StructField("value", T.StringType()),
    T.StructField("ingested_at", T.TimestampType()),
]

_KEY_FIELD = T.StructField(WRITE_KEY, T.StringType())
EVENT_SCHEMA = T.StructType([*EVENT_FIELDS, _KEY_FIELD, *PARTITION_FIELDS])
QUARANTINE_SCHEMA = T.StructType(
    [*QUARANTINE_FIELDS, _KEY_FIELD, *PARTITION_FIELDS, T.StructField("error_type", T.StringType())]
)

EVENT_COLUMNS = [field.name for field in EVENT_FIELDS]
