"""Clickstream views derived from the generic ``events`` test table.

``events`` has an id, a time, a user, a type, a value and a small JSON text.  Every column of the
clickstream is a fixed rule over these, so that another SQL engine can apply the same rules.  Guests
come back within a week, so sessions reach all steps; most kiosks fail in the last week; some times
can't be read; arrivals are up to half a second early, up to a day late, or gathered at midnight.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plateflow.functions.once import with_columns_once
from plateflow.functions.temporal import arrival_columns
from plateflow.schema import ARRIVAL_PARTITIONS, CATEGORIES, EVENT_COLUMNS

AS_OF = "2024-01-30"
LINE_KINDS = 41
ITEMS = 25
GUESTS = 7
# One event in so many has a time that can't be read.
UNREADABLE = 53
KIOSKS_FAIL = "2024-01-24 00:00:00"


def base_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row of ``events`` with clickstream columns; the source id is kept as ``seq``."""
    return derive_events(spark.read.parquet(f"{sf_dir}/events.parquet"))


def derive_events(source: DataFrame) -> DataFrame:
    rows = source.select(
        F.col("event_id").alias("seq"),
        F.col("ts").cast("timestamp").alias("event_ts"),
        "user_id",
        F.col("event_type").alias("raw_type"),
        "value",
        (F.regexp_extract("props", r"[0-9]+", 0).cast("int") % ITEMS).alias("k"),
    )
    group = F.col("k") % 5
    kind = F.col("raw_type")
    seat = F.col("user_id") % 20
    event_type = (
        F.when(kind == "signup", "add_to_cart")
        .when(kind == "purchase", F.when(group == 2, "click").otherwise("order"))
        .when((kind == "view") & (group == 4), "click")
        .otherwise(kind)
    )
    kiosk_works = (F.col("event_ts") < F.lit(KIOSKS_FAIL).cast("timestamp")) | (F.col("seq") % 4 == 0)
    device = (
        F.when(seat < 10, "mobile").when(seat < 16, "web")
        .when(seat < 19, F.when(kiosk_works, "kiosk").otherwise("web"))
        .otherwise("tablet")
    )
    readable = F.col("seq") % UNREADABLE != 0
    late = F.make_dt_interval(
        hours=(F.col("seq") % 7 * 4).cast("int"), secs=(F.col("seq") * 37 % 2000 - 500) / 1000
    )
    # Every third event waits for the delivery at midnight.
    midnight = F.date_trunc("day", "event_ts") + F.make_dt_interval(days=F.lit(1))
    arrived = F.when(F.col("seq") % 3 == 0, midnight).otherwise(F.col("event_ts") + late)
    category = F.get(F.array(*[F.lit(name) for name in CATEGORIES]), group)
    return rows.select(
        "seq",
        F.col("seq").cast("string").alias("event_id"),
        F.concat(F.lit("rest_00"), (F.col("seq") % 3 + 1).cast("string")).alias("restaurant_id"),
        F.concat(
            F.lit("s"), (F.col("user_id") % GUESTS).cast("string"), F.lit("-"),
            F.to_date(F.date_trunc("week", "event_ts")).cast("string"),
        ).alias("session_id"),
        F.when(readable, F.date_format("event_ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"))
        .otherwise("soon").alias("timestamp"),
        event_type.alias("event_type"),
        F.concat(F.lit("item_"), F.lpad(F.col("k").cast("string"), 3, "0")).alias("menu_item_id"),
        F.concat(F.lit("Item "), F.col("k").cast("string")).alias("menu_item_name"),
        category.alias("category"),
        F.when(F.col("seq") % 97 == 0, -F.col("value")).otherwise(F.col("value")).alias("price"),
        device.alias("device_type"),
        F.when(readable, F.col("event_ts")).alias("event_ts"),
        arrived.alias("ingested_at"),
        F.get(
            F.array(F.lit("ios"), F.lit("android"), F.lit("web")), (F.col("seq") % 3).cast("int")
        ).alias("platform"),
    )


def clickstream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event table rows: those of ``events`` whose derived type and price are valid."""
    rows = base_events(spark, sf_dir).filter("event_type <> 'error' AND price > 0")
    rows = rows.withColumn("extra", F.to_variant_object(F.struct("platform")))
    rows = with_columns_once(rows, arrival_columns(F.col("ingested_at")))
    return rows.select(*EVENT_COLUMNS, *ARRIVAL_PARTITIONS)


def _json(row: Column, nulls: bool = False) -> Column:
    return F.to_json(row, {"ignoreNullFields": str(not nulls).lower()})


def payload_lines(base: DataFrame) -> DataFrame:
    """``seq, ingested_at, value``: one payload text per row of ``base``.

    ``seq % 41`` picks the form of the text: the three envelopes, texts that are no event, and each
    kind of invalid or unusual field.  Most forms leave the event as it is.
    """
    form = F.col("seq") % LINE_KINDS

    def field(name: str, changes: dict[int, Column]) -> Column:
        value = F.col(name)
        for number, changed in changes.items():
            value = F.when(form == number, changed).otherwise(value)
        return value.alias(name)

    nothing = F.lit(None).cast("string")
    event = F.struct(
        field("event_id", {}),
        field("restaurant_id", {}),
        field("session_id", {8: nothing}),
        field("timestamp", {18: F.lit("soon")}),
        field("event_type", {7: F.lit("VIEW"), 10: F.lit("VIEW")}),
        field("menu_item_id", {}),
        field("menu_item_name", {9: F.lit(" \t")}),
        field("category", {11: F.lit("Sushi")}),
        F.col("price"),
        field("device_type", {7: nothing, 11: F.lit("watch"), 12: F.lit("watch")}),
        F.col("platform"),
    )
    written = F.when(form == 8, _json(event, nulls=True)).otherwise(_json(event))
    base = with_columns_once(base, {"_text": written})
    text = F.col("_text")

    def with_price(literal: Column) -> Column:
        return F.regexp_replace(text, F.lit(r'"price":[-0-9.Ee]+'), F.concat(F.lit('"price":'), literal))

    price_text = F.concat(F.lit('"'), F.col("price").cast("string"), F.lit('"'))
    rest = F.substring(text, F.lit(2), F.length(text))
    value = (
        F.when(form == 1, _json(F.struct(text.alias("body"))))
        .when(form == 2, F.concat(F.lit('{"body":'), text, F.lit("}")))
        .when(form == 3, F.concat(F.lit('{"body":null,'), rest))
        .when(form == 4, F.concat(F.lit("junk "), F.col("event_id")))
        .when(form == 5, F.concat(F.lit('{"body":'), F.col("event_id"), F.lit("}")))
        .when(form == 6, F.lit('{"body":"[1]"}'))
        .when(form == 13, with_price(F.lit('"abc"')))
        .when(form == 14, with_price(F.lit("0")))
        .when(form == 15, with_price(price_text))
        .when(form == 16, F.concat(F.lit('{"ingested_at":"1999-01-01","user_id":"u1",'), rest))
        .when(form == 17, F.concat(text, F.lit(" x")))
        .when(form == 19, with_price(F.lit("true")))
        .when(form == 20, with_price(F.lit("[1]")))
        .otherwise(text)
    )
    return base.select("seq", "ingested_at", value.alias("value"))
