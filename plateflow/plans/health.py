"""Ingest health: rejections, volumes, alarm, clock skew, late arrivals."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plateflow.functions.measures import leading_digits, percent
from plateflow.operators.validation import ACCEPTED, REJECTED, rejected_events
from plateflow.operators.windows import arrival_window, optional_window, outside_event_window, window_bounds

# Metric period, alarm threshold and failure share that warns.
METRIC_PERIOD = "5 minutes"
ALARM_ERRORS = 10
WARN_PERCENT = 10


def _arrived(
    validated: DataFrame, as_of: date | str | None, days: int | None
) -> DataFrame:
    """Payloads whose arrival day is in the window; all where ``days`` is not given."""
    if days is None:
        return validated
    return validated.filter(F.to_date("ingested_at").between(*window_bounds(as_of, days)))


def rejection_summary(
    validated: DataFrame, as_of: date | str | None = None, days: int | None = None
) -> DataFrame:
    """Rejected payloads by offending field."""
    return rejected_events(_arrived(validated, as_of, days)).groupBy("field").agg(F.count("*").alias("rejected"))


def ingest_summary(
    validated: DataFrame,
    as_of: date | str | None = None,
    days: int | None = None,
    warn_pct: float = WARN_PERCENT,
) -> DataFrame:
    """Payloads by type, by restaurant, by device and in total, with the rejected share.

    Payloads are counted once by all three dimensions; the grouping sets run over those counts,
    so the payload rows are not multiplied.
    """
    dimensions = ["event_type", "restaurant_id", "device_type"]
    base = _arrived(validated, as_of, days).groupBy(
        *[F.coalesce(F.col(name), F.lit("unknown")).alias(name) for name in dimensions]
    ).agg(F.count("*").alias("n"), F.count_if(F.col("status") == REJECTED).alias("bad"))
    sets = base.groupingSets(
        [[F.col(name)] for name in dimensions] + [[]], *[F.col(name) for name in dimensions]
    ).agg(
        F.sum("n").alias("event_count"),
        F.sum("bad").alias("bad"),
        *[F.grouping(name).alias(f"{name}_rolled") for name in dimensions],
    )
    dimension = F.lit("total")
    for name in dimensions:
        dimension = F.when(F.col(f"{name}_rolled") == 0, name).otherwise(dimension)
    share = percent(F.col("bad"), F.col("event_count"))
    return sets.select(
        dimension.alias("dimension"),
        F.coalesce(*[F.col(name) for name in dimensions], F.lit("all")).alias("value"),
        "event_count",
        share.alias("rejected_pct"),
        (share > warn_pct).alias("warn"),
    )


def ingest_rate_5min(
    validated: DataFrame,
    as_of: date | str | None = None,
    days: int | None = None,
    watermark: str | None = None,
) -> DataFrame:
    """Payloads, rejections and accepted events per five minutes of arrival.

    Works on a batch or a stream.  A stream that appends needs a ``watermark``.
    """
    rows = _arrived(validated, as_of, days).select("ingested_at", "status")
    if watermark is not None:
        rows = rows.withWatermark("ingested_at", watermark)
    return (
        rows.groupBy(F.window("ingested_at", METRIC_PERIOD))
        .agg(
            F.count("*").alias("invocations"),
            F.count_if(F.col("status") == REJECTED).alias("errors"),
            F.count_if(F.col("status") == ACCEPTED).alias("delivered"),
        )
        .select(
            F.col("window.start").alias("window_start"),
            F.col("window.end").alias("window_end"),
            "invocations",
            "errors",
            "delivered",
        )
    )


def ingest_error_alarm(
    validated: DataFrame,
    as_of: date | str | None = None,
    days: int | None = None,
    threshold: int = ALARM_ERRORS,
    watermark: str | None = None,
) -> DataFrame:
    """Five-minute windows with at least ``threshold`` rejected payloads.

    A window without payloads does not appear, so missing data raises no alarm.
    """
    rates = ingest_rate_5min(validated, as_of, days, watermark)
    return rates.filter(F.col("errors") >= threshold).select("window_start", "window_end", "errors")


def clock_skew(
    events: DataFrame, as_of: date | str | None = None, days: int | None = None
) -> DataFrame:
    """Arrival minus event time in seconds, by device.

    The 95th percentile is the least skew that 95 of 100 events don't exceed, cut to three leading
    digits of its microseconds: right within one percent from a microsecond to years, and negative
    skews alike.  Skews are counted by device and these digits first, a bounded number of rows, so
    the running count never sees the events of a device.
    """
    micros = F.unix_micros("ingested_at") - F.unix_micros("event_ts")
    counted = (
        optional_window(events, as_of, days)
        .select("device_type", micros.alias("skew"))
        .groupBy("device_type", leading_digits(F.col("skew")).alias("digits"))
        .agg(
            F.count("*").alias("n"),
            F.min("skew").alias("low"),
            F.max("skew").alias("high"),
            F.count_if(F.col("skew") < 0).alias("early"),
        )
    )
    of_device = Window.partitionBy("device_type")
    readable = F.when(F.col("digits").isNotNull(), F.col("n"))
    ranked = counted.withColumns(
        {
            "upto": F.sum(readable).over(of_device.orderBy("digits")),
            "known": F.sum(readable).over(of_device),
        }
    )
    enough = F.col("upto") >= F.lit(0.95) * F.col("known")
    return ranked.groupBy("device_type").agg(
        F.sum("n").alias("events"),
        F.sum(F.when(F.col("digits").isNull(), F.col("n")).otherwise(0)).alias("unparsed"),
        (F.min("low") / 1e6).alias("min_skew_s"),
        (F.max("high") / 1e6).alias("max_skew_s"),
        (F.min(F.when(enough, F.col("digits"))) / 1e6).alias("p95_skew_s"),
        F.sum("early").alias("negative"),
    )


def late_arrivals(events: DataFrame, as_of: date | str | None = None, days: int = 7) -> DataFrame:
    """Rows that arrived inside the window with an event date outside it."""
    return outside_event_window(arrival_window(events, as_of, days), as_of, days)
