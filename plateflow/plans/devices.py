"""Reports by device type and restaurant."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plateflow.functions.measures import count_type, percent
from plateflow.operators.windows import (
    arrival_days,
    arrival_months,
    arrival_window,
    dated,
    optional_window,
    window_bounds,
)
from plateflow.schema import DEVICE_TYPES


def _restaurant_devices(events: DataFrame) -> DataFrame:
    return events.groupBy("restaurant_id", "device_type").agg(
        F.count("*").alias("event_count"),
        F.count_distinct("session_id").alias("unique_sessions"),
    )


def device_breakdown(
    events: DataFrame, as_of: date | str | None = None, days: int = 7
) -> DataFrame:
    """Events and distinct sessions by restaurant and device, with the device's share of the
    restaurant in percent.  The total is a window over the counted rows."""
    counts = _restaurant_devices(arrival_window(events, as_of, days))
    total = F.sum("event_count").over(Window.partitionBy("restaurant_id"))
    return counts.select(
        "restaurant_id",
        "device_type",
        "event_count",
        percent(F.col("event_count"), total).alias("percentage_of_restaurant_total"),
        "unique_sessions",
    ).orderBy("restaurant_id", F.desc("event_count"), "device_type")


def events_by_device(
    events: DataFrame, as_of: date | str | None = None, days: int | None = None
) -> DataFrame:
    rows = optional_window(events, as_of, days)
    return rows.groupBy("device_type").agg(F.count("event_id").alias("event_count"))


def restaurant_device_pivot(
    events: DataFrame, as_of: date | str | None = None, days: int | None = None
) -> DataFrame:
    """One row per restaurant: events and distinct sessions of each device, 0 where none."""
    grid = (
        _restaurant_devices(optional_window(events, as_of, days))
        .groupBy("restaurant_id")
        .pivot("device_type", list(DEVICE_TYPES))
        .agg(F.sum("event_count").alias("events"), F.sum("unique_sessions").alias("sessions"))
    )
    return grid.fillna(0, subset=[name for name in grid.columns if name != "restaurant_id"])


def device_daily_trend(
    events: DataFrame, as_of: date | str | None = None, days: int | None = None
) -> DataFrame:
    """Events by event date and device."""
    rows = dated(optional_window(events, as_of, days))
    return rows.groupBy(F.to_date("event_ts").alias("event_date"), "device_type").agg(
        F.count("event_id").alias("event_count")
    )


def device_platform_mix(
    events: DataFrame, as_of: date | str | None = None, days: int | None = None
) -> DataFrame:
    """Distinct sessions and views by device and the ``platform`` extra."""
    platform = F.try_variant_get("extra", "$.platform", "string")
    rows = optional_window(events, as_of, days)
    return rows.groupBy("device_type", platform.alias("platform")).agg(
        F.count_distinct("session_id").alias("sessions"), count_type("view").alias("views")
    )


def device_dropoff(
    events: DataFrame,
    as_of: date | str | None = None,
    days: int = 7,
    min_ratio: float = 0.5,
) -> DataFrame:
    """Restaurant devices whose arrivals fell below ``min_ratio`` of the window before.

    A device with no event at all in the current window is kept, with a count of 0.
    """
    start, end = window_bounds(as_of, days)
    both = arrival_window(events, end, 2 * days)
    current = arrival_months(start, end) & arrival_days(start, end)
    counts = both.groupBy("restaurant_id", "device_type").agg(
        F.count_if(current).alias("current_count"), F.count_if(~current).alias("prior_count")
    )
    share = F.col("current_count") / F.nullif(F.col("prior_count"), F.lit(0))
    return counts.withColumn("dropped", F.coalesce(share < min_ratio, F.lit(False)))
