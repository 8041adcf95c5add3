"""Reports by hour of day and weekday (UTC)."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plateflow.functions.temporal import day_name, iso_day_number
from plateflow.operators.windows import arrival_window, dated, event_window, optional_window
from plateflow.schema import WEEKDAYS


def hourly_trends(events: DataFrame, as_of: date | str | None = None, days: int = 7) -> DataFrame:
    """Events by hour, weekday and type; both the arrival and the event date lie in the window.

    Rows are counted by day number; names are added to the few rows that remain.
    """
    moment = F.col("event_ts")
    counts = (
        event_window(arrival_window(events, as_of, days), as_of, days)
        .groupBy(
            F.hour(moment).alias("hour_of_day"),
            iso_day_number(moment).alias("day_num"),
            "event_type",
        )
        .agg(F.count("*").alias("event_count"))
    )
    return counts.select(
        "hour_of_day",
        day_name(F.col("day_num")).alias("day_of_week"),
        "day_num",
        "event_type",
        "event_count",
    ).orderBy("day_num", "hour_of_day", "event_type")


def heatmap(events: DataFrame, as_of: date | str | None = None, days: int = 7) -> DataFrame:
    """Hour by weekday grid of event counts; a cell without events is NULL."""
    return (
        hourly_trends(events, as_of, days)
        .groupBy("hour_of_day")
        .pivot("day_of_week", list(WEEKDAYS))
        .agg(F.sum("event_count"))
    )


def hourly_profile(
    events: DataFrame, as_of: date | str | None = None, days: int | None = None
) -> DataFrame:
    """Events by hour of day, of those with a readable time; over the whole table or a window."""
    rows = dated(optional_window(events, as_of, days))
    return rows.groupBy(F.hour("event_ts").alias("hour_of_day")).agg(
        F.count("*").alias("event_count")
    )
