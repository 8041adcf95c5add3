"""A daily rollup of the event table, and the dashboard counts made from it.

Counts and revenue add up over days, so a dashboard needs the rollup's few rows a day, not all events
of all time.  Distinct sessions and items don't add up and stay with the reports over events.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plateflow.functions.measures import order_revenue
from plateflow.operators.windows import optional_window
from plateflow.schema import ARRIVAL_PARTITIONS

DIMENSIONS = ("restaurant_id", "category", "event_type", "device_type")


def daily_rollup(
    events: DataFrame, as_of: date | str | None = None, days: int | None = None
) -> DataFrame:
    """Events and order revenue by arrival day and dimensions.

    A closed day never changes, so a refresh recomputes the last days only (``days=2``) and the rows
    of earlier days are kept.
    """
    return (
        optional_window(events, as_of, days)
        .groupBy(*ARRIVAL_PARTITIONS[:3], *DIMENSIONS)
        .agg(F.count("event_id").alias("event_count"), F.sum(order_revenue()).alias("revenue"))
    )


def rolled_up(
    rollup: DataFrame, *dimensions: str, as_of: date | str | None = None, days: int | None = None
) -> DataFrame:
    """Events and revenue by some of the dimensions, over all days or an arrival window."""
    return (
        optional_window(rollup, as_of, days)
        .groupBy(*dimensions)
        .agg(F.sum("event_count").alias("event_count"), F.round(F.sum("revenue"), 2).alias("revenue"))
    )
