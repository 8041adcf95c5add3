"""Calculated fields of the dashboard dataset."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plateflow.functions.measures import is_type, order_revenue
from plateflow.functions.temporal import short_day_name
from plateflow.operators.windows import optional_window


def calculated_fields(
    events: DataFrame, as_of: date | str | None = None, days: int | None = None
) -> DataFrame:
    """All event columns plus order and view flags, hour, weekday and order revenue."""
    moment = F.col("event_ts")
    return optional_window(events, as_of, days).withColumns(
        {
            "is_order": F.when(is_type("order"), 1).otherwise(0),
            "is_view": F.when(is_type("view"), 1).otherwise(0),
            "hour_of_day": F.hour(moment),
            "day_of_week": short_day_name(moment),
            "revenue": order_revenue(),
        }
    )
