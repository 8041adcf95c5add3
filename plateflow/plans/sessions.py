"""Session funnel."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plateflow.functions.measures import is_type
from plateflow.operators.windows import optional_window

# Funnel steps in order.
STEPS = {"view": "viewed", "click": "clicked", "add_to_cart": "carted", "order": "ordered"}


def session_funnel(
    events: DataFrame, as_of: date | str | None = None, days: int | None = None
) -> DataFrame:
    """Session items that reached each step, by restaurant; a step requires all earlier ones.

    Steps are collected as bits, so the order of the client's timestamps plays no part and each
    session item carries one small integer through the shuffle.
    """
    bit = F.lit(0)
    for position, event_type in enumerate(STEPS):
        bit = F.when(is_type(event_type), 1 << position).otherwise(bit)
    reached = optional_window(events, as_of, days).groupBy("restaurant_id", "session_id", "menu_item_id").agg(
        F.bit_or(bit).alias("steps")
    )
    counts = []
    for position, name in enumerate(STEPS.values()):
        required = (1 << (position + 1)) - 1
        counts.append(
            F.count_if(F.col("steps").bitwiseAND(F.lit(required)) == required).alias(name)
        )
    return reached.groupBy("restaurant_id").agg(*counts)
