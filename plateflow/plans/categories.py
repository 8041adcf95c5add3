"""Reports by menu category."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plateflow.functions.measures import count_type, is_type, order_revenue, ratio
from plateflow.operators.windows import (
    arrival_window,
    dated,
    event_between,
    of_types,
    optional_window,
    window_bounds,
)


def _type_total(name: str, by: str) -> Column:
    """Events of one type within the group ``by``, over already counted rows."""
    counted = F.sum(F.when(is_type(name), F.col("event_count")))
    return counted.over(Window.partitionBy(by))


def category_analysis(
    events: DataFrame, as_of: date | str | None = None, days: int = 30
) -> DataFrame:
    """Count, distinct items, price sum and mean by category and type, with the category's
    orders per view.

    ``total_revenue`` sums the price of every row of the group, whatever its type.  The rate is
    NULL for a category without views and 0 for one without orders.  It comes from a window over
    the counted rows, so the events are read once.
    """
    stats = (
        arrival_window(events, as_of, days)
        .groupBy("category", "event_type")
        .agg(
            F.count("*").alias("event_count"),
            F.count_distinct("menu_item_id").alias("unique_items"),
            F.round(F.coalesce(F.sum("price"), F.lit(0.0)), 2).alias("total_revenue"),
            F.round(F.avg("price"), 2).alias("avg_price"),
        )
    )
    orders = F.coalesce(_type_total("order", "category"), F.lit(0))
    rate = ratio(orders, _type_total("view", "category"), 4)
    return (
        stats.withColumn("conversion_rate", F.when(F.col("category").isNotNull(), rate))
        .select(
            "category",
            "event_type",
            "event_count",
            "unique_items",
            "total_revenue",
            "avg_price",
            "conversion_rate",
        )
        .orderBy("category", "event_type")
    )


def category_conversion(
    events: DataFrame, as_of: date | str | None = None, days: int = 30
) -> DataFrame:
    """Orders per view for every category that has views."""
    counts = (
        of_types(arrival_window(events, as_of, days), "view", "order")
        .groupBy("category")
        .agg(count_type("view").alias("views"), count_type("order").alias("orders"))
    )
    return counts.filter(F.col("views") > 0).select(
        "category", ratio(F.col("orders"), F.col("views"), 4).alias("conversion_rate")
    )


def category_analysis_joined(
    events: DataFrame, as_of: date | str | None = None, days: int = 30
) -> DataFrame:
    """:func:`category_analysis` written as a join of stats and rates; reads the events twice.

    Kept as an independent twin of the window form.  No broadcast hint: both sides are small after
    aggregation and the optimizer measures them.
    """
    window = arrival_window(events, as_of, days)
    by_type = window.groupBy("category", "event_type")
    counts = by_type.agg(F.count("*").alias("event_count"), F.sum("price").alias("prices"))
    items = (
        window.select("category", "event_type", "menu_item_id")
        .distinct()
        .groupBy("category", "event_type")
        .agg(F.count("menu_item_id").alias("unique_items"))
    )
    return (
        counts.join(items, ["category", "event_type"], "left")
        .join(category_conversion(events, as_of, days), "category", "left")
        .select(
            "category",
            "event_type",
            "event_count",
            "unique_items",
            F.round(F.coalesce("prices", F.lit(0.0)), 2).alias("total_revenue"),
            F.round(F.col("prices") / F.col("event_count"), 2).alias("avg_price"),
            "conversion_rate",
        )
        .orderBy("category", "event_type")
    )


def events_by_category(
    events: DataFrame, as_of: date | str | None = None, days: int | None = None
) -> DataFrame:
    rows = optional_window(events, as_of, days)
    return rows.groupBy("category").agg(F.count("event_id").alias("event_count"))


def category_event_breakdown(
    events: DataFrame, as_of: date | str | None = None, days: int | None = None
) -> DataFrame:
    rows = optional_window(events, as_of, days)
    return rows.groupBy("category", "event_type").agg(F.count("event_id").alias("event_count"))


def revenue_kpi(events: DataFrame, as_of: date | str | None = None, days: int = 7) -> DataFrame:
    """Order revenue of the last ``days`` event days, of the ``days`` before, and the change in
    percent.  One pass over the double window."""
    start, end = window_bounds(as_of, days)
    before = start - timedelta(days=1)
    first = before - timedelta(days=days - 1)
    orders = of_types(events.filter(event_between(first, end)), "order")
    current, prior = F.col("revenue"), F.col("prior_revenue")
    totals = orders.agg(
        *[
            F.round(
                F.coalesce(F.sum(F.when(event_between(low, high), order_revenue())), F.lit(0.0)), 2
            ).alias(name)
            for name, low, high in (("revenue", start, end), ("prior_revenue", first, before))
        ]
    )
    change = F.round(F.lit(100.0) * (current - prior) / F.nullif(prior, F.lit(0.0)), 2)
    return totals.withColumn("change_pct", change)


def category_daily_views(
    events: DataFrame, as_of: date | str | None = None, days: int | None = None
) -> DataFrame:
    """View events by category and event date."""
    return (
        of_types(dated(optional_window(events, as_of, days)), "view")
        .groupBy(F.to_date("event_ts").alias("event_date"), "category")
        .agg(F.count("*").alias("views"))
    )
