"""Reports by menu item."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plateflow.functions.measures import count_type, order_revenue
from plateflow.operators.windows import arrival_window, event_window, of_types


def popular_items(
    events: DataFrame, as_of: date | str | None = None, days: int = 7, k: int = 20
) -> DataFrame:
    """The ``k`` items with most interactions, by arrival date.

    Items are told apart by id, which is not shown: two ids with one name give two rows.
    Equal counts are ordered by id.
    """
    per_item = (
        arrival_window(events, as_of, days)
        .groupBy("menu_item_id", "menu_item_name", "category")
        .agg(
            F.count("*").alias("total_interactions"),
            count_type("view").alias("views"),
            count_type("click").alias("clicks"),
            count_type("add_to_cart").alias("add_to_cart_count"),
            count_type("order").alias("orders"),
            F.coalesce(F.sum(order_revenue()), F.lit(0.0)).alias("revenue"),
        )
    )
    return (
        per_item.orderBy(
            F.desc("total_interactions"), "menu_item_id", "menu_item_name", "category"
        )
        .limit(k)
        .select(
            "menu_item_name",
            "category",
            "total_interactions",
            "views",
            "clicks",
            "add_to_cart_count",
            "orders",
            F.round("revenue", 2).alias("total_revenue"),
        )
    )


def item_interactions(
    events: DataFrame, as_of: date | str | None = None, days: int = 7
) -> DataFrame:
    """Orders and cart additions by item name and category, by event date, largest first."""
    return (
        of_types(event_window(events, as_of, days), "order", "add_to_cart")
        .groupBy("menu_item_name", "category")
        .agg(F.count("event_id").alias("event_count"))
        .orderBy(F.desc("event_count"), "menu_item_name", "category")
    )


def revenue_by_item(
    events: DataFrame, as_of: date | str | None = None, days: int = 7
) -> DataFrame:
    """Order revenue by item name, by event date."""
    return (
        of_types(event_window(events, as_of, days), "order")
        .groupBy("menu_item_name")
        .agg(F.round(F.sum("price"), 2).alias("revenue"))
    )
