"""Reports as SQL table functions, for datasets that are written in SQL.

``SELECT * FROM device_breakdown_of(DATE '2024-01-30', 7)`` gives the report of a window that ends with
a day.  The folder test is on the bare partition columns, so that a call with literals reads the days of
its window only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

_DAY = "concat_ws('-', year, month, lpad(day, 2, '0'))"
_WINDOW = f"{_DAY} BETWEEN cast(date_sub(as_of, days - 1) AS string) AND cast(as_of AS string)"

# Name, result columns and body of each function; ``{events}`` is the relation of events.
FUNCTIONS = {
    "device_breakdown_of": (
        "restaurant_id STRING, device_type STRING, event_count BIGINT,"
        " percentage_of_restaurant_total DOUBLE, unique_sessions BIGINT",
        f"""
        SELECT restaurant_id, device_type, event_count,
               round(100D * event_count / sum(event_count) OVER (PARTITION BY restaurant_id), 2),
               unique_sessions
        FROM (SELECT restaurant_id, device_type, count(*) AS event_count,
                     count(DISTINCT session_id) AS unique_sessions
              FROM {{events}} WHERE {_WINDOW} GROUP BY restaurant_id, device_type)""",
    ),
    "category_conversion_of": (
        "category STRING, conversion_rate DOUBLE",
        f"""
        SELECT category, round(cast(orders AS double) / views, 4)
        FROM (SELECT category, count_if(event_type = 'view') AS views, count_if(event_type = 'order') AS orders
              FROM {{events}} WHERE event_type IN ('view', 'order') AND {_WINDOW} GROUP BY category)
        WHERE views > 0""",
    ),
}


def register_table_functions(spark: SparkSession, events: str) -> list[str]:
    """Make the functions callable in this session, over a table or view of events."""
    relation = ".".join("`" + part.replace("`", "``") + "`" for part in events.split("."))
    for name, (columns, body) in FUNCTIONS.items():
        spark.sql(
            f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(as_of DATE, days INT DEFAULT 7)"
            f" RETURNS TABLE ({columns}) RETURN {body.format(events=relation)}"
        )
    return list(FUNCTIONS)


def call(spark: SparkSession, name: str, as_of: str, days: int | None = None) -> DataFrame:
    """A function's rows for the window that ends with a day."""
    arguments = f"DATE '{as_of}'" + ("" if days is None else f", {int(days)}")
    return spark.sql(f"SELECT * FROM {name}({arguments})")
