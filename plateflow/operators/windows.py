"""Date windows over the two clocks of an event.

Arrival windows read only partition columns and prune folders.  Event-time windows are range
predicates on ``event_ts`` and reach the row-group statistics of columnar files.
"""

from __future__ import annotations

from datetime import date, datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def as_date(as_of: date | str | None) -> date:
    """The last day of a window; today (UTC) when not given."""
    if as_of is None:
        return datetime.now(timezone.utc).date()
    return date.fromisoformat(as_of) if isinstance(as_of, str) else as_of


def window_bounds(as_of: date | str | None, days: int) -> tuple[date, date]:
    """First and last day, both inclusive."""
    if days < 1:
        raise ValueError("days must be at least 1")
    last = as_date(as_of)
    return last - timedelta(days=days - 1), last


def arrival_months(start: date, end: date) -> Column:
    """Coarse test on bare partition columns, which a metastore can evaluate itself.

    Lists every month the window touches, so a short month inside a window is kept.
    """
    months: dict[int, list[int]] = {}
    for index in range(start.year * 12 + start.month - 1, end.year * 12 + end.month):
        months.setdefault(index // 12, []).append(index % 12 + 1)
    tests = [
        (F.col("year") == f"{year:04d}") & F.col("month").isin(*[f"{m:02d}" for m in in_year])
        for year, in_year in months.items()
    ]
    coarse = tests[0]
    for test in tests[1:]:
        coarse = coarse | test
    return coarse


def arrival_days(start: date, end: date) -> Column:
    """Exact test: zero-padded dates compare as text, so no cast can fail on an odd folder name."""
    day = F.concat_ws("-", "year", "month", F.lpad("day", 2, "0"))
    return day.between(start.isoformat(), end.isoformat())


def arrival_window(df: DataFrame, as_of: date | str | None = None, days: int = 7) -> DataFrame:
    """Rows that arrived in the ``days`` days ending with ``as_of``."""
    start, end = window_bounds(as_of, days)
    return df.filter(arrival_months(start, end) & arrival_days(start, end))


def optional_window(
    df: DataFrame, as_of: date | str | None = None, days: int | None = None
) -> DataFrame:
    """Rows that arrived in the window; all rows where ``days`` is not given."""
    return df if days is None else arrival_window(df, as_of, days)


def dated(df: DataFrame) -> DataFrame:
    """Rows with a readable event time.  ``clock_skew`` counts the others."""
    return df.filter(F.col("event_ts").isNotNull())


def _midnight(day: date) -> Column:
    return F.to_timestamp(F.lit(f"{day.isoformat()}T00:00:00Z"))


def event_between(start: date, end: date) -> Column:
    """The event's own date lies in the window; NULL for an unreadable timestamp."""
    return (F.col("event_ts") >= _midnight(start)) & (
        F.col("event_ts") < _midnight(end + timedelta(days=1))
    )


def event_window(df: DataFrame, as_of: date | str | None = None, days: int = 7) -> DataFrame:
    """Rows whose event date is in the ``days`` days ending with ``as_of``."""
    return df.filter(event_between(*window_bounds(as_of, days)))


def outside_event_window(
    df: DataFrame, as_of: date | str | None = None, days: int = 7
) -> DataFrame:
    """Rows with a readable event date outside the window."""
    return df.filter(~event_between(*window_bounds(as_of, days)))


def of_types(df: DataFrame, *event_types: str) -> DataFrame:
    """Rows of the given event types."""
    if len(event_types) == 1:
        return df.filter(F.col("event_type") == event_types[0])
    return df.filter(F.col("event_type").isin(*event_types))
