"""Expressions over dates and timestamps.  All assume a UTC session."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from plateflow.schema import ARRIVAL_PARTITIONS, WEEKDAYS

# An ISO-8601 text starts with a full date; folder formats of the arrival clock.
ISO_DATE_PREFIX = r"^\s*[0-9]{4}-[0-9]{2}-[0-9]{2}([T ]|\s*$)"
ARRIVAL_FORMATS = {"year": "yyyy", "month": "MM", "day": "dd", "hour": "HH"}


def parse_iso_timestamp(text: Column) -> Column:
    """Timestamp of an ISO-8601 text, with or without fraction and offset; bad text gives NULL.

    The prefix test refuses bare times, which Spark would complete with today's date.
    """
    return F.when(text.rlike(ISO_DATE_PREFIX), F.try_to_timestamp(text))


def arrival_columns(arrived: Column) -> dict[str, Column]:
    """Zero-padded partition texts of an arrival time."""
    return {name: F.date_format(arrived, ARRIVAL_FORMATS[name]) for name in ARRIVAL_PARTITIONS}


def iso_day_number(moment: Column) -> Column:
    """1 for Monday to 7 for Sunday."""
    return F.weekday(moment) + F.lit(1)


def day_name(day_number: Column) -> Column:
    """Full English name of an ISO day number."""
    return F.get(F.array(*[F.lit(name) for name in WEEKDAYS]), day_number - F.lit(1))


def short_day_name(moment: Column) -> Column:
    return F.date_format(moment, "E")
