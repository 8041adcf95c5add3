"""Counting and ratio expressions used by the reports."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def is_type(name: str) -> Column:
    return F.col("event_type") == name


def count_type(name: str) -> Column:
    return F.count_if(is_type(name))


def order_revenue() -> Column:
    """Price of an order row, 0 for any other row."""
    return F.when(is_type("order"), F.col("price")).otherwise(F.lit(0.0))


def ratio(part: Column, whole: Column, digits: int) -> Column:
    """Rounded quotient of two counts as double; NULL when ``whole`` is 0 or NULL."""
    return F.round(part.cast("double") / F.nullif(whole.cast("double"), F.lit(0.0)), digits)


def percent(part: Column, whole: Column, digits: int = 2) -> Column:
    return F.round(
        F.lit(100.0) * part.cast("double") / F.nullif(whole.cast("double"), F.lit(0.0)), digits
    )


def leading_digits(number: Column, digits: int = 3) -> Column:
    """Whole part of a number cut to its leading digits.

    Bounds the distinct values of an open-ended measure: under 20,000 for any 64-bit number, at a
    relative error below 10 ** (1 - digits).
    """
    whole = F.floor(F.abs(number)).cast("bigint")
    # 18 decimal places hold every bigint, so the step stays an exact integer.
    drop = F.greatest(F.length(whole.cast("string")) - F.lit(digits), F.lit(0))
    step = F.rpad(F.lit("1"), drop + F.lit(1), "0").cast("bigint")
    cut = (whole - whole % step)
    return F.when(number < 0, -cut).otherwise(cut)
