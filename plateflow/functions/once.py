"""Columns that are evaluated once per row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_columns_once(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Add costly columns through a one-row generator.

    A filter on a plain computed column is moved below the projection, which repeats the whole
    expression.  Filters on generated columns stay above and use the result.
    """
    kept = [name for name in df.columns if name not in columns]
    return df.select(*kept, F.stack(F.lit(1), *columns.values()).alias(*columns))
