"""Helpers that several operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plateflow.sources.scratch import scratch_folder

# Characters between words: space and the five ASCII control characters from tab to carriage return.
SPACES = " \t\n\x0b\f\r"
SPACE_CLASS = r"[\x20\x09-\x0D]"


def materialise(df: DataFrame, name: str, **options: str) -> DataFrame:
    """Write a table to the shared folder and read it back, which cuts lineage.

    The files outlive executors.  The folder goes when the session ends.  ``options`` are the writer's.
    """
    folder = scratch_folder(df.sparkSession, f"llm-{name}")
    df.write.options(**options).parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def space_words(text: Column) -> Column:
    """The words of a text, split at ``SPACES``; an empty array for null and blank texts."""
    inner = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACES))
    return F.when(inner == "", F.array().cast("array<string>")).otherwise(
        F.split(inner, SPACE_CLASS + "+")
    )


def fresh_names(df: DataFrame, *wanted: str) -> list[str]:
    """Column names like the wanted ones that the table doesn't have yet."""
    taken = {name.lower() for name in df.columns}
    names = []
    for name in wanted:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        names.append(name)
    return names


def other_columns(df: DataFrame, *names: str) -> list[str]:
    """Columns of a table except those called like one of the names, in any case of letters."""
    taken = {name.lower() for name in names}
    return [name for name in df.columns if name.lower() not in taken]


def scan(spark, sf_dir: str, table: str) -> DataFrame:
    """One of the given tables, whole."""
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def row_digest(df: DataFrame) -> Column:
    """128 bits of all columns of a row."""
    return F.struct(
        F.xxhash64(*df.columns).alias("high"), F.xxhash64(F.lit("low"), *df.columns).alias("low")
    )
