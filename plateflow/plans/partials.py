"""Reports from stored day partials, so that a refresh reads the days that changed and no others.

A partial holds, for one arrival day and each group, counts and sums that add up, and the set of distinct
values of one column as bitmaps.  Values get numbers from a dictionary that only grows: values are dealt
to ``SHARDS`` by hash, and each shard numbers its own from 1 on.  A bitmap stands for 32,768 numbers of a
shard.  Bitmaps of several days are merged by or, so distinct counts over any window are exact.

Numbers of new values follow the days on which they came, so the values of a day lie close together and
fill few bitmaps.  A day is stored as a whole and replaces itself; the dictionary is written before the
days that use it, so a refresh that fails half-way can simply be repeated.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plateflow.functions.measures import percent, ratio
from plateflow.operators.windows import optional_window
from plateflow.schema import ARRIVAL_PARTITIONS, DEVICE_TYPES
from plateflow.sources.files import Folder

DAY = list(ARRIVAL_PARTITIONS[:3])
SHARDS = 16
DICTIONARY, DAYS = "dictionary", "days"

DICTIONARY_SCHEMA = T.StructType(
    [
        T.StructField("value", T.StringType()),
        T.StructField("number", T.LongType()),
        T.StructField("shard", T.IntegerType()),
    ]
)


@dataclass(frozen=True)
class Partial:
    """What is kept of each day: groups, sums by name, and the column whose distinct values count."""

    groups: tuple[str, ...]
    distinct: str
    sums: tuple[str, ...] = ()

    @property
    def totals(self) -> list[str]:
        """Columns that add up over days: events, and of each summed column the sum and its rows."""
        return ["event_count", *(f"{name}_sum" for name in self.sums), *(f"{name}_known" for name in self.sums)]

    @property
    def schema(self) -> T.StructType:
        return T.StructType(
            [
                *(T.StructField(name, T.StringType()) for name in self.groups),
                T.StructField("event_count", T.LongType()),
                *(T.StructField(f"{name}_sum", T.DoubleType()) for name in self.sums),
                *(T.StructField(f"{name}_known", T.LongType()) for name in self.sums),
                T.StructField("shard", T.IntegerType()),
                T.StructField("bucket", T.LongType()),
                T.StructField("bits", T.BinaryType()),
                *(T.StructField(name, T.StringType()) for name in DAY),
            ]
        )


DEVICE_SESSIONS = Partial(("restaurant_id", "device_type"), "session_id")
CATEGORY_ITEMS = Partial(("category", "event_type"), "menu_item_id", ("price",))


def _shard(value: Column) -> Column:
    return F.pmod(F.xxhash64(value), F.lit(SHARDS)).cast("int")


def _stored(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    if not Folder(spark, path).exists():
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def _grow_dictionary(events: DataFrame, path: str, column: str) -> None:
    """Number the values that the dictionary doesn't have, in the order of their first days."""
    spark = events.sparkSession
    known = _stored(spark, path, DICTIONARY_SCHEMA)
    values = (
        events.filter(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("value"))
        .agg(F.min(F.concat_ws("-", *DAY)).alias("first_day"))
    )
    new = values.join(known, "value", "left_anti").withColumn("shard", _shard(F.col("value")))
    highest = known.groupBy("shard").agg(F.max("number").alias("highest"))
    in_order = Window.partitionBy("shard").orderBy("first_day", "value")
    numbered = new.join(F.broadcast(highest), "shard", "left").select(
        "value",
        (F.coalesce("highest", F.lit(0)) + F.row_number().over(in_order)).alias("number"),
        "shard",
    )
    numbered.write.mode("append").partitionBy("shard").parquet(path)


def store_days(
    events: DataFrame, path: str, partial: Partial, as_of: date | str | None = None, days: int | None = None
) -> None:
    """Store the partials of the arrival days of a window, or of all days; each replaces itself."""
    spark = events.sparkSession
    rows = optional_window(events, as_of, days).select(*DAY, *partial.groups, partial.distinct, *partial.sums)
    _grow_dictionary(rows, f"{path}/{DICTIONARY}", partial.distinct)
    known = _stored(spark, f"{path}/{DICTIONARY}", DICTIONARY_SCHEMA)
    keys = [*DAY, *partial.groups]
    sums = [F.sum(name).alias(f"{name}_sum") for name in partial.sums]
    sums += [F.count(name).alias(f"{name}_known") for name in partial.sums]
    # One row a day, group and value meets the dictionary, however many events it stands for.
    values = rows.groupBy(*keys, F.col(partial.distinct).alias("value")).agg(
        F.count("*").alias("event_count"), *sums
    )
    numbered = values.join(known, "value", "left").select(
        "*", F.bitmap_bucket_number("number").alias("bucket"), F.bitmap_bit_position("number").alias("bit")
    )
    made = numbered.groupBy(*keys, "shard", "bucket").agg(
        *(F.sum(name).alias(name) for name in partial.totals),
        F.bitmap_construct_agg("bit").alias("bits"),
    )
    writer = made.select(*partial.schema.names).repartition(*DAY).write.mode("overwrite")
    writer.option("partitionOverwriteMode", "dynamic").partitionBy(*DAY).parquet(f"{path}/{DAYS}")


def merged_days(
    spark: SparkSession,
    path: str,
    partial: Partial,
    as_of: date | str | None = None,
    days: int | None = None,
) -> DataFrame:
    """Groups of an arrival window, or of all days: event count, sums and distinct values."""
    rows = optional_window(_stored(spark, f"{path}/{DAYS}", partial.schema), as_of, days)
    merged = rows.groupBy(*partial.groups, "shard", "bucket").agg(
        *(F.sum(name).alias(name) for name in partial.totals), F.bitmap_or_agg("bits").alias("bits")
    )
    # A null value has no number: its rows count as events and in no bitmap.
    held = F.when(F.col("bucket").isNotNull(), F.bitmap_count("bits")).otherwise(0)
    return merged.groupBy(*partial.groups).agg(
        *(F.sum(name).alias(name) for name in partial.totals), F.sum(held).alias("distinct_count")
    )


def device_breakdown_stored(
    spark: SparkSession, path: str, as_of: date | str | None = None, days: int = 7
) -> DataFrame:
    """The device breakdown of a window from the partials ``DEVICE_SESSIONS``."""
    counts = merged_days(spark, path, DEVICE_SESSIONS, as_of, days)
    total = F.sum("event_count").over(Window.partitionBy("restaurant_id"))
    return counts.select(
        "restaurant_id",
        "device_type",
        "event_count",
        percent(F.col("event_count"), total).alias("percentage_of_restaurant_total"),
        F.col("distinct_count").alias("unique_sessions"),
    ).orderBy("restaurant_id", F.desc("event_count"), "device_type")


def restaurant_device_pivot_stored(
    spark: SparkSession, path: str, as_of: date | str | None = None, days: int | None = None
) -> DataFrame:
    """Events and distinct sessions of each restaurant's devices, from ``DEVICE_SESSIONS``."""
    grid = (
        merged_days(spark, path, DEVICE_SESSIONS, as_of, days)
        .groupBy("restaurant_id")
        .pivot("device_type", list(DEVICE_TYPES))
        .agg(F.sum("event_count").alias("events"), F.sum("distinct_count").alias("sessions"))
    )
    return grid.fillna(0, subset=[name for name in grid.columns if name != "restaurant_id"])


def category_analysis_stored(
    spark: SparkSession, path: str, as_of: date | str | None = None, days: int = 30
) -> DataFrame:
    """The category analysis of a window from the partials ``CATEGORY_ITEMS``."""
    stats = merged_days(spark, path, CATEGORY_ITEMS, as_of, days)
    of_category = Window.partitionBy("category")

    def total(name: str) -> Column:
        return F.sum(F.when(F.col("event_type") == name, F.col("event_count"))).over(of_category)

    rate = ratio(F.coalesce(total("order"), F.lit(0)), total("view"), 4)
    return stats.select(
        "category",
        "event_type",
        "event_count",
        F.col("distinct_count").alias("unique_items"),
        F.round(F.coalesce("price_sum", F.lit(0.0)), 2).alias("total_revenue"),
        F.round(F.col("price_sum") / F.nullif(F.col("price_known"), F.lit(0)), 2).alias("avg_price"),
        F.when(F.col("category").isNotNull(), rate).alias("conversion_rate"),
    ).orderBy("category", "event_type")


#: Reports over stored days, with the partials that they read.
STORED_REPORTS: Mapping[str, tuple] = {
    "device_breakdown": (device_breakdown_stored, DEVICE_SESSIONS),
    "restaurant_device_pivot": (restaurant_device_pivot_stored, DEVICE_SESSIONS),
    "category_analysis": (category_analysis_stored, CATEGORY_ITEMS),
}
