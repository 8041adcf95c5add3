"""Clock skew from stored sketches, for any window without a look at its events.

Each arrival hour keeps, per device, counts that add up and a KLL sketch of the skew.  Sketches of the
hours of a window are merged; merging keeps their error.  With ``K`` the rank of a quantile is off by
less than ``RANK_ERROR`` of the rows, with a chance of about 99 percent; the counts are exact.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plateflow.operators.windows import optional_window
from plateflow.schema import ARRIVAL_PARTITIONS
from plateflow.sources.files import Folder

DAY, HOUR = list(ARRIVAL_PARTITIONS[:3]), list(ARRIVAL_PARTITIONS)
K = 800
RANK_ERROR = 0.005

SKETCH_SCHEMA = T.StructType(
    [
        T.StructField("device_type", T.StringType()),
        T.StructField("events", T.LongType()),
        T.StructField("unparsed", T.LongType()),
        T.StructField("low", T.LongType()),
        T.StructField("high", T.LongType()),
        T.StructField("negative", T.LongType()),
        T.StructField("sketch", T.BinaryType()),
        *(T.StructField(name, T.StringType()) for name in reversed(HOUR)),
    ]
)


def hourly_skew(events: DataFrame) -> DataFrame:
    """Counts, bounds and sketch of the skew in microseconds, by arrival hour and device."""
    skew = F.unix_micros("ingested_at") - F.unix_micros("event_ts")
    return (
        events.select(*HOUR, "device_type", skew.alias("skew"))
        .groupBy(*HOUR, "device_type")
        .agg(
            F.count("*").alias("events"),
            F.count_if(F.col("skew").isNull()).alias("unparsed"),
            F.min("skew").alias("low"),
            F.max("skew").alias("high"),
            F.count_if(F.col("skew") < 0).alias("negative"),
            F.kll_sketch_agg_bigint("skew", K).alias("sketch"),
        )
        .select(*SKETCH_SCHEMA.names)
    )


def store_hourly_skew(events: DataFrame, path: str, as_of: date | str | None = None, days: int | None = None) -> None:
    """Store the hours of an arrival window, or of all days; each day replaces itself."""
    rows = hourly_skew(optional_window(events, as_of, days))
    columns = [name for name in SKETCH_SCHEMA.names if name not in DAY]
    writer = rows.select(*columns, *DAY).repartition(*DAY).write.mode("overwrite")
    writer.option("partitionOverwriteMode", "dynamic").partitionBy(*DAY).parquet(path)


def clock_skew_stored(
    spark: SparkSession,
    path: str,
    as_of: date | str | None = None,
    days: int | None = None,
    quantile: float = 0.95,
) -> DataFrame:
    """The columns of the clock skew report from stored hours, its percentile from merged sketches."""
    if Folder(spark, path).exists():
        hours = spark.read.schema(SKETCH_SCHEMA).parquet(path)
    else:
        hours = spark.createDataFrame([], SKETCH_SCHEMA)
    merged = optional_window(hours, as_of, days).groupBy("device_type").agg(
        F.sum("events").alias("events"),
        F.sum("unparsed").alias("unparsed"),
        (F.min("low") / 1e6).alias("min_skew_s"),
        (F.max("high") / 1e6).alias("max_skew_s"),
        F.sum("negative").alias("negative"),
        F.kll_merge_agg_bigint("sketch").alias("sketch"),
    )
    known = F.col("events") > F.col("unparsed")
    at = F.kll_sketch_get_quantile_bigint("sketch", F.lit(quantile)) / 1e6
    return merged.select(
        "device_type", "events", "unparsed", "min_skew_s", "max_skew_s",
        F.when(known, at).alias("p95_skew_s"), "negative",
    )
