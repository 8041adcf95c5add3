"""Schema inference over arrival hours, and a log of how the payloads' schema changes.

Each closed hour is inferred once: the type of each member over all payload objects of the hour.  These
rows, some per hour, are stored by day; a day stored again replaces itself.  The log is derived from
them: the schema of an hour is merged with all before, and each hour that adds a member, changes a
member's type, or no longer has or has again a known one makes rows of the log.  Additions and changes
of type start a new version; missing members are logged and stay in the schema.  Nothing here changes a
table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plateflow.schema import ARRIVAL_PARTITIONS
from plateflow.sources.files import Folder

DAY, HOUR = list(ARRIVAL_PARTITIONS[:3]), list(ARRIVAL_PARTITIONS)

# Kinds of JSON values as bits; a member with several of them is mixed, one with nulls alone has none.
KINDS = {"number": 1, "string": 2, "boolean": 4, "array": 8, "object": 16}
MIXED, NOTHING = "mixed", "null"
COLUMN_TYPES = {"number": "double", "string": "string", "boolean": "boolean", NOTHING: "string"}
ADDED, TYPE, MISSING, RETURNED = "added", "type", "missing", "returned"

HOURLY_SCHEMA = T.StructType(
    [
        T.StructField("column", T.StringType()),
        T.StructField("type", T.StringType()),
        T.StructField("kinds", T.IntegerType()),
        T.StructField("payloads", T.LongType()),
        *(T.StructField(name, T.StringType()) for name in reversed(HOUR)),
    ]
)


def _kinds(variant_type: Column) -> Column:
    """Bits of a variant type's text."""
    found = F.when(variant_type == "VOID", 0)
    for kind, prefix in (("string", "STRING"), ("boolean", "BOOLEAN"), ("array", "ARRAY<"), ("object", "OBJECT<")):
        found = found.when(variant_type.startswith(prefix), KINDS[kind])
    found = found.when(variant_type == "VARIANT", sum(KINDS.values()))
    return found.otherwise(KINDS["number"])


def _kind_name(kinds: Column) -> Column:
    name = F.when(kinds == 0, NOTHING)
    for kind, bit in KINDS.items():
        name = name.when(kinds == bit, kind)
    return name.otherwise(MIXED)


def hourly_schemas(payloads: DataFrame) -> DataFrame:
    """Members of the payload objects of each arrival hour: merged type, kinds, and objects with it.

    Members are counted and merged before the shuffle, so an hour with many payloads is some rows a task.
    """
    members = payloads.filter(F.col("payload").isNotNull()).select(
        *HOUR, F.explode(F.col("payload").cast("map<string,variant>")).alias("column", "value")
    )
    merged = members.groupBy(*HOUR, "column").agg(
        F.schema_of_variant_agg("value").alias("type"), F.count("*").alias("payloads")
    )
    return merged.withColumn("kinds", _kinds(F.col("type"))).select(*HOURLY_SCHEMA.names)


def store_hourly_schemas(payloads: DataFrame, path: str) -> None:
    """Infer the hours of some whole days and store them below ``path``.

    A day that is stored replaces what was there for it, so a repeat changes nothing.
    """
    rows = hourly_schemas(payloads).select(*[name for name in HOURLY_SCHEMA.names if name not in DAY], *DAY)
    writer = rows.repartition(*DAY).write.option("partitionOverwriteMode", "dynamic").partitionBy(*DAY)
    writer.mode("overwrite").parquet(path)


def read_hourly_schemas(spark: SparkSession, path: str) -> DataFrame:
    if not Folder(spark, path).exists():
        return spark.createDataFrame([], HOURLY_SCHEMA)
    return spark.read.schema(HOURLY_SCHEMA).parquet(path)


def schema_changes(hours: DataFrame) -> DataFrame:
    """``version``, hour, ``column, change, old_type, new_type`` of each change of the merged schema.

    Works on the rows of ``hourly_schemas``, a few per hour, whatever the payloads.
    """
    moment = F.concat_ws("-", *HOUR)
    numbered = (
        hours.select(moment.alias("hour_key"))
        .distinct()
        .withColumn("number", F.row_number().over(Window.orderBy("hour_key")))
    )
    seen = hours.select("column", "kinds", moment.alias("hour_key")).join(numbered, "hour_key")
    of_column = Window.partitionBy("column").orderBy("number")
    merged = seen.select(
        "column",
        "number",
        F.bit_or("kinds").over(of_column.rowsBetween(Window.unboundedPreceding, 0)).alias("now"),
        F.bit_or("kinds").over(of_column.rowsBetween(Window.unboundedPreceding, -1)).alias("before"),
        F.lag("number").over(of_column).alias("last_seen"),
        F.coalesce(F.lead("number").over(of_column), F.lit(0)).alias("next_seen"),
    )
    old, new = _kind_name(F.col("before")), _kind_name(F.col("now"))
    grown = (
        F.when(F.col("before").isNull(), ADDED)
        .when(old != new, TYPE)
        .when(F.col("last_seen") < F.col("number") - 1, RETURNED)
    )
    # A member is missing from the hour after the last one with it.
    found = merged.select("column", "number", grown.alias("change"), old.alias("old_type"), new.alias("new_type"))
    gone = merged.filter(F.col("next_seen") != F.col("number") + 1).select(
        "column",
        (F.col("number") + 1).alias("number"),
        F.lit(MISSING).alias("change"),
        new.alias("old_type"),
        F.lit(None).cast("string").alias("new_type"),
    )
    changes = found.filter("change IS NOT NULL").withColumn(
        "old_type", F.when(F.col("change") != ADDED, F.col("old_type"))
    )
    listed = changes.unionByName(gone).join(numbered, "number")
    starts = F.max(F.col("change").isin(ADDED, TYPE).cast("int")).over(Window.partitionBy("number"))
    marked = listed.withColumn("starts", starts)
    # Hours with a new version are numbered among themselves.
    versions = marked.filter("starts = 1").select("number").distinct()
    versions = versions.withColumn("version", F.row_number().over(Window.orderBy("number")))
    through = Window.orderBy("number").rowsBetween(Window.unboundedPreceding, 0)
    current = numbered.join(versions, "number", "left").select(
        "number", F.max("version").over(through).alias("version")
    )
    parts = {name: F.split("hour_key", "-")[k] for k, name in enumerate(HOUR)}
    return marked.join(current, "number").select(
        "version", *(part.alias(name) for name, part in parts.items()), "column", "change", "old_type", "new_type"
    )


def schema_of_version(changes: DataFrame, version: int) -> str:
    """The schema after a version as DDL, for a reader of the payloads; members by name."""
    grown = changes.filter(F.col("change").isin(ADDED, TYPE) & (F.col("version") <= version))
    last = grown.groupBy("column").agg(F.max_by("new_type", F.struct("version")).alias("type"))
    rows = sorted((row["column"], row["type"]) for row in last.collect())
    quoted = ((name.replace("`", "``"), COLUMN_TYPES.get(kind, "variant")) for name, kind in rows)
    return ", ".join(f"`{name}` {column_type}" for name, column_type in quoted)
