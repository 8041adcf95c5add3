"""Catalog registration of a landed lake and schema drift."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plateflow.schema import (
    ARRIVAL_PARTITIONS,
    EVENT_SCHEMA,
    QUARANTINE_SCHEMA,
    REQUIRED_FIELDS,
    WRITE_KEY,
)
from plateflow.sources.files import Folder
from plateflow.sources.lake import (
    DEFAULT_FORMAT,
    TIMESTAMP_FORMAT,
    hour_folder,
    hours_between,
    visible,
)


def _quote(name: str) -> str:
    return ".".join("`" + part.replace("`", "``") + "`" for part in name.split("."))


def _literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _create(
    spark: SparkSession, table: str, path: str, schema: T.StructType, folders: list[str], file_format: str
) -> None:
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    options = (
        f"OPTIONS (timestampFormat {_literal(TIMESTAMP_FORMAT)})" if file_format == "json" else ""
    )
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {_quote(table)} ({columns}) USING {file_format} {options} "
        f"PARTITIONED BY ({', '.join(folders)}) LOCATION {_literal(path)}"
    )


def create_event_table(
    spark: SparkSession, table: str, path: str, file_format: str = DEFAULT_FORMAT
) -> None:
    """External table over a lake, with the fixed schema; registers no partition yet."""
    _create(spark, table, path, EVENT_SCHEMA, list(ARRIVAL_PARTITIONS), file_format)


def create_quarantine_table(
    spark: SparkSession, table: str, path: str, file_format: str = DEFAULT_FORMAT
) -> None:
    """External table over a quarantine; registers no partition yet."""
    folders = [*ARRIVAL_PARTITIONS, "error_type"]
    _create(spark, table, path, QUARANTINE_SCHEMA, folders, file_format)


def sync_partitions(spark: SparkSession, table: str) -> None:
    """Find and register all folders not yet in the catalog, walking the whole lake.  For repairs;
    known partitions and the table schema stay as they are."""
    spark.catalog.recoverPartitions(table)


def sync_since(spark: SparkSession, table: str, path: str, since: datetime, until: datetime) -> int:
    """Register the folders of the arrival hours that the span from ``since`` to ``until`` touches.

    Looks at these hours only, whatever the size of the lake.  Returns the folders found.
    """
    lake = Folder(spark, path)
    found = []
    for folder in map(hour_folder, hours_between(since, until)):
        deeper = [name for name in lake.names(folder) if name.startswith("error_type=")]
        if deeper:
            found.extend(f"{folder}/{name}" for name in deeper)
        elif lake.exists(folder):
            found.append(folder)
    register_folders(spark, table, found)
    return len(found)


def register_folders(spark: SparkSession, table: str, folders: Iterable[str]) -> None:
    """Register folders given as ``year=2024/month=03/...`` without listing the lake."""
    register_partitions(
        spark, table, [dict(part.split("=", 1) for part in folder.split("/")) for folder in folders]
    )


def register_partitions(
    spark: SparkSession, table: str, partitions: Iterable[Mapping[str, str]]
) -> None:
    """Register the given folders without listing the lake."""
    specs = [
        "PARTITION ("
        + ", ".join(f"`{key}`={_literal(value)}" for key, value in spec.items())
        + ")"
        for spec in partitions
    ]
    if specs:
        spark.sql(f"ALTER TABLE {_quote(table)} ADD IF NOT EXISTS {' '.join(specs)}")


def read_event_table(spark: SparkSession, table: str, database: str | None = None) -> DataFrame:
    """Events of a catalog table, in the given or the current database.

    Its folders are listed anew; writes and compactions that are under way now are hidden.
    """
    name = f"{database}.{table}" if database else table
    spark.catalog.refreshTable(_quote(name))
    details = spark.sql(f"DESCRIBE FORMATTED {_quote(name)}").filter("col_name = 'Location'").first()
    return visible(spark.table(name), details["data_type"]).drop(WRITE_KEY)


def schema_drift(sample: DataFrame, expected: T.StructType = EVENT_SCHEMA) -> DataFrame:
    """``column, kind`` for each column of ``sample`` that is added, missing or of another type.

    Compares schemas only and changes nothing.
    """
    seen = {field.name: field.dataType for field in sample.schema.fields}
    known = {field.name: field.dataType for field in expected.fields}
    kinds = {name: "added" for name in seen if name not in known}
    kinds |= {name: "missing" for name in known if name not in seen}
    kinds |= {name: "type" for name in known if name in seen and seen[name] != known[name]}
    return sample.sparkSession.createDataFrame(
        sorted(kinds.items()), "column string, kind string"
    )


def payload_drift(payloads: DataFrame, expected: Iterable[str] = REQUIRED_FIELDS) -> DataFrame:
    """Drift of the members of all payload objects, with the number of objects that have it.

    Distributed throughout: member names are exploded and counted, never gathered.
    """
    known = list(expected)
    names = payloads.filter(F.col("payload").isNotNull()).select(
        F.explode(F.map_keys(F.col("payload").cast("map<string,variant>"))).alias("column"),
        F.lit(1).alias("n"),
    )
    wanted = payloads.sparkSession.createDataFrame([(name, 0) for name in known], "column string, n int")
    counted = names.unionByName(wanted).groupBy("column").agg(F.sum("n").alias("payloads"))
    added = ~F.col("column").isin(*known)
    return counted.filter(added | (F.col("payloads") == 0)).select(
        "column", "payloads", F.when(added, "added").otherwise("missing").alias("kind")
    )
