"""The event lake and the quarantine: folders by arrival hour, with notes of writes and compactions.

A write is staged and then moved into the hour folders; its key is a column of its rows.  The notes of
``plateflow.sources.notes`` say which writes are done: one that is done isn't repeated, even if its files
have been merged since, and one that was interrupted is undone first.  Writes with different keys never
touch each other's files.  ``compact_hours`` merges the files of closed hours.  The readers here see each
write and each compaction at once or not at all; readers of the folders alone see files as they come.
"""

from __future__ import annotations

from datetime import date, datetime, timedelta
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plateflow.functions.json_text import (
    members_except,
    number_of,
    object_fields,
    variant_text,
    with_parsed_json,
)
from plateflow.functions.temporal import parse_iso_timestamp
from plateflow.operators.enrichment import event_records, quarantine_records
from plateflow.schema import (
    ARRIVAL_PARTITIONS,
    EVENT_COLUMNS,
    EVENT_SCHEMA,
    QUARANTINE_SCHEMA,
    REQUIRED_FIELDS,
    SERVER_FIELDS,
    WRITE_KEY,
)
from plateflow.sources.files import Folder
from plateflow.sources.notes import LakeNotes

# File layout.
DEFAULT_FORMAT = "parquet"
COMPRESSION = {"json": "gzip", "parquet": "zstd"}
TIMESTAMP_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"

# Rows of a file at most.
FILE_ROWS = 2_000_000
COMPACTED = "compacted-"
# Times that a reader lists a lake which changes meanwhile.
LISTINGS = 10


def _land(records: DataFrame, path: str, partitions: list[str], key: str, file_format: str) -> None:
    notes = LakeNotes(records.sparkSession, path)
    if notes.is_done(key):
        return
    notes.undo(key)
    _writer(records, partitions, file_format).save(f"{notes.lake.path}/{notes.staged(key)}")
    notes.publish(key)


def _writer(records: DataFrame, partitions: list[str], file_format: str):
    writer = (
        records.write.format(file_format)
        .option("compression", COMPRESSION[file_format])
        .option("maxRecordsPerFile", FILE_ROWS)
        .partitionBy(*partitions)
    )
    return writer.option("timestampFormat", TIMESTAMP_FORMAT) if file_format == "json" else writer


def _gathered(records: DataFrame, partitions: list[str]) -> DataFrame:
    """Rows of a folder together, so that it gets few files.  Adaptive execution splits a folder
    that is much larger than the others over several tasks."""
    return records.hint("rebalance", *partitions)


def land_events(
    validated: DataFrame,
    path: str,
    write_key: str = "0",
    file_format: str = DEFAULT_FORMAT,
    one_hour: bool = False,
) -> None:
    """Write the accepted rows of enriched, validated payloads below ``path``.

    Rows of ``one_hour`` all go to one folder and are evened out to files of the advisory size; rows
    of many hours are gathered by folder.
    """
    partitions = list(ARRIVAL_PARTITIONS)
    keyed = event_records(validated).withColumn(WRITE_KEY, F.lit(str(write_key)))
    rows = keyed.hint("rebalance") if one_hour else _gathered(keyed, partitions)
    _land(rows, path, partitions, str(write_key), file_format)


def land_rejects(
    validated: DataFrame, path: str, write_key: str = "0", file_format: str = DEFAULT_FORMAT
) -> None:
    """Write the rejected rows below ``path``, with the error type as a further folder level."""
    partitions = [*ARRIVAL_PARTITIONS, "error_type"]
    keyed = quarantine_records(validated).withColumn(WRITE_KEY, F.lit(str(write_key)))
    _land(_gathered(keyed, partitions), path, partitions, str(write_key), file_format)


def hour_folder(moment: datetime) -> str:
    return f"{moment:year=%Y/month=%m/day=%d/hour=%H}"


def hours_between(since: datetime, until: datetime) -> list[datetime]:
    """The hours that a span touches, from the one of ``since`` up to, not including, ``until``."""
    first = since.replace(minute=0, second=0, microsecond=0)
    count = -((first - until) // timedelta(hours=1))
    return [first + timedelta(hours=n) for n in range(count)]


def compact_hours(
    spark: SparkSession,
    path: str,
    since: datetime,
    until: datetime,
    file_format: str = DEFAULT_FORMAT,
    grace: timedelta = timedelta(0),
) -> int:
    """Merge the files of each arrival hour that the span from ``since`` to ``until`` touches.

    Only for closed hours, to which no batch can return.  One Spark job rewrites all hours into the
    staging folder, large ones by several tasks.  The files it replaces are deleted by the first run
    that comes ``grace`` after; until then a reader that began before can go on reading them.  A run
    ends what an interrupted one has left.  Files of writes that aren't done are not touched.  Returns
    the hours merged.
    """
    notes = LakeNotes(spark, path)
    lake = notes.lake
    notes.finish(grace)
    found = [f"{lake.path}/{hour}" for hour in map(hour_folder, hours_between(since, until)) if lake.exists(hour)]
    if not found:
        return 0
    listed = spark.read.format("binaryFile").option("basePath", lake.path).load(found)
    hidden = set(notes.hidden())
    by_hour: dict[tuple, list[str]] = {}
    for file in listed.select("path", *ARRIVAL_PARTITIONS).collect():
        if file["path"].rpartition("/")[2] not in hidden:
            by_hour.setdefault(tuple(file[name] for name in ARRIVAL_PARTITIONS), []).append(file["path"])
    old = [name for names in by_hour.values() if len(names) > 1 for name in names]
    if not old:
        return 0
    rows = _reader(spark, EVENT_SCHEMA, file_format).option("basePath", lake.path).load(old)
    note = uuid4().hex
    partitions = list(ARRIVAL_PARTITIONS)
    _writer(_gathered(rows, partitions), partitions, file_format).save(f"{lake.path}/{notes.staged(note)}")
    notes.replace(note, old, COMPACTED)
    notes.finish(grace)
    return sum(len(names) > 1 for names in by_hour.values())


def _reader(spark: SparkSession, schema: T.StructType, file_format: str):
    reader = spark.read.schema(schema).format(file_format)
    return reader.option("timestampFormat", TIMESTAMP_FORMAT) if file_format == "json" else reader


def visible(rows: DataFrame, path: str) -> DataFrame:
    """Rows of a lake without the files that its notes hide now."""
    hidden = LakeNotes(rows.sparkSession, path).hidden()
    return rows.filter(~F.col("_metadata.file_name").isin(hidden)) if hidden else rows


def _read(
    spark: SparkSession, path: str, schema: T.StructType, file_format: str, folders: list[str] | None = None
) -> DataFrame:
    """The lake, or some of its folders, as of one moment: listed again if a write or a compaction took
    a step meanwhile."""
    notes = LakeNotes(spark, path)
    reader = _reader(spark, schema, file_format)
    for _ in range(LISTINGS):
        before = notes.state()
        rows = reader.load(path) if folders is None else reader.option("basePath", path).load(folders)
        shown = visible(rows, path)
        if notes.state() == before:
            return shown
    raise TimeoutError(f"{path} changed while it was listed, {LISTINGS} times")


def read_window(
    spark: SparkSession,
    path: str,
    first: date,
    last: date,
    file_format: str = DEFAULT_FORMAT,
) -> DataFrame:
    """Events that arrived on the days given, with their write key; only these folders are listed."""
    days = [first + timedelta(days=n) for n in range((last - first).days + 1)]
    lake = Folder(spark, path)
    found = [day for day in (f"{d:year=%Y/month=%m/day=%d}" for d in days) if lake.exists(day)]
    if not found:
        return spark.createDataFrame([], EVENT_SCHEMA)
    return _read(spark, path, EVENT_SCHEMA, file_format, [f"{lake.path}/{day}" for day in found])


def read_written(
    spark: SparkSession, path: str, file_format: str = DEFAULT_FORMAT
) -> DataFrame:
    """Events with the key of the write that landed them."""
    return _read(spark, path, EVENT_SCHEMA, file_format)


def read_events(
    spark: SparkSession, path: str, file_format: str = DEFAULT_FORMAT
) -> DataFrame:
    """Events landed by :func:`land_events`.  The schema is given, so ``03`` stays ``03``."""
    return read_written(spark, path, file_format).drop(WRITE_KEY)


def read_quarantine(
    spark: SparkSession, path: str, file_format: str = DEFAULT_FORMAT
) -> DataFrame:
    return _read(spark, path, QUARANTINE_SCHEMA, file_format).drop(WRITE_KEY)


def read_flat_events(spark: SparkSession, path: str) -> DataFrame:
    """Events of a JSON lake written by another producer: whole payloads plus ``ingested_at``.

    Prices may be numeric strings, and unknown fields stand beside the known ones; both come out as
    in :func:`read_events`.
    """
    names = REQUIRED_FIELDS + SERVER_FIELDS
    partitions = [T.StructField(name, T.StringType()) for name in ARRIVAL_PARTITIONS]
    schema = T.StructType([T.StructField("value", T.StringType()), *partitions])
    lines = with_parsed_json(spark.read.schema(schema).text(path), "payload", F.col("value"))
    members = lines.withColumn("_members", object_fields(F.col("payload"), names))
    typed = members.withColumns(
        {
            name: number_of(F.col("_members")[name], variant_text(F.col("_members")[name]))
            if name == "price"
            else variant_text(F.col("_members")[name])
            for name in names
        }
    )
    return typed.withColumns(
        {
            "event_ts": parse_iso_timestamp(F.col("timestamp")),
            "ingested_at": parse_iso_timestamp(F.col("ingested_at")),
            "extra": members_except(F.col("payload"), names),
        }
    ).select(*EVENT_COLUMNS, *ARRIVAL_PARTITIONS)
