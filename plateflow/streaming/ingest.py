"""Continuous ingest: payload stream to event lake and quarantine."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from plateflow.functions.json_text import members_except
from plateflow.functions.temporal import arrival_columns
from plateflow.operators.enrichment import enrich
from plateflow.operators.validation import ACCEPTED, accepted_events, rejected_events, validate_events
from plateflow.schema import ARRIVAL_PARTITIONS, REQUIRED_FIELDS, SERVER_FIELDS, WRITE_KEY
from plateflow.sources.catalog import register_partitions
from plateflow.sources.lake import DEFAULT_FORMAT, land_events, land_rejects, read_window

# Fixed value: buffering of the delivery stage.
FLUSH_INTERVAL = "60 seconds"

# State that outgrows memory is kept on the executors' disks, with its changes in the checkpoint.
STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKS_DB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

# Shuffle files go when a batch or its write ends, not when the driver next collects its garbage; a
# state store allocates no megabytes in advance, which many stores would multiply, and packs its files.
DISK_SETTINGS = {
    "spark.sql.streaming.stateStore.rocksdb.compression": "zstd",
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
}

OBSERVATION = "ingest"
HOUR_FOLDER = "yyyy-MM-dd-HH"


@dataclass(frozen=True)
class IngestTarget:
    """Where a stream lands.  ``table`` is a catalog table over ``events``, if there is one."""

    events: str
    quarantine: str
    checkpoint: str
    file_format: str = DEFAULT_FORMAT
    table: str | None = None


def judged_stream(payloads: DataFrame, now: Column | None = None) -> DataFrame:
    """Arrival stamp and verdict for each payload, with running counts for progress reports."""
    judged = validate_events(enrich(payloads, now))
    return judged.observe(
        OBSERVATION,
        F.count("*").alias("received"),
        F.count_if(F.col("status") == ACCEPTED).alias("accepted"),
        F.count_if(F.col("status") != ACCEPTED).alias("rejected"),
    )


def drop_repeated_ids(
    judged: DataFrame, landed: DataFrame | None = None, write_key: str | None = None
) -> DataFrame:
    """Keep one accepted row per ``event_id`` that no other write has landed; rejects are untouched.

    Of repeats the one with the least text stays, so a batch that runs again lands the same rows.  The
    choice is an aggregate over ids and texts, merged before the shuffle, so an id that fills much of
    the batch costs one row per task.
    """
    accepted = accepted_events(judged)
    columns = [name for name in accepted.columns if name != "event_id"]
    first = F.min_by(F.struct(*columns), "value").alias("row")
    chosen = accepted.groupBy("event_id").agg(first).select("event_id", "row.*").select(*accepted.columns)
    if landed is not None:
        earlier = landed.filter(F.col(WRITE_KEY) != write_key).select("event_id")
        chosen = chosen.join(earlier, "event_id", "left_anti")
    return chosen.unionByName(rejected_events(judged))


def landed_parts(judged: DataFrame) -> DataFrame:
    """The same columns with only what lands in them: of accepted rows the fields and the unknown members
    of the payload, of rejected rows the text and the ids."""
    accepted = F.col("status") == ACCEPTED
    fields = [name for name in REQUIRED_FIELDS if name not in ("event_id", "restaurant_id")]
    unknown = members_except(F.col("payload"), REQUIRED_FIELDS + SERVER_FIELDS)
    return judged.withColumns(
        {
            "value": F.when(accepted, "").otherwise(F.col("value")),
            "payload": F.when(accepted, unknown),
            **{name: F.when(accepted, F.col(name)) for name in fields},
        }
    )


def first_within(judged: DataFrame, delay: str) -> DataFrame:
    """Of accepted rows with the same id, within ``delay`` of arrival, the first; rejects are untouched.

    The state holds one key per id until a batch has moved the watermark past its arrival and the delay,
    whatever the lake holds; a repeat in between is dropped as well.  Rejects have keys of their own, which leave the state the same way.
    A second branch for rejects would keep them out of it, but be a second source, which no checkpoint has.
    Partition columns follow from the arrival, so they stay out of the shuffle.
    """
    own = F.concat(F.lit("id-"), F.col("event_id"))
    # The 16 bytes of a UUID in 24 characters.
    random = F.base64(F.unhex(F.replace(F.uuid(), F.lit("-"))))
    key = F.when(F.col("status") == ACCEPTED, own).otherwise(F.concat(F.lit("row-"), random))
    first = (
        judged.drop(*ARRIVAL_PARTITIONS)
        .withColumn("_key", key)
        .withWatermark("ingested_at", delay)
        .dropDuplicatesWithinWatermark(["_key"])
        .drop("_key")
    )
    return first.withColumns(arrival_columns(F.col("ingested_at"))).select(*judged.columns)


def landed_ids(target: IngestTarget, batch: DataFrame, hours: int) -> DataFrame:
    """Ids in the lake from the arrival hours of ``batch`` and the ``hours`` before them."""
    span = batch.agg(
        (F.min("ingested_at") - F.make_dt_interval(hours=F.lit(hours))).alias("first"),
        F.max("ingested_at").alias("last"),
    ).select(
        *(F.date_format(name, HOUR_FOLDER).alias(f"{name}_hour") for name in ("first", "last")),
        *(F.to_date(name).alias(f"{name}_day") for name in ("first", "last")),
    ).first()
    if span["first_day"] is None:
        return batch.select("event_id", F.lit("").alias(WRITE_KEY)).limit(0)
    lake = read_window(
        batch.sparkSession, target.events, span["first_day"], span["last_day"], target.file_format
    )
    folder = F.concat_ws("-", *ARRIVAL_PARTITIONS)
    return lake.filter(folder.between(span["first_hour"], span["last_hour"])).select("event_id", WRITE_KEY)


def land_batch(target: IngestTarget, dedup_hours: int | None = None, one_hour: bool = True):
    """The ``foreachBatch`` function: both sinks from one evaluation of the batch.

    Every row written carries the batch id, so running a batch again after a failure replaces
    exactly what the first attempt wrote.  Rows stamped by the batch time share one hour.
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        key = f"{batch_id:08d}"
        judged = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            rows = judged
            if dedup_hours is not None:
                rows = drop_repeated_ids(judged, landed_ids(target, judged, dedup_hours), key)
            land_events(rows, target.events, key, target.file_format, one_hour)
            land_rejects(judged, target.quarantine, key, target.file_format)
            if target.table is not None:
                hours = accepted_events(rows).select(*ARRIVAL_PARTITIONS).distinct().collect()
                register_partitions(batch.sparkSession, target.table, [h.asDict() for h in hours])
        finally:
            judged.unpersist()

    return run


@contextmanager
def _settings(spark: SparkSession, settings: dict[str, str]) -> Iterator[None]:
    """Settings of the streams started meanwhile, which keep a copy; those of the session are put back."""
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def start_ingest(
    payloads: DataFrame,
    target: IngestTarget,
    interval: str = FLUSH_INTERVAL,
    available_now: bool = False,
    dedup_hours: int | None = None,
    now: Column | None = None,
    dedup_within: str | None = None,
) -> StreamingQuery:
    """Start the ingest of a payload stream.

    A batch starts every ``interval``; ``available_now`` takes what is there and stops.
    ``dedup_hours`` drops ids that already landed within so many arrival hours, which it looks up in the
    lake; ``dedup_within``, such as ``2 hours``, drops those that this stream has seen, from its state.  A
    failing sink fails the batch, and the checkpoint runs it again.
    """
    judged = judged_stream(payloads, now)
    if dedup_hours is None:
        judged = landed_parts(judged)
    if dedup_within is not None:
        payloads.sparkSession.conf.set(STATE_STORE, ROCKS_DB)
        judged = first_within(judged, dedup_within)
    writer = (
        judged.writeStream.queryName("plateflow-ingest")
        .option("checkpointLocation", target.checkpoint)
        .foreachBatch(land_batch(target, dedup_hours, one_hour=now is None))
    )
    trigger = {"availableNow": True} if available_now else {"processingTime": interval}
    with _settings(payloads.sparkSession, DISK_SETTINGS):
        return writer.trigger(**trigger).start()
