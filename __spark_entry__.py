
from __future__ import annotations

import os
import sys
from collections.abc import Callable
from datetime import datetime, timedelta
from uuid import uuid4

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import oracle_queries
from plateflow import configure_session
from plateflow.operators.enrichment import enrich, event_records, quarantine_records
from plateflow.operators.validation import acknowledge, validate_events
from plateflow.operators.windows import arrival_window, event_window, of_types
from plateflow.plans.categories import category_analysis_joined
from plateflow.plans.devices import device_platform_mix
from plateflow.plans.health import (
    ingest_error_alarm,
    ingest_rate_5min,
    ingest_summary,
    rejection_summary,
)
from plateflow.plans.partials import STORED_REPORTS, store_days
from plateflow.plans.registry import REPORTS
from plateflow.schema import ARRIVAL_PARTITIONS
from plateflow.plans.rollup import daily_rollup, rolled_up
from plateflow.plans.skew_sketches import RANK_ERROR, clock_skew_stored, store_hourly_skew
from plateflow.plans.sql_functions import call as call_function
from plateflow.plans.sql_functions import register_table_functions
from plateflow.plans.suite import read_report, refresh_report_tables, register_report_view, run_reports
from plateflow.sources.catalog import create_event_table, payload_drift, read_event_table, sync_since
from demo_tables import AS_OF, base_events, clickstream, derive_events, payload_lines
from plateflow.sources.files import Folder
from plateflow.sources.lake import (
    compact_hours,
    land_events,
    land_rejects,
    read_events,
    read_quarantine,
    read_written,
)
from plateflow.sources.payloads import read_payloads
from plateflow.sources.schema_log import read_hourly_schemas, schema_changes, store_hourly_schemas
from plateflow.sources.scratch import scratch_folder
from plateflow.streaming.alarm import alarm_transitions
from plateflow.streaming.flush import FlushPolicy, flushed_ingest
from plateflow.streaming.ingest import IngestTarget, start_ingest
from plateflow.streaming.metrics import start_metric

try:
    import corpus_pipeline
    from plateflow.llm import queries as llm_queries
except ModuleNotFoundError as missing:
    # Without the corpus operators, or a library that only they need, the other queries stay.
    if missing.name.startswith("plateflow") and not missing.name.startswith("plateflow.llm"):
        raise
    corpus_pipeline = llm_queries = None

Query = Callable[[SparkSession, str], DataFrame]

# Besides the default, a threshold that many five-minute windows of small data reach.
LOW_ALARM_ERRORS = 2
# Payloads in a delivered file at most.
FILE_LINES = 20_000


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clickstream(configure_session(spark), sf_dir)


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return payload_lines(base_events(configure_session(spark), sf_dir))


def _packed(lines: DataFrame):
    """A writer of payload files that are compressed, and read by several tasks although they can't be split."""
    return lines.write.option("compression", "gzip").option("maxRecordsPerFile", FILE_LINES)


def _written_lines(spark: SparkSession, sf_dir: str, path: str) -> DataFrame:
    """The payload texts from files, for queries that deliver them several times."""
    _packed(_lines(spark, sf_dir).select("value")).text(path)
    return spark.read.text(path)


def _judged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Validated payloads that keep the arrival time of the test data."""
    return validate_events(enrich(_lines(spark, sf_dir), F.col("ingested_at")))


def _as_text(df: DataFrame) -> DataFrame:
    """VARIANT and date columns as text, which both engines write alike."""
    texts = {}
    if "extra" in df.columns:
        texts["extra"] = F.to_json("extra")
    if "event_date" in df.columns:
        texts["event_date"] = F.col("event_date").cast("string")
    return df.withColumns(texts) if texts else df


def _report(name: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _as_text(REPORTS[name](_events(spark, sf_dir), AS_OF))

    return run


def _over_events(build: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: build(_events(spark, sf_dir))


def _over_judged(build: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: build(_judged(spark, sf_dir))


def _landed(file_format: str) -> Query:
    """Land accepted payloads and read the lake back."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        path = scratch_folder(spark, f"lake-{file_format}")
        land_events(_judged(spark, sf_dir), path, file_format=file_format)
        lake = read_events(spark, path, file_format)
        platform = F.try_variant_get("extra", "$.platform", "string").alias("platform")
        return lake.select(*ARRIVAL_PARTITIONS, "event_id", "event_type", "price", "event_ts", platform)

    return run


def _platform_mix_landed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The platform report over a Parquet lake, whose extras are shredded into columns."""
    path = scratch_folder(spark, "shredded")
    land_events(_judged(spark, sf_dir), path)
    return device_platform_mix(read_events(spark, path))


def _landed_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_folder(spark, "quarantine")
    land_rejects(_judged(spark, sf_dir), path)
    rejects = read_quarantine(spark, path)
    return rejects.select(*ARRIVAL_PARTITIONS, "error_type", "field", "error", "value")


def _two_batches(spark: SparkSession, sf_dir: str) -> str:
    """A lake landed by two writes, the second one twice."""
    path = scratch_folder(spark, "batches")
    judged = _judged(spark, sf_dir)
    for number in (0, 1, 1):
        land_events(judged.filter(F.col("seq") % 2 == number), path, f"{number:08d}")
    return path


def _merged(spark: SparkSession, sf_dir: str) -> str:
    """The lake of two batches after a compaction of all its hours."""
    path = _two_batches(spark, sf_dir)
    span = _judged(spark, sf_dir).agg(F.min("ingested_at").alias("a"), F.max("ingested_at").alias("b")).first()
    compact_hours(spark, path, span["a"], span["b"] + timedelta(hours=1))
    return path


def _hour_counts(spark: SparkSession, path: str) -> DataFrame:
    lake = read_written(spark, path).withColumn("file", F.col("_metadata.file_name"))
    return lake.groupBy(*ARRIVAL_PARTITIONS).agg(
        F.count("*").alias("events"),
        F.count_distinct("file").cast("int").alias("files"),
        F.count_distinct("batch_id").alias("batches"),
        F.round(F.sum("price"), 2).alias("price_sum"),
    )


def _compacted_lake(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows and files of each hour after compaction."""
    return _hour_counts(spark, _merged(spark, sf_dir))


def _replayed_lake(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same after both batches were replayed on top."""
    path = _merged(spark, sf_dir)
    judged = _judged(spark, sf_dir)
    for number in (1, 0):
        land_events(judged.filter(F.col("seq") % 2 == number), path, f"{number:08d}")
    return _hour_counts(spark, path)


def _catalog_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last week of a lake, through a table that knows this week's folders only."""
    path = _two_batches(spark, sf_dir)
    table = f"events_{uuid4().hex}"
    create_event_table(spark, table, path)
    last = datetime.fromisoformat(AS_OF) + timedelta(days=1)
    sync_since(spark, table, path, last - timedelta(days=7), last)
    return read_event_table(spark, table).select("event_id", "event_type", *ARRIVAL_PARTITIONS)


def _payload_schema_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The schema log of all hours, of which the last days are stored twice."""
    path = scratch_folder(spark, "schemas")
    judged = _judged(spark, sf_dir)
    store_hourly_schemas(judged, path)
    store_hourly_schemas(arrival_window(judged, AS_OF, 2), path)
    return schema_changes(read_hourly_schemas(spark, path))


def _report_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A report stored, stored again, and read back."""
    out = scratch_folder(spark, "reports")
    events = _events(spark, sf_dir)
    for _ in range(2):
        refresh_report_tables(spark, events, out, ["device_breakdown"], AS_OF)
    return read_report(spark, "device_breakdown", out)


def _from_partials(name: str) -> Query:
    """A report from day partials: all days stored at first, the last two again."""
    report, partial = STORED_REPORTS[name]

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        path = scratch_folder(spark, "partials")
        events = _events(spark, sf_dir)
        store_days(events, path, partial)
        store_days(events, path, partial, AS_OF, 2)
        return report(spark, path, AS_OF) if name != "restaurant_device_pivot" else report(spark, path)

    return run


def _clock_skew_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clock skew of the last week from sketches of hours; its percentile by whether its rank is right."""
    path = scratch_folder(spark, "skew")
    events = _events(spark, sf_dir)
    store_hourly_skew(events, path)
    store_hourly_skew(events, path, AS_OF, 2)
    found = clock_skew_stored(spark, path, AS_OF, 7)
    skew = (F.unix_micros("ingested_at") - F.unix_micros("event_ts")) / 1e6
    week = arrival_window(events, AS_OF, 7).select("device_type", skew.alias("skew"))
    ranks = week.join(found.select("device_type", "p95_skew_s"), "device_type").groupBy("device_type").agg(
        (F.count_if(F.col("skew") < F.col("p95_skew_s")) / F.count("skew")).alias("below"),
        (F.count_if(F.col("skew") <= F.col("p95_skew_s")) / F.count("skew")).alias("upto"),
    )
    right = (F.col("below") <= 0.95 + RANK_ERROR) & (F.col("upto") >= 0.95 - RANK_ERROR)
    return found.join(ranks, "device_type").select(
        "device_type", "events", "unparsed", "min_skew_s", "max_skew_s", "negative", right.alias("p95_right")
    )


def _table_function(name: str, days: int) -> Query:
    """A report called from SQL."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        view = f"clickstream_{uuid4().hex}"
        register_report_view(_events(spark, sf_dir), view)
        register_table_functions(spark, view)
        return call_function(spark, name, AS_OF, days)

    return run


def _suite_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    results = run_reports(spark, _events(spark, sf_dir), as_of=AS_OF)
    rows = [(r.name, r.status, len(r.rows), r.truncated) for r in results]
    return spark.createDataFrame(rows, "name string, status string, fetched long, truncated boolean")


def _streamed(spark: SparkSession, sf_dir: str) -> IngestTarget:
    """Run the payload texts through the continuous ingest until all are landed."""
    root = scratch_folder(spark, "ingest")
    _lines(spark, sf_dir).select("value").write.text(f"{root}/payloads")
    target = IngestTarget(f"{root}/events", f"{root}/rejects", f"{root}/checkpoint")
    stream = read_payloads(spark, f"{root}/payloads", streaming=True)
    start_ingest(stream, target, available_now=True).awaitTermination()
    return target


def _stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = read_events(spark, _streamed(spark, sf_dir).events)
    return events.groupBy("event_type").agg(
        F.count("*").alias("events"),
        F.round(F.sum("price"), 2).alias("price_sum"),
        F.count_distinct("session_id").alias("sessions"),
    )


def _stream_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    rejects = read_quarantine(spark, _streamed(spark, sf_dir).quarantine)
    return rejects.groupBy("error_type", "field").agg(F.count("*").alias("rejected"))


def _streamed_metric(
    spark: SparkSession, sf_dir: str, metric: Callable[[DataFrame], DataFrame], mode: str = "complete"
) -> DataFrame:
    """A five-minute metric as a stream over the test table; ``complete`` writes open windows too."""
    configure_session(spark)
    root = scratch_folder(spark, "rates")
    schema = spark.read.parquet(f"{sf_dir}/events.parquet").schema
    rows = (
        spark.readStream.schema(schema)
        .option("pathGlobFilter", "events.parquet")
        .parquet(sf_dir)
    )
    judged = validate_events(payload_lines(derive_events(rows)))
    start_metric(
        metric(judged), f"{root}/out", f"{root}/checkpoint", mode, available_now=True
    ).awaitTermination()
    return spark.read.parquet(f"{root}/out")


def _stream_ingest_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _streamed_metric(spark, sf_dir, ingest_rate_5min)


def _stream_alarm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _streamed_metric(
        spark, sf_dir, lambda judged: ingest_error_alarm(judged, threshold=LOW_ALARM_ERRORS)
    )


def _stream_alarm_transitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _streamed_metric(
        spark,
        sf_dir,
        lambda judged: alarm_transitions(judged, "restaurant_id", LOW_ALARM_ERRORS),
        "append",
    )


def _stream_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All payloads twice, in several micro-batches, with repeated ids dropped."""
    root = scratch_folder(spark, "dedup")
    lines = _written_lines(spark, sf_dir, f"{root}/lines")
    for copy in range(2):
        lines.repartition(3).write.mode("append").text(f"{root}/payloads")
    target = IngestTarget(f"{root}/events", f"{root}/rejects", f"{root}/checkpoint")
    stream = read_payloads(spark, f"{root}/payloads", streaming=True, max_bytes_per_trigger=1 << 20)
    start_ingest(stream, target, available_now=True, dedup_hours=2).awaitTermination()
    return read_events(spark, target.events).select("event_id", "price")


def _stream_dedup_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All payloads three times, in three batches with a restart before each, repeats known from the state."""
    root = scratch_folder(spark, "dedup-state")
    target = IngestTarget(f"{root}/events", f"{root}/rejects", f"{root}/checkpoint")
    lines = _written_lines(spark, sf_dir, f"{root}/lines")
    for _ in range(3):
        _packed(lines).mode("append").text(f"{root}/payloads")
        stream = read_payloads(spark, f"{root}/payloads", streaming=True)
        start_ingest(stream, target, available_now=True, dedup_within="2 hours").awaitTermination()
        # The files of a delivery go once its batch is committed; the checkpoint has their names.
        Folder(spark, f"{root}/payloads").delete()
    return read_events(spark, target.events).select("event_id", "price")


def _stream_flushes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payloads in three deliveries, flushed at the start, by size, and by time after a restart."""
    root = scratch_folder(spark, "flushes")
    path = f"{root}/payloads"
    target = IngestTarget(f"{root}/events", f"{root}/rejects", f"{root}/checkpoint")
    lines = _lines(spark, sf_dir)
    now = [0.0]
    reasons = []

    def deliver(number: int) -> None:
        lines.filter(F.col("seq") % 3 == number).select("value").write.mode("append").text(path)

    def loop(max_bytes: int):
        stream = read_payloads(spark, path, streaming=True)
        return flushed_ingest(stream, path, target, FlushPolicy(max_bytes), lambda: now[0])

    deliver(0)
    first = loop(1 << 10)
    reasons.append(first.step())
    deliver(1)
    reasons.append(first.step())
    second = loop(1 << 50)
    second.step()
    deliver(2)
    reasons.append(second.step() or "waits")
    now[0] += FlushPolicy().seconds
    reasons[-1] += f", {second.step()}"
    names = F.create_map(*(F.lit(x) for n, reason in enumerate(reasons) for x in (f"{n:08d}", reason)))
    landed = read_written(spark, target.events).withColumn("flush", names[F.col("batch_id")])
    return landed.groupBy("flush").agg(F.count("*").alias("events"), F.round(F.sum("price"), 2).alias("price_sum"))


def entry(spark: SparkSession) -> DataFrame:
    """Flagship query: the most popular items of the last seven days."""
    return queries()["popular_items"](spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Query]:
    """Every registered query by name."""
    return {
        **{name: _report(name) for name in REPORTS},
        "arrival_window": _over_events(
            lambda e: arrival_window(e, AS_OF, 7).select("event_id", *ARRIVAL_PARTITIONS)
        ),
        "event_window": _over_events(
            lambda e: event_window(e, AS_OF, 7).select("event_id", "timestamp")
        ),
        "of_types": _over_events(
            lambda e: of_types(e, "order", "add_to_cart").select("event_id", "event_type")
        ),
        "rolled_up_categories": _over_events(
            lambda e: rolled_up(daily_rollup(e), "category", "event_type", as_of=AS_OF, days=7)
        ),
        "category_analysis_joined": _over_events(lambda e: category_analysis_joined(e, AS_OF)),
        "validate_events": _over_judged(
            lambda j: j.select(
                "seq", "status", "error_type", "field", "error", "event_type", "price"
            )
        ),
        "acknowledge": _over_judged(lambda j: acknowledge(j).select("seq", "status", "body")),
        "accepted_events": _over_judged(lambda j: _as_text(event_records(j))),
        "rejected_events": _over_judged(
            lambda j: quarantine_records(j).drop("ingested_at", *ARRIVAL_PARTITIONS)
        ),
        "rejection_summary": _over_judged(rejection_summary),
        "ingest_summary": _over_judged(ingest_summary),
        "ingest_rate_5min": _over_judged(ingest_rate_5min),
        "ingest_error_alarm": _over_judged(ingest_error_alarm),
        "ingest_error_alarm_of_two": _over_judged(
            lambda j: ingest_error_alarm(j, threshold=LOW_ALARM_ERRORS)
        ),
        "payload_drift": _over_judged(payload_drift),
        "payload_schema_versions": _payload_schema_versions,
        "landed_json": _landed("json"),
        "landed_parquet": _landed("parquet"),
        "device_platform_mix_landed": _platform_mix_landed,
        "landed_rejects": _landed_rejects,
        "compacted_lake": _compacted_lake,
        "replayed_lake": _replayed_lake,
        "catalog_events": _catalog_events,
        "report_table": _report_table,
        **{f"{name}_from_partials": _from_partials(name) for name in STORED_REPORTS},
        "clock_skew_stored": _clock_skew_stored,
        "device_breakdown_of": _table_function("device_breakdown_of", 7),
        "category_conversion_of": _table_function("category_conversion_of", 30),
        "suite_status": _suite_status,
        "stream_alarm": _stream_alarm,
        "stream_alarm_transitions": _stream_alarm_transitions,
        "stream_dedup": _stream_dedup,
        "stream_dedup_state": _stream_dedup_state,
        "stream_flushes": _stream_flushes,
        "stream_ingest": _stream_ingest,
        "stream_rejects": _stream_rejects,
        "stream_ingest_rate": _stream_ingest_rate,
        **(llm_queries.QUERIES if llm_queries else {}),
        **({"pipeline": corpus_pipeline.run} if llm_queries else {}),
    }


def oracle_sql() -> dict[str, str]:
    """The SQL twin of each query."""
    twins = oracle_queries.statements()
    if llm_queries:
        twins |= llm_queries.ORACLE_SQL
        if corpus_pipeline.ORACLE_SQL:
            twins["pipeline"] = corpus_pipeline.ORACLE_SQL
    return twins
