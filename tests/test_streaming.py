import json
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from builders import payload_text, rows_of
from plateflow.operators.enrichment import enrich
from plateflow.operators.validation import validate_events
from plateflow.plans.health import ingest_rate_5min
from plateflow.sources.catalog import create_event_table, read_event_table
from plateflow.sources.lake import read_events, read_quarantine, read_written
from plateflow.sources.payloads import read_payloads
from plateflow.streaming import ingest as ingest_module
from plateflow.streaming.ingest import IngestTarget, drop_repeated_ids, land_batch, start_ingest
from plateflow.streaming.metrics import start_metric
from plateflow.streaming.progress import DurationListener, read_durations


def target_in(tmp_path, **changes):
    parts = {"events": "events", "quarantine": "rejects", "checkpoint": "checkpoint"}
    return IngestTarget(**{k: str(tmp_path / v) for k, v in parts.items()}, **changes)


def add_file(tmp_path, name, texts):
    folder = tmp_path / "payloads"
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(texts) + "\n")
    return str(folder)


def ingest(spark, source, target, **options):
    query = start_ingest(
        read_payloads(spark, source, streaming=True), target, available_now=True, **options
    )
    query.awaitTermination()
    return query


TEXTS = [payload_text(event_id=f"e{n}", price=n + 1) for n in range(20)] + ["junk", "{}"]


def test_stream_equals_batch(spark, tmp_path):
    source = add_file(tmp_path, "a.txt", TEXTS)
    target = target_in(tmp_path)
    ingest(spark, source, target)
    batch = validate_events(read_payloads(spark, source))
    expected = {(r["event_id"], r["price"]) for r in rows_of(batch.filter("status = 200").drop("payload"))}
    landed = rows_of(read_events(spark, target.events).drop("extra"))
    assert {(r["event_id"], r["price"]) for r in landed} == expected
    assert len(landed) == 20
    rejects = rows_of(read_quarantine(spark, target.quarantine))
    assert sorted((r["error_type"], r["value"]) for r in rejects) == [
        ("missing", "{}"), ("not_json", "junk"),
    ]


def test_later_files_arrive_in_later_batches(spark, tmp_path):
    target = target_in(tmp_path)
    ingest(spark, add_file(tmp_path, "a.txt", TEXTS), target)
    ingest(spark, add_file(tmp_path, "b.txt", [payload_text(event_id="late")]), target)
    assert read_events(spark, target.events).count() == 21


def test_replayed_batch_changes_nothing(spark, tmp_path):
    source = add_file(tmp_path, "a.txt", TEXTS)
    target = target_in(tmp_path)
    stamp = F.to_timestamp(F.lit("2024-03-01 10:00:00"))
    batch = validate_events(enrich(read_payloads(spark, source), stamp))
    run = land_batch(target)
    run(batch, 7)
    run(batch.limit(0), 8)
    run(batch, 7)
    assert read_events(spark, target.events).count() == 20
    assert read_quarantine(spark, target.quarantine).count() == 2


def test_catalog_follows_the_stream(spark, tmp_path):
    target = target_in(tmp_path, table="streamed_events")
    create_event_table(spark, "streamed_events", target.events)
    ingest(spark, add_file(tmp_path, "a.txt", TEXTS), target)
    assert read_event_table(spark, "streamed_events").count() == 20


def test_repeated_ids_land_once_when_asked(spark, tmp_path):
    twice = TEXTS + TEXTS[:5] + ["junk"]
    target = target_in(tmp_path)
    ingest(spark, add_file(tmp_path, "a.txt", twice), target, dedup_hours=1)
    more = [TEXTS[0], payload_text(event_id="new"), "junk"]
    ingest(spark, add_file(tmp_path, "b.txt", more), target, dedup_hours=1)
    landed = [r["event_id"] for r in rows_of(read_events(spark, target.events).select("event_id"))]
    assert sorted(landed) == sorted([f"e{n}" for n in range(20)] + ["new"])
    assert read_quarantine(spark, target.quarantine).count() == 4


def test_repeats_are_known_from_the_state(spark, tmp_path, monkeypatch):
    """Over several batches and a restart, without a look into the lake; a batch that fails is repeated."""
    def no_lake(*args):
        raise AssertionError("the lake was read")

    monkeypatch.setattr(ingest_module, "read_window", no_lake)
    target = target_in(tmp_path)
    ingest(spark, add_file(tmp_path, "a.txt", TEXTS + TEXTS[:5] + ["junk"]), target, dedup_within="1 hour")
    ingest(spark, add_file(tmp_path, "b.txt", TEXTS[3:8] + ["junk"]), target, dedup_within="1 hour")
    plain = ingest_module.land_rejects

    def failing(*args):
        raise OSError("quarantine gone")

    more = add_file(tmp_path, "c.txt", TEXTS[:1] + [payload_text(event_id="new"), "junk"])
    monkeypatch.setattr(ingest_module, "land_rejects", failing)
    with pytest.raises(Exception, match="quarantine gone"):
        ingest(spark, more, target, dedup_within="1 hour")
    monkeypatch.setattr(ingest_module, "land_rejects", plain)
    query = ingest(spark, more, target, dedup_within="1 hour")
    landed = [r["event_id"] for r in rows_of(read_events(spark, target.events).select("event_id"))]
    assert sorted(landed) == sorted([f"e{n}" for n in range(20)] + ["new"])
    assert read_quarantine(spark, target.quarantine).count() == 5
    state = query.lastProgress.stateOperators[0]
    assert state.operatorName == "dedupeWithinWatermark"
    assert any(name.startswith("rocksdb") for name in state.customMetrics)


def test_ids_leave_the_state_after_the_delay(spark, tmp_path):
    target = target_in(tmp_path)
    for name, hour in (("a.txt", 0), ("b.txt", 1), ("c.txt", 9), ("d.txt", 10)):
        stamp = F.to_timestamp(F.lit(f"2024-03-01 {hour:02d}:00:00"))
        source = add_file(tmp_path, name, [payload_text(event_id="e")])
        query = ingest(spark, source, target, dedup_within="2 hours", now=stamp)
    hours = sorted(r["hour"] for r in rows_of(read_events(spark, target.events).select("hour")))
    # The batch of nine o'clock moves the watermark, the next one lands the id again.
    assert hours == ["00", "10"] and query.lastProgress.stateOperators[0].numRowsTotal == 1


def test_payloads_are_read_and_counted_once(spark, tmp_path):
    """From one source, so that a stream goes on with the checkpoint it has."""
    source = add_file(tmp_path, "a.txt", TEXTS + TEXTS[:5] + ["junk"])
    target = target_in(tmp_path)
    query = ingest(spark, source, target, dedup_within="1 hour")
    assert all(len(progress.sources) == 1 for progress in query.recentProgress)
    assert sum(progress.numInputRows for progress in query.recentProgress) == 28
    metrics = [p.observedMetrics["ingest"] for p in query.recentProgress if p.observedMetrics]
    assert [sum(m[name] for m in metrics) for name in ("received", "accepted", "rejected")] == [28, 25, 3]
    assert read_quarantine(spark, target.quarantine).count() == 3


def test_rejects_move_the_watermark(spark, tmp_path):
    target = target_in(tmp_path)
    texts = {"a.txt": payload_text(event_id="e"), "b.txt": "junk", "c.txt": payload_text(event_id="e")}
    for (name, text), hour in zip(texts.items(), (0, 9, 10)):
        stamp = F.to_timestamp(F.lit(f"2024-03-01 {hour:02d}:00:00"))
        ingest(spark, add_file(tmp_path, name, [text]), target, dedup_within="2 hours", now=stamp)
    hours = sorted(r["hour"] for r in rows_of(read_events(spark, target.events).select("hour")))
    assert hours == ["00", "10"]


@pytest.mark.parametrize("options", [{}, {"dedup_within": "1 hour"}, {"dedup_hours": 1, "dedup_within": "1 hour"}])
def test_streams_land_what_batches_land(spark, tmp_path, options):
    """Whole rows in both sinks, whatever the stream leaves behind on its way."""
    texts = [
        payload_text(event_id="a", extra_null=None, nested={"x": [1, {"y": None}]}, ingested_at="1999"),
        payload_text(event_id="b\u00e9 1", price="3.5"),
        payload_text(event_id="c", note="n" * 300, price=-1),
        payload_text(event_id="d", device_type="watch"),
        '{"body": "[1]"}', "", "junk " + "j" * 400,
    ]
    stamp = F.to_timestamp(F.lit("2024-03-01 10:00:00"))
    source = add_file(tmp_path, "a.txt", texts)
    plain, streamed = target_in(tmp_path / "plain"), target_in(tmp_path / "streamed")
    land_batch(plain)(validate_events(enrich(read_payloads(spark, source), stamp)), 0)
    ingest(spark, source, streamed, now=stamp, **options)

    def landed(target):
        events = read_events(spark, target.events).withColumn("extra", F.to_json("extra"))
        return [
            sorted(map(str, rows_of(rows))) for rows in (events, read_quarantine(spark, target.quarantine))
        ]

    assert landed(streamed) == landed(plain)
    assert [len(rows) for rows in landed(plain)] == [2, 5]


def test_cached_and_shuffled_rows_are_slim(spark, tmp_path):
    """No text of accepted rows and no payload of rejected ones."""
    batch = validate_events(enrich(read_payloads(spark, add_file(tmp_path, "a.txt", TEXTS))))
    slim = ingest_module.landed_parts(batch)
    assert slim.columns == batch.columns
    assert slim.filter("status = 200 AND value <> ''").isEmpty()
    rejected = slim.filter("status = 400")
    assert rejected.filter("payload IS NOT NULL OR session_id IS NOT NULL").isEmpty()
    assert sorted(r["value"] for r in rows_of(rejected.select("value"))) == ["junk", "{}"]


def test_settings_for_disk_are_those_of_the_stream_only(spark, tmp_path, monkeypatch):
    plain, seen = ingest_module.land_events, []
    keys = list(ingest_module.DISK_SETTINGS)

    def spying(rows, *args):
        seen.append({key: rows.sparkSession.conf.get(key) for key in keys})
        plain(rows, *args)

    monkeypatch.setattr(ingest_module, "land_events", spying)
    before = [spark.conf.get(key, None) for key in keys]
    ingest(spark, add_file(tmp_path, "a.txt", TEXTS), target_in(tmp_path), dedup_within="1 hour")
    assert seen and all(settings == ingest_module.DISK_SETTINGS for settings in seen)
    assert [spark.conf.get(key, None) for key in keys] == before


def test_batch_restarts_from_the_checkpoint_after_a_failed_sink(spark, tmp_path, monkeypatch):
    source = add_file(tmp_path, "a.txt", TEXTS)
    target = target_in(tmp_path)
    plain = ingest_module.land_rejects

    def failing(*args):
        raise OSError("quarantine gone")

    monkeypatch.setattr(ingest_module, "land_rejects", failing)
    with pytest.raises(Exception, match="quarantine gone"):
        ingest(spark, source, target)
    assert read_events(spark, target.events).count() == 20
    monkeypatch.setattr(ingest_module, "land_rejects", plain)
    ingest(spark, source, target)
    assert read_events(spark, target.events).count() == 20
    assert read_quarantine(spark, target.quarantine).count() == 2


def test_same_repeat_is_chosen_each_time(spark, tmp_path):
    texts = [payload_text(event_id="e", price=p) for p in (9, 3, 5)]
    stamp = F.to_timestamp(F.lit("2024-03-01 10:00:00"))
    batch = validate_events(enrich(read_payloads(spark, add_file(tmp_path, "a.txt", texts)), stamp))
    for order in ("value", "price"):
        (row,) = rows_of(drop_repeated_ids(batch.orderBy(F.desc(order))).select("event_id", "price"))
        assert row["price"] == 3


def test_repeated_ids_are_kept_by_default(spark, tmp_path):
    target = target_in(tmp_path)
    ingest(spark, add_file(tmp_path, "a.txt", TEXTS + TEXTS[:5]), target)
    assert read_events(spark, target.events).count() == 25


def test_batches_can_be_capped(spark, tmp_path):
    for n in range(3):
        source = add_file(tmp_path, f"{n}.txt", [payload_text(event_id=f"e{n}")])
    target = target_in(tmp_path)
    stream = read_payloads(spark, source, streaming=True, max_bytes_per_trigger=1)
    start_ingest(stream, target, available_now=True).awaitTermination()
    lake = read_written(spark, target.events)
    assert lake.select("batch_id").distinct().count() == 3


def test_counts_are_observed(spark, tmp_path):
    query = ingest(spark, add_file(tmp_path, "a.txt", TEXTS), target_in(tmp_path))
    metrics = [p.observedMetrics["ingest"] for p in query.recentProgress if p.observedMetrics]
    assert sum(m["received"] for m in metrics) == 22
    assert sum(m["accepted"] for m in metrics) == 20


def stamped_lines(spark, tmp_path, minutes):
    lines = [json.dumps({"minute": m, "value": "junk"}) for m in minutes]
    folder = tmp_path / "stamped"
    folder.mkdir(exist_ok=True)
    (folder / f"{len(list(folder.iterdir()))}.json").write_text("\n".join(lines) + "\n")
    rows = spark.readStream.schema("minute int, value string").json(str(folder))
    start = F.to_timestamp(F.lit("2024-03-01 00:00:00"))
    return rows.withColumn("ingested_at", F.timestamp_add("MINUTE", F.col("minute"), start))


def test_closed_windows_are_appended_once(spark, tmp_path):
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "metric-checkpoint")
    for minutes in ([0, 1, 6], [30], [60]):
        judged = validate_events(stamped_lines(spark, tmp_path, minutes))
        metric = ingest_rate_5min(judged, watermark="10 minutes")
        start_metric(metric, out, checkpoint, available_now=True).awaitTermination()
    rows = rows_of(spark.read.parquet(out))
    found = sorted((str(r["window_start"])[11:16], r["errors"]) for r in rows)
    assert found == [("00:00", 2), ("00:05", 1), ("00:30", 1)]


@pytest.mark.parametrize("query", ["stream_dedup", "stream_dedup_state"])
def test_repeated_deliveries_derive_the_payloads_once(spark, sf_dir, monkeypatch, query):
    import __spark_entry__

    written, plain = [], __spark_entry__._lines
    keep = __spark_entry__._written_lines
    monkeypatch.setattr(
        __spark_entry__, "_written_lines", lambda *args: written.append(args[2]) or keep(*args)
    )
    landed = rows_of(__spark_entry__.queries()[query](spark, sf_dir))
    accepted = validate_events(plain(spark, sf_dir)).filter("status = 200").select("event_id", "price")
    key = lambda row: (row["event_id"], row["price"])
    assert sorted(map(key, landed)) == sorted(map(key, rows_of(accepted)))
    (path,) = written
    assert path.endswith("/lines")


def test_deliveries_are_compressed_and_go_once_committed(spark, sf_dir, tmp_path, monkeypatch):
    import __spark_entry__

    monkeypatch.setattr(__spark_entry__, "scratch_folder", lambda spark, name: str(tmp_path))
    plain, delivered = __spark_entry__.start_ingest, []

    def spying(*args, **options):
        delivered.append([path.name for path in (tmp_path / "payloads").glob("part-*")])
        return plain(*args, **options)

    monkeypatch.setattr(__spark_entry__, "start_ingest", spying)
    monkeypatch.setattr(__spark_entry__, "FILE_LINES", 300)
    landed = __spark_entry__.queries()["stream_dedup_state"](spark, sf_dir).count()
    payloads = spark.read.text(str(tmp_path / "lines")).count()
    accepted = validate_events(spark.read.text(str(tmp_path / "lines"))).filter("status = 200").count()
    assert landed == accepted
    assert read_quarantine(spark, str(tmp_path / "rejects")).count() == 3 * (payloads - accepted)
    assert len(delivered) == 3 and all(len(names) >= payloads // 300 for names in delivered)
    assert all(name.endswith(".gz") for names in delivered for name in names)
    assert not (tmp_path / "payloads").exists()


def test_mean_duration_per_period(spark):
    listener = DurationListener()
    listener.record("q", "2024-03-01T00:00:01.000Z", 100)
    listener.record("q", "2024-03-01T00:04:59.000Z", 300)
    listener.record("q", "2024-03-01T00:05:00.000Z", 50)
    rows = sorted(rows_of(listener.durations(spark)), key=lambda r: r["window_start"])
    assert [(r["batches"], r["mean_ms"]) for r in rows] == [(2, 200.0), (1, 50.0)]
    assert rows[1]["window_start"] - rows[0]["window_start"] == timedelta(minutes=5)


def test_means_survive_a_restart(spark, tmp_path):
    path = str(tmp_path / "durations")
    first, second = DurationListener(), DurationListener()
    first.record("q", "2024-03-01T00:00:01.000Z", 100)
    assert first.store(spark, path) == 1 and first.store(spark, path) == 0
    first.record("q", "2024-03-01T00:00:02.000Z", 200)
    first.record("q", "2024-03-02T00:00:02.000Z", 7)
    with pytest.raises(Exception):
        first.store(spark, "nofilesystem://x/y")
    assert first.store(spark, path) == 2
    second.record("q", "2024-03-01T00:04:59.000Z", 600)
    second.store(spark, path)
    rows = sorted(rows_of(read_durations(spark, path)), key=lambda r: r["window_start"])
    assert [(r["batches"], r["mean_ms"]) for r in rows] == [(3, 300.0), (1, 7.0)]


def test_listener_hears_the_stream(spark, tmp_path):
    listener = DurationListener()
    spark.streams.addListener(listener)
    try:
        ingest(spark, add_file(tmp_path, "a.txt", TEXTS), target_in(tmp_path))
        for _ in range(50):
            if listener.durations(spark).count():
                break
        rows = rows_of(listener.durations(spark))
    finally:
        spark.streams.removeListener(listener)
    assert rows and rows[0]["query"] == "plateflow-ingest" and rows[0]["mean_ms"] > 0
