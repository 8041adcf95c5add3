import gzip
import json
import os
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from builders import payload_frame, payload_text, rows_of
from plateflow.operators.enrichment import enrich
from plateflow.operators.validation import validate_events
from plateflow.operators.windows import arrival_window
from plateflow.plans.categories import category_analysis
from plateflow.plans.items import popular_items
from plateflow.plans.registry import REPORTS
from plateflow.plans.suite import run_reports, window_days
from plateflow.schema import ARRIVAL_PARTITIONS
from plateflow.sources.catalog import (
    create_event_table,
    create_quarantine_table,
    payload_drift,
    read_event_table,
    register_partitions,
    schema_drift,
    sync_partitions,
    sync_since,
)
from plateflow.sources.files import Folder
from plateflow.sources.guard import (
    ScanLimitExceeded,
    check_scan,
    guard_scan,
    lake_scan_bytes,
)
from plateflow.sources.notes import LakeNotes
from plateflow.sources.lake import (
    compact_hours,
    land_events,
    land_rejects,
    read_events,
    read_flat_events,
    read_quarantine,
    read_written,
)
from plateflow.sources.scratch import scratch_folder

STAMPS = ["2024-02-29 23:59:59.123456", "2024-03-01 00:00:00", "2024-03-05 10:00:00"]


def judged(spark, stamps=STAMPS, **changes):
    texts = [payload_text(event_id=f"e{n}", platform="ios", **changes) for n in range(len(stamps))]
    times = spark.createDataFrame(list(enumerate(stamps)), "row int, stamp string")
    rows = payload_frame(spark, texts).join(times, "row")
    return validate_events(enrich(rows, F.to_timestamp("stamp")))


def files_below(path, suffix):
    return sorted(
        os.path.relpath(os.path.join(folder, name), path)
        for folder, _, names in os.walk(path)
        for name in names
        if name.endswith(suffix)
    )


@pytest.mark.parametrize("file_format", ["json", "parquet"])
def test_round_trip(spark, tmp_path, file_format):
    path = str(tmp_path / "lake")
    land_events(judged(spark), path, "1", file_format)
    rows = rows_of(read_events(spark, path, file_format).withColumn("extra", F.to_json("extra")))
    rows.sort(key=lambda r: r["event_id"])
    assert [str(r["ingested_at"]) for r in rows] == STAMPS
    assert str(rows[0]["event_ts"]) == "2024-03-15 08:05:44.250000"
    assert [(r["year"], r["month"], r["day"], r["hour"]) for r in rows] == [
        ("2024", "02", "29", "23"), ("2024", "03", "01", "00"), ("2024", "03", "05", "10"),
    ]
    assert all(r["price"] == 11.25 and json.loads(r["extra"]) == {"platform": "ios"} for r in rows)


def test_one_gzip_json_line_per_event(spark, tmp_path):
    path = str(tmp_path / "lake")
    land_events(judged(spark, [STAMPS[0]] * 3), path, "k7", "json")
    files = files_below(path, ".json.gz")
    assert [os.path.dirname(f) for f in files] == ["year=2024/month=02/day=29/hour=23"]
    lines = gzip.open(os.path.join(path, files[0]), "rt").read().splitlines()
    assert len(lines) == 3 and json.loads(lines[0])["menu_item_id"] == "p7"


def test_repeated_write_replaces_only_itself(spark, tmp_path):
    path = str(tmp_path / "lake")
    land_events(judged(spark), path, "1")
    land_events(judged(spark, STAMPS[:1]), path, "2")
    before = files_below(path, ".parquet")
    land_events(judged(spark, STAMPS[:1]), path, "2")
    assert read_events(spark, path).count() == 4
    assert len(files_below(path, ".parquet")) == len(before) == 4


def test_folders_do_not_depend_on_the_number_of_writes(spark, tmp_path):
    path = str(tmp_path / "lake")
    for key in range(5):
        land_events(judged(spark), path, key)
    hours = {os.path.dirname(f) for f in files_below(path, ".parquet")}
    assert len(hours) == 3 and read_events(spark, path).count() == 15


def failing_at(monkeypatch, step, allowed):
    """Let a step of the lake's folder fail after so many calls."""
    plain, calls = getattr(Folder, step), []

    def failing(self, *args):
        if len(calls) == allowed:
            raise OSError("driver gone")
        calls.append(args)
        return plain(self, *args)

    monkeypatch.setattr(Folder, step, failing)


@pytest.mark.parametrize("step, allowed", [("write_lines", 0), ("move", 0), ("move", 1), ("move", 3)])
def test_half_written_batch_is_repeated(spark, tmp_path, monkeypatch, step, allowed):
    """What an attempt left that failed before its end isn't seen, and doesn't stay beside the repeat,
    even if the repeat has rows of other hours."""
    path = str(tmp_path / "lake")
    land_events(judged(spark, STAMPS[:1]), path, "2")
    failing_at(monkeypatch, step, allowed)
    with pytest.raises(OSError):
        land_events(judged(spark), path, "1")
    monkeypatch.undo()
    assert [r["batch_id"] for r in rows_of(read_written(spark, path).drop("extra"))] == ["2"]
    assert compact_hours(spark, path, HOUR, HOUR + timedelta(days=9)) == 0
    land_events(judged(spark, STAMPS[1:2] * 2), path, "1")
    rows = rows_of(read_written(spark, path).drop("extra"))
    assert sorted(r["batch_id"] for r in rows) == ["1", "1", "2"]
    assert not [f for f in files_below(path, ".parquet") if f.startswith("_")]


def test_a_done_write_is_not_repeated(spark, tmp_path):
    path = str(tmp_path / "lake")
    land_events(judged(spark, STAMPS[:2]), path, "1")
    land_events(judged(spark), path, "1")
    assert read_events(spark, path).count() == 2


HOUR = datetime(2024, 2, 29, 23)


def test_compaction(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "lake")
    for key in range(3):
        land_events(judged(spark, [STAMPS[0]] * 2), path, key)
    land_events(judged(spark, STAMPS[1:2]), path, "9")
    assert compact_hours(spark, path, HOUR, HOUR + timedelta(hours=2)) == 1
    folders = [os.path.dirname(f) for f in files_below(path, ".parquet")]
    assert len(folders) == len(set(folders)) == 2
    rows = rows_of(read_written(spark, path).drop("extra"))
    assert sorted(r["batch_id"] for r in rows) == ["0", "0", "1", "1", "2", "2", "9"]
    assert compact_hours(spark, path, HOUR, HOUR + timedelta(hours=2)) == 0


@pytest.mark.parametrize("step, allowed", [("write_lines", 0), ("delete_path", 1), ("move", 0), ("move", 1)])
def test_interrupted_compaction_loses_nothing(spark, tmp_path, monkeypatch, step, allowed):
    path = str(tmp_path / "lake")
    for key in range(3):
        land_events(judged(spark, [STAMPS[0]] * 2), path, key)
    failing_at(monkeypatch, step, allowed)
    with pytest.raises(OSError):
        compact_hours(spark, path, HOUR, HOUR + timedelta(hours=1))
    monkeypatch.undo()
    assert read_events(spark, path).count() == 6
    compact_hours(spark, path, HOUR, HOUR + timedelta(hours=1))
    assert read_events(spark, path).count() == 6
    assert len([f for f in files_below(path, ".parquet") if not f.startswith("_")]) == 1


def test_readers_never_see_a_compaction_in_part(spark, tmp_path, monkeypatch):
    """A report at each step of a switch sees every row once, through folders and through the catalog."""
    path = str(tmp_path / "lake")
    for key in range(3):
        land_events(judged(spark), path, key)
    create_event_table(spark, "switched_events", path)
    sync_partitions(spark, "switched_events")
    seen = []
    for step in ("move", "delete_path", "write_lines"):
        plain = getattr(Folder, step)

        def watched(self, *args, plain=plain):
            plain(self, *args)
            seen.append((read_events(spark, path).count(), read_event_table(spark, "switched_events").count()))

        monkeypatch.setattr(Folder, step, watched)
    monkeypatch.setattr("plateflow.sources.notes.THREADS", 1)
    assert compact_hours(spark, path, HOUR, HOUR + timedelta(days=9)) == 3
    assert len(seen) == 1 + 4 + 9 and set(seen) == {(9, 9)}


def test_replaced_files_stay_for_readers_that_began_before(spark, tmp_path):
    path = str(tmp_path / "lake")
    for key in range(2):
        land_events(judged(spark), path, key)
    before = read_events(spark, path)
    compact_hours(spark, path, HOUR, HOUR + timedelta(hours=1), grace=timedelta(hours=1))
    assert before.count() == 6 and read_events(spark, path).count() == 6
    assert len(files_below(path, ".parquet")) == 7
    compact_hours(spark, path, HOUR, HOUR + timedelta(days=9), grace=timedelta(hours=1))
    assert before.count() == 6 and read_events(spark, path).count() == 6
    assert len(files_below(path, ".parquet")) == 9
    compact_hours(spark, path, HOUR, HOUR + timedelta(days=9))
    assert read_events(spark, path).count() == 6 and len(files_below(path, ".parquet")) == 3


def test_replay_after_compaction_changes_nothing(spark, tmp_path):
    """Also for a write over several hours, some of them merged and some not."""
    path = str(tmp_path / "lake")
    for key in range(2):
        land_events(judged(spark), path, key)
    compact_hours(spark, path, HOUR, HOUR + timedelta(hours=1))
    for key in range(2):
        land_events(judged(spark), path, key)
    rows = rows_of(read_written(spark, path).drop("extra"))
    assert sorted(r["batch_id"] for r in rows) == ["0"] * 3 + ["1"] * 3


def test_parts_of_hours_count_whole(spark, tmp_path):
    path = str(tmp_path / "lake")
    stamps = ["2024-03-01 10:10:00", "2024-03-01 11:00:00", "2024-03-01 12:59:00", "2024-03-01 13:00:00"]
    for key in range(2):
        land_events(judged(spark, stamps), path, key)
    since, until = datetime(2024, 3, 1, 10, 30), datetime(2024, 3, 1, 12, 10)
    create_event_table(spark, "part_hours", path)
    assert sync_since(spark, "part_hours", path, since, until) == 3
    assert compact_hours(spark, path, since, until) == 3
    assert compact_hours(spark, path, since, until.replace(minute=0)) == 0
    assert read_events(spark, path).count() == 8


def test_notes_of_done_writes_are_gathered(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("plateflow.sources.notes.NOTES_KEPT", 2)
    path = str(tmp_path / "lake")
    keys = ["0007", "0008", "0009", "12", "backfill", "0011"]
    for key in keys:
        land_events(judged(spark, STAMPS[:1]), path, key)
        compact_hours(spark, path, HOUR, HOUR + timedelta(hours=1))
    notes = LakeNotes(spark, path)
    assert all(notes.is_done(key) for key in keys)
    assert not any(notes.is_done(key) for key in ("0006", "0010", "08", "8", "back", "13"))
    assert len(notes.lake.names("_writes/ledger")) == 1 and len(notes.lake.names("_writes/done")) <= 2
    for key in keys:
        land_events(judged(spark, STAMPS[:1]), path, key)
    assert read_events(spark, path).count() == 6


def test_quarantine_folders(spark, tmp_path):
    path = str(tmp_path / "rejects")
    land_rejects(judged(spark, event_type="VIEW"), path)
    rows = rows_of(read_quarantine(spark, path))
    assert {(r["error_type"], r["field"], r["month"]) for r in rows} == {
        ("domain", "event_type", "02"), ("domain", "event_type", "03"),
    }


def test_flat_lake_of_another_producer(spark, tmp_path):
    folder = tmp_path / "flat" / "year=2024" / "month=03" / "day=01" / "hour=07"
    folder.mkdir(parents=True)
    record = payload_text(price="8.99", platform="ios", ingested_at="2024-03-01T07:00:00.5+00:00")
    with gzip.open(folder / "part.json.gz", "wt") as out:
        out.write(record + "\n")
    row = rows_of(
        read_flat_events(spark, str(tmp_path / "flat")).withColumn("extra", F.to_json("extra"))
    )[0]
    assert (row["price"], row["month"], row["extra"]) == (8.99, "03", '{"platform":"ios"}')
    assert str(row["ingested_at"]) == "2024-03-01 07:00:00.500000"
    assert str(row["event_ts"]) == "2024-03-15 08:05:44.250000"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_arrival_window_prunes_folders(spark, tmp_path):
    path = str(tmp_path / "lake")
    land_events(judged(spark), path, file_format="parquet")
    lake = read_events(spark, path, "parquet")
    plan = plan_of(arrival_window(lake, "2024-03-05", 7).select("event_id"))
    partition_filters = plan.split("PartitionFilters: [")[1].split("PushedFilters")[0]
    assert "month" in partition_filters and "concat_ws" in partition_filters
    assert "ReadSchema: struct<event_id:string>" in plan
    assert "Filter" not in plan.split("FileScan")[0]


def test_report_plans(spark, tmp_path):
    path = str(tmp_path / "lake")
    land_events(judged(spark), path, file_format="parquet")
    lake = read_events(spark, path, "parquet")
    assert plan_of(category_analysis(lake, "2024-03-05")).count("FileScan") == 1
    assert "TakeOrderedAndProject" in plan_of(popular_items(lake, "2024-03-05"))


def test_catalog_table(spark, tmp_path):
    path = str(tmp_path / "lake")
    land_events(judged(spark), path, "1")
    create_event_table(spark, "synced_events", path)
    assert read_event_table(spark, "synced_events").count() == 0
    sync_partitions(spark, "synced_events")
    assert read_event_table(spark, "synced_events", "default").count() == 3
    land_events(judged(spark, ["2024-03-06 07:30:00"]), path, "2")
    parts = dict(zip(ARRIVAL_PARTITIONS, ["2024", "03", "06", "07"]))
    register_partitions(spark, "synced_events", [parts])
    register_partitions(spark, "synced_events", [parts])
    rows = rows_of(read_event_table(spark, "synced_events").drop("extra"))
    assert len(rows) == 4 and {r["month"] for r in rows} == {"02", "03"}


def test_sync_looks_at_the_given_hours_only(spark, tmp_path):
    path = str(tmp_path / "the cook's lake")
    land_events(judged(spark), path, "1")
    land_rejects(judged(spark, event_type="VIEW"), f"{path}-rejects")
    create_event_table(spark, "recent_events", path)
    create_quarantine_table(spark, "recent_rejects", f"{path}-rejects")
    since, until = datetime(2024, 3, 1), datetime(2024, 3, 6)
    assert sync_since(spark, "recent_events", path, since, until) == 2
    assert sync_since(spark, "recent_rejects", f"{path}-rejects", since, until) == 2
    assert read_event_table(spark, "recent_events").count() == 2
    assert spark.table("recent_rejects").filter("error_type = 'domain'").count() == 2


def test_scan_guard(spark, tmp_path):
    path = str(tmp_path / "lake")
    land_events(judged(spark), path, "1")
    sizes = [os.path.getsize(os.path.join(path, f)) for f in files_below(path, ".parquet")]
    assert lake_scan_bytes(spark, path) == sum(sizes)
    window = lake_scan_bytes(spark, path, "2024-03-05", 5)
    assert window == sum(sizes[1:])
    assert lake_scan_bytes(spark, path, "2020-01-01", 5) == 0
    assert guard_scan(spark, path, "2024-03-05", 5) == window
    with pytest.raises(ScanLimitExceeded):
        guard_scan(spark, path, "2024-03-05", 5, max_bytes=10)
    assert check_scan(10, 10) == 10
    lake, names = read_events(spark, path), ["popular_items"]
    refused = run_reports(spark, lake, names, "2024-03-05", max_bytes=10, lake=path)[0]
    assert refused.status == "FAILED" and "limit is 10" in refused.error
    within = run_reports(spark, lake, names, "2024-03-05", max_bytes=sum(sizes), lake=path)[0]
    assert within.status == "SUCCEEDED"
    empty = run_reports(spark, lake, names, "2020-01-01", max_bytes=10, lake=path)[0]
    assert empty.rows == []
    with pytest.raises(ValueError):
        run_reports(spark, lake, names, max_bytes=10)
    assert [window_days(REPORTS[n]) for n in ("popular_items", "device_dropoff", "heatmap")] == [7, 14, 7]
    assert [window_days(REPORTS[n]) for n in ("events_by_device", "revenue_kpi")] == [None, None]


def test_drift(spark, tmp_path):
    sample = spark.createDataFrame([("e", "1", "u")], "event_id string, price string, user_id string")
    found = {(r["column"], r["kind"]) for r in rows_of(schema_drift(sample))}
    assert {("user_id", "added"), ("price", "type"), ("category", "missing")} <= found
    assert ("event_id", "type") not in found
    rows = payload_frame(spark, [payload_text(user_id="u", category=...), payload_text(category=...), "x"])
    found = {(r["column"], r["kind"], r["payloads"]) for r in rows_of(payload_drift(validate_events(rows)))}
    assert found == {("user_id", "added", 1), ("category", "missing", 0)}


def test_scratch_folder_uses_the_shared_setting(spark):
    setting = spark.conf.get("spark.checkpoint.dir", None)
    folder = scratch_folder(spark, "x")
    assert setting is None or folder.startswith(setting)
    assert folder != scratch_folder(spark, "x")
