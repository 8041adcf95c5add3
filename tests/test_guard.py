import os
import time

import pytest
from pyspark.sql import functions as F

from builders import event_frame
from plateflow.operators.windows import arrival_window
from plateflow.plans.registry import REPORTS
from plateflow.plans.sql_functions import call, register_table_functions
from plateflow.plans.suite import run_reports
from plateflow.schema import ARRIVAL_PARTITIONS
from plateflow.sources.guard import VECTORED_READS, ReadLimit, ScanLimitExceeded, check_scan, counted_reads, plan_scan_bytes


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("guard") / "lake")
    events = event_frame(spark, [{"timestamp": f"2024-03-0{n % 9 + 1}T0{n % 4}:00:00Z"} for n in range(180)])
    events.write.partitionBy(*ARRIVAL_PARTITIONS).parquet(path)
    return spark.read.schema(events.schema).parquet(path), path


def sizes(path, *parts):
    return sum(
        os.path.getsize(os.path.join(folder, name))
        for folder, _, names in os.walk(path)
        for name in names
        if name.endswith(".parquet") and all(part in folder for part in parts)
    )


def test_the_plan_knows_any_filter(lake):
    events, path = lake
    assert plan_scan_bytes(events) == sizes(path)
    assert plan_scan_bytes(events.filter("hour = '02' AND price > 1")) == sizes(path, "hour=02")
    window = arrival_window(events, "2024-03-05", 2).groupBy("category").count()
    assert plan_scan_bytes(window) == sizes(path, "day=04") + sizes(path, "day=05")
    assert plan_scan_bytes(events.filter("day = '33'")) == 0


def test_all_scans_of_a_plan_count(spark, lake):
    events, path = lake
    both = events.filter("day = '01'").unionByName(events.filter("day = '02'"))
    assert plan_scan_bytes(both) == sizes(path, "day=01") + sizes(path, "day=02")
    events.createOrReplaceTempView("guarded_events")
    inner = spark.sql("SELECT * FROM guarded_events WHERE day = '01' AND price > (SELECT avg(price) FROM guarded_events WHERE day = '03')")
    assert plan_scan_bytes(inner) == sizes(path, "day=01") + sizes(path, "day=03")
    assert plan_scan_bytes(spark.range(5)) == 0
    with pytest.raises(ScanLimitExceeded):
        check_scan(plan_scan_bytes(both), 10)


def test_reports_are_refused_by_their_plans(spark, lake):
    events, path = lake
    names = ["popular_items", "events_by_device"]
    limit = sizes(path, "day=05") + sizes(path, "day=06")

    def two_days(events, day):
        return REPORTS["popular_items"](events, day, days=2)

    reports = {"two_days": two_days, **REPORTS}
    found = run_reports(spark, events, ["two_days", *names], "2024-03-06", reports=reports, scan_limit=limit)
    assert [r.status for r in found] == ["SUCCEEDED", "FAILED", "FAILED"]
    assert f"limit is {limit}" in found[2].error


def test_table_functions_read_their_window_only(spark, lake):
    events, path = lake
    events.createOrReplaceTempView("function_events")
    assert register_table_functions(spark, "function_events") == ["device_breakdown_of", "category_conversion_of"]
    two_days = call(spark, "device_breakdown_of", "2024-03-06", 2)
    assert plan_scan_bytes(two_days) == sizes(path, "day=05") + sizes(path, "day=06")
    whole = call(spark, "device_breakdown_of", "2024-03-09")
    expected = REPORTS["device_breakdown"](events, "2024-03-09", 7)
    assert sorted(map(tuple, whole.collect())) == sorted(map(tuple, expected.collect()))
    joined = spark.sql("SELECT count(*) AS n FROM VALUES (DATE '2024-03-02'), (DATE '2024-03-04') AS d(last), LATERAL device_breakdown_of(last, 1)")
    assert joined.first()["n"] == 2


def test_all_bytes_of_parquet_count(spark, tmp_path):
    path = tmp_path / "hashes"
    spark.range(20_000, numPartitions=1).select(F.sha2(F.col("id").cast("string"), 512).alias("value")).write.parquet(str(path))
    size = sum(f.stat().st_size for f in path.glob("*.parquet"))
    spark.sparkContext.addJobTag("parquet")
    try:
        with counted_reads(spark):
            spark.read.parquet(str(path)).agg(F.max("value")).collect()
    finally:
        spark.sparkContext.removeJobTag("parquet")
    assert 0.9 * size < ReadLimit(spark, "parquet", 1).read() < 1.2 * size
    assert spark.conf.get(VECTORED_READS, None) is None


def test_jobs_are_stopped_when_they_have_read_too_much(spark, lake, tmp_path):
    path = str(tmp_path / "texts")
    spark.range(4000, numPartitions=40).select(F.sha2(F.col("id").cast("string"), 512).alias("value")).write.text(path)

    def slow(rows):
        time.sleep(0.3)
        yield from rows

    def crawl():
        return spark.read.text(path).mapInArrow(slow, "value string").groupBy().count()

    assert ReadLimit(spark, "no such tag", 1).read() == 0
    started = time.time()
    spark.sparkContext.addJobTag("reading")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "15000")
    try:
        with ReadLimit(spark, "reading", 100_000) as limit, pytest.raises(Exception, match="(?i)cancel"):
            crawl().collect()
        assert limit.exceeded and 100_000 < limit.read() < 510_000
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.sparkContext.removeJobTag("reading")
    assert time.time() - started < 60
