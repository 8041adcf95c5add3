from pyspark.sql import functions as F

from builders import event_frame, rows_of
from plateflow.operators.windows import arrival_window
from plateflow.plans.health import clock_skew
from plateflow.plans.skew_sketches import RANK_ERROR, clock_skew_stored, store_hourly_skew


def many_events(spark):
    """200,000 skews of a web device over nine days, with a long tail, and a few of others."""
    rows = spark.range(200_000).select(
        F.lit("web").alias("device_type"),
        F.timestamp_seconds(F.lit(1709251200) + F.col("id") * 37 % (9 * 86400)).alias("ingested_at"),
        (F.pow(F.pmod(F.xxhash64("id"), F.lit(1000)) / 100, 4) - 5).alias("late"),
    )
    shifted = rows.withColumn("event_ts", F.timestamp_micros((F.unix_micros("ingested_at") - F.col("late") * 1e6).cast("long")))
    parts = {n: F.date_format("ingested_at", f) for n, f in (("year", "yyyy"), ("month", "MM"), ("day", "dd"), ("hour", "HH"))}
    odd = event_frame(spark, [{"timestamp": "soon", "ingested_at": "2024-03-02T01:00:00Z", "device_type": "kiosk"}])
    few = event_frame(spark, [{"timestamp": "2024-03-02T01:00:00Z", "device_type": None}])
    both = odd.unionByName(few).select("device_type", "ingested_at", "event_ts", *parts)
    return shifted.withColumns(parts).select(*both.columns).unionByName(both)


def test_ranks_are_within_the_stated_error(spark, tmp_path):
    path, events = str(tmp_path / "skew"), many_events(spark)
    store_hourly_skew(events, path)
    store_hourly_skew(events, path, "2024-03-09", 2)
    for as_of, days in (("2024-03-09", 9), ("2024-03-05", 3), ("2024-03-07", 1)):
        window = arrival_window(events, as_of, days)
        exact = {r["device_type"]: r for r in rows_of(clock_skew(window))}
        found = {r["device_type"]: r for r in rows_of(clock_skew_stored(spark, path, as_of, days))}
        assert found.keys() == exact.keys()
        for device, row in found.items():
            for name in ("events", "unparsed", "min_skew_s", "max_skew_s", "negative"):
                assert row[name] == exact[device][name]
        skew = (F.unix_micros("ingested_at") - F.unix_micros("event_ts")) / 1e6
        web = window.filter("device_type = 'web'").select(skew.alias("skew"))
        at = found["web"]["p95_skew_s"]
        below, upto, n = web.agg(F.count_if(F.col("skew") < at), F.count_if(F.col("skew") <= at), F.count("skew")).first()
        assert below / n <= 0.95 + RANK_ERROR and upto / n >= 0.95 - RANK_ERROR
    assert found.get("kiosk") is None
    whole = {r["device_type"]: r for r in rows_of(clock_skew_stored(spark, path))}
    assert whole["kiosk"]["p95_skew_s"] is None and whole["kiosk"]["unparsed"] == 1
    assert whole[None]["p95_skew_s"] == 0.0


def test_nothing_stored(spark, tmp_path):
    assert rows_of(clock_skew_stored(spark, str(tmp_path / "none"), "2024-03-01", 7)) == []
