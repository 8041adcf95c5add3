import pytest
from pyspark.sql import functions as F

from builders import event_frame, rows_of
from plateflow.plans import partials as p
from plateflow.plans.categories import category_analysis
from plateflow.plans.devices import device_breakdown, restaurant_device_pivot

FULL = {
    "device_breakdown": device_breakdown,
    "restaurant_device_pivot": restaurant_device_pivot,
    "category_analysis": category_analysis,
}


def some_events(spark, extra=0):
    events = []
    for n in range(200 + extra):
        events.append(
            {
                "timestamp": f"2024-03-{n % 9 + 1:02d}T0{n % 10}:00:00Z",
                "session_id": None if n % 31 == 0 else f"s{n * 7 % 45}",
                "device_type": ["mobile", "web", "kiosk", None][n % 4],
                "restaurant_id": f"r{n % 3}",
                "category": ["Pizza", "Salads", None][n % 3],
                "event_type": ["view", "order", "click"][n * 5 % 7 % 3],
                "menu_item_id": f"i{n % 11}",
                "price": None if n % 17 == 0 else n / 4,
            }
        )
    return event_frame(spark, events)


def values_of(frame):
    return sorted((sorted(r.items()) for r in rows_of(frame)), key=str)


@pytest.mark.parametrize("name", p.STORED_REPORTS)
@pytest.mark.parametrize("days", [1, 3, 9])
def test_partials_equal_a_full_run(spark, tmp_path, name, days):
    report, partial = p.STORED_REPORTS[name]
    events, path = some_events(spark), str(tmp_path / "p")
    p.store_days(events, path, partial)
    assert values_of(report(spark, path, "2024-03-08", days)) == values_of(FULL[name](events, "2024-03-08", days))


def test_a_refresh_touches_its_days_only(spark, tmp_path):
    path, partial = str(tmp_path / "p"), p.DEVICE_SESSIONS
    p.store_days(some_events(spark), path, partial)

    def files():
        days = spark.read.parquet(f"{path}/{p.DAYS}")
        return {r["f"]: r["day"] for r in rows_of(days.select(F.col("_metadata.file_path").alias("f"), "day").distinct())}

    before = files()
    later = some_events(spark, extra=40)
    for _ in range(2):
        p.store_days(later, path, partial, "2024-03-09", 2)
    after = files()
    assert {after[name] for name in after.keys() - before.keys()} == {8, 9}
    assert {before[name] for name in before.keys() - after.keys()} == {8, 9}
    found = values_of(p.device_breakdown_stored(spark, path, "2024-03-09", 2))
    assert found == values_of(device_breakdown(later, "2024-03-09", 2))
    numbers = rows_of(spark.read.parquet(f"{path}/{p.DICTIONARY}"))
    assert len(numbers) == len({(r["shard"], r["number"]) for r in numbers}) == len({r["value"] for r in numbers})


def test_values_beyond_one_bitmap(spark, tmp_path):
    path = str(tmp_path / "p")
    day = {"year": "2024", "month": "03", "day": "01"}
    rows = spark.range(700_000).select(
        *(F.lit(v).alias(k) for k, v in day.items()),
        (F.col("id") % 2).cast("string").alias("restaurant_id"),
        F.lit("web").alias("device_type"),
        F.concat(F.lit("s"), F.col("id") % 650_000).alias("session_id"),
    )
    p.store_days(rows, path, p.DEVICE_SESSIONS)
    found = {r["restaurant_id"]: r["distinct_count"] for r in rows_of(p.merged_days(spark, path, p.DEVICE_SESSIONS))}
    assert found == {"0": 325_000, "1": 325_000}


def test_no_days(spark, tmp_path):
    assert rows_of(p.merged_days(spark, str(tmp_path / "none"), p.CATEGORY_ITEMS)) == []
