import inspect
from datetime import date, datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from builders import at, event_frame, payload_frame, payload_text, rows_of
from plateflow.functions.measures import leading_digits
from plateflow.operators.validation import validate_events
from plateflow.operators.windows import arrival_window, window_bounds
from plateflow.plans.categories import (
    category_analysis,
    category_analysis_joined,
    category_conversion,
    revenue_kpi,
)
from plateflow.plans.devices import device_breakdown, device_dropoff, restaurant_device_pivot
from plateflow.plans.health import (
    clock_skew,
    ingest_error_alarm,
    ingest_rate_5min,
    ingest_summary,
    late_arrivals,
)
from plateflow.plans.hours import heatmap, hourly_trends
from plateflow.plans.items import popular_items
from plateflow.plans.registry import REPORTS
from plateflow.plans.sessions import session_funnel
from plateflow.plans.suite import window_days
from demo_tables import AS_OF, base_events, clickstream


def ids(df):
    return sorted(r["event_id"] for r in df.select("event_id").collect())


def test_month_window_keeps_a_whole_short_month(spark):
    events = event_frame(
        spark, [{"timestamp": at(d)} for d in ("2023-01-30", "2023-01-31", "2023-02-15", "2023-03-01")]
    )
    assert ids(arrival_window(events, "2023-03-01", 30)) == ["e1", "e2", "e3"]


def test_window_over_new_year(spark):
    days = ("2023-12-26", "2023-12-27", "2023-12-28", "2024-01-02", "2024-01-03", "2023-01-02",
            "2024-12-28")
    events = event_frame(spark, [{"timestamp": at(d)} for d in days])
    assert ids(arrival_window(events, date(2024, 1, 2), 7)) == ["e1", "e2", "e3"]


def test_window_bounds():
    assert window_bounds("2024-03-01", 2) == (date(2024, 2, 29), date(2024, 3, 1))
    with pytest.raises(ValueError):
        window_bounds("2024-03-01", 0)


def test_two_ids_with_one_name_are_two_rows(spark):
    events = event_frame(
        spark, [{"menu_item_id": i, "timestamp": at("2024-03-01")} for i in ("a", "b", "b")]
    )
    rows = rows_of(popular_items(events, "2024-03-01"))
    assert [(r["menu_item_name"], r["total_interactions"]) for r in rows] == [
        ("Four cheeses", 2), ("Four cheeses", 1),
    ]


def test_ties_are_cut_by_id(spark):
    events = event_frame(
        spark,
        [{"menu_item_id": f"i{n:02d}", "menu_item_name": f"n{n:02d}", "timestamp": at("2024-03-01")}
         for n in range(25)],
    )
    rows = rows_of(popular_items(events, "2024-03-01"))
    assert [r["menu_item_name"] for r in rows] == [f"n{n:02d}" for n in range(20)]


def test_revenue_counts_orders_only(spark):
    kinds = ("view", "click", "add_to_cart", "order", "order")
    events = event_frame(
        spark, [{"event_type": k, "price": 2.5, "timestamp": at("2024-03-01")} for k in kinds]
    )
    row = rows_of(popular_items(events, "2024-03-01"))[0]
    assert row["total_revenue"] == 5.0
    assert row["total_interactions"] == sum(
        row[c] for c in ("views", "clicks", "add_to_cart_count", "orders")
    )


def test_conversion_without_views_or_orders(spark):
    pairs = [("Pizza", "view"), ("Pizza", "view"), ("Pizza", "order"), ("Salads", "view"),
             ("Desserts", "order"), (None, "view"), (None, "order")]
    events = event_frame(
        spark, [{"category": c, "event_type": t, "timestamp": at("2024-03-01")} for c, t in pairs]
    )
    rows = rows_of(category_analysis(events, "2024-03-01"))
    rates = {r["category"]: r["conversion_rate"] for r in rows}
    assert rates == {"Pizza": 0.5, "Salads": 0.0, "Desserts": None, None: None}
    found = {r["category"]: r["conversion_rate"] for r in rows_of(category_conversion(events, "2024-03-01"))}
    assert found["Pizza"] == 0.5 and found["Salads"] == 0.0 and "Desserts" not in found


def test_window_and_join_forms_agree(spark, sf_dir):
    events = clickstream(spark, sf_dir)
    left, right = category_analysis(events, AS_OF), category_analysis_joined(events, AS_OF)
    columns = left.columns
    assert sorted(map(str, left.collect())) == sorted(map(str, right.select(columns).collect()))


def test_shares_sum_to_hundred(spark, sf_dir):
    rows = device_breakdown(clickstream(spark, sf_dir), AS_OF)
    for row in rows.groupBy("restaurant_id").agg(
        F.sum("percentage_of_restaurant_total").alias("s")
    ).collect():
        assert abs(row["s"] - 100) < 0.05


def test_one_conversion_rate_per_category(spark, sf_dir):
    rows = category_analysis(clickstream(spark, sf_dir), AS_OF).collect()
    rates = {}
    for row in rows:
        rates.setdefault(row["category"], set()).add(row["conversion_rate"])
    assert all(len(values) == 1 for values in rates.values())


def test_hour_needs_both_clocks_inside(spark):
    events = event_frame(
        spark,
        [
            {"timestamp": at("2024-03-04", 9)},
            {"timestamp": at("2024-02-01", 9), "ingested_at": at("2024-03-04")},
            {"timestamp": "soon", "ingested_at": at("2024-03-04")},
        ],
    )
    rows = rows_of(hourly_trends(events, "2024-03-05"))
    assert [(r["hour_of_day"], r["day_of_week"], r["day_num"], r["event_count"]) for r in rows] == [
        (9, "Monday", 1, 1)
    ]
    assert ids(late_arrivals(events, "2024-03-05")) == ["e1"]


def test_heatmap_leaves_empty_cells_null(spark):
    events = event_frame(spark, [{"timestamp": at("2024-03-04", 9)}])
    row = rows_of(heatmap(events, "2024-03-05"))[0]
    assert row["Monday"] == 1 and row["Sunday"] is None


def test_pivot_fills_zero(spark):
    row = rows_of(restaurant_device_pivot(event_frame(spark, [{"timestamp": at("2024-03-01")}])))[0]
    assert (row["mobile_events"], row["mobile_sessions"], row["tablet_events"]) == (1, 1, 0)


def test_funnel_ignores_client_time_order(spark):
    events = event_frame(
        spark,
        [
            {"event_type": "order", "timestamp": at("2024-03-01", 1)},
            {"event_type": "add_to_cart", "timestamp": at("2024-03-01", 5)},
            {"event_type": "click", "timestamp": at("2024-03-01", 2)},
            {"event_type": "view", "timestamp": at("2024-03-01", 9)},
            {"event_type": "order", "session_id": "s2", "timestamp": at("2024-03-01")},
        ],
    )
    row = rows_of(session_funnel(events))[0]
    assert [row[c] for c in ("viewed", "clicked", "carted", "ordered")] == [1, 1, 1, 1]


def test_kpi_compares_with_the_window_before(spark):
    days = {"2024-03-14": 30.0, "2024-03-08": 10.0, "2024-03-07": 20.0, "2024-03-01": 5.0,
            "2024-02-29": 99.0}
    events = event_frame(
        spark,
        [{"event_type": "order", "price": p, "timestamp": at(d)} for d, p in days.items()],
    )
    assert rows_of(revenue_kpi(events, "2024-03-14"))[0] == {
        "revenue": 40.0, "prior_revenue": 25.0, "change_pct": 60.0,
    }
    assert rows_of(revenue_kpi(events, "2020-01-01"))[0] == {
        "revenue": 0.0, "prior_revenue": 0.0, "change_pct": None,
    }


def test_silent_device_is_reported(spark):
    events = event_frame(
        spark,
        [{"timestamp": at("2024-03-05"), "device_type": "kiosk"}] * 2
        + [{"timestamp": at("2024-03-12"), "device_type": "web"}],
    )
    rows = {r["device_type"]: r for r in rows_of(device_dropoff(events, "2024-03-14"))}
    assert rows["kiosk"]["dropped"] and rows["kiosk"]["current_count"] == 0
    assert not rows["web"]["dropped"]


def test_skew_statistics(spark):
    events = event_frame(
        spark,
        [{"timestamp": at("2024-03-01", 12, n), "ingested_at": at("2024-03-01", 12, 10)}
         for n in range(21)]
        + [{"timestamp": "soon", "ingested_at": at("2024-03-01")}],
    )
    row = rows_of(clock_skew(events))[0]
    assert (row["events"], row["unparsed"], row["negative"]) == (22, 1, 10)
    assert (row["min_skew_s"], row["max_skew_s"], row["p95_skew_s"]) == (-600.0, 600.0, 540.0)


def test_leading_digits(spark):
    numbers = [0.0, 7.9, 999.0, 1000.0, 123456.7, -123456.7, 86400.0, 3.2e14]
    frame = spark.createDataFrame([(n,) for n in numbers], "n double")
    found = [r["d"] for r in frame.select(leading_digits(F.col("n")).alias("d")).collect()]
    assert found == [0, 7, 999, 1000, 123000, -123000, 86400, 320000000000000]


def _arrivals(spark, counts):
    """Rejected payloads by arrival minute, plus one accepted payload in minute 11."""
    texts, minutes = [], []
    for minute, count in counts.items():
        texts += ["junk"] * count
        minutes += [minute] * count
    texts.append(payload_text())
    minutes.append(11)
    frame = payload_frame(spark, texts)
    times = spark.createDataFrame([(n, m) for n, m in enumerate(minutes)], "row int, minute int")
    stamp = F.timestamp_add("MINUTE", F.col("minute"), F.to_timestamp(F.lit("2024-03-01 00:00:00")))
    return frame.join(times, "row").withColumn("ingested_at", stamp)


def test_alarm_threshold_and_missing_data(spark):
    judged = validate_events(_arrivals(spark, {0: 9, 5: 4, 9: 6}))
    rates = {str(r["window_start"])[11:16]: r for r in rows_of(ingest_rate_5min(judged))}
    assert {k: (r["invocations"], r["errors"], r["delivered"]) for k, r in rates.items()} == {
        "00:00": (9, 9, 0), "00:05": (10, 10, 0), "00:10": (1, 0, 1),
    }
    alarms = rows_of(ingest_error_alarm(judged))
    assert [str(r["window_start"])[11:16] for r in alarms] == ["00:05"]


def test_summary_warns_above_ten_percent(spark):
    texts = [payload_text()] * 9 + ["junk"]
    total = [
        r for r in rows_of(ingest_summary(validate_events(payload_frame(spark, texts))))
        if r["dimension"] == "total"
    ][0]
    assert (total["event_count"], total["rejected_pct"], total["warn"]) == (10, 10.0, False)
    texts.append("junk")
    total = [
        r for r in rows_of(ingest_summary(validate_events(payload_frame(spark, texts))))
        if r["dimension"] == "total"
    ][0]
    assert total["warn"]


def test_test_table_is_whole(spark, sf_dir):
    source = spark.read.parquet(f"{sf_dir}/events.parquet")
    assert base_events(spark, sf_dir).count() == source.count()


def test_rows_come_in_the_stated_order(spark):
    events = event_frame(
        spark,
        [
            {
                "timestamp": at("2024-03-01", n % 24),
                "category": ("Pizza", "Drinks", "Salads")[n % 3],
                "event_type": ("view", "order", "click", "add_to_cart")[n % 4],
                "device_type": ("web", "mobile", "kiosk", "web", "mobile")[n % 5],
                "restaurant_id": ("b", "a")[n % 2],
            }
            for n in range(60)
        ],
    )
    for report in (category_analysis, category_analysis_joined):
        rows = [(r.category, r.event_type) for r in report(events, "2024-03-01").collect()]
        assert rows == sorted(rows)
    rows = [(r.restaurant_id, -r.event_count, r.device_type) for r in device_breakdown(events, "2024-03-01").collect()]
    assert rows == sorted(rows) and len(rows) == 6
    rows = [(r.day_num, r.hour_of_day, r.event_type) for r in hourly_trends(events, "2024-03-01").collect()]
    assert rows == sorted(rows)


def test_window_ends_today_by_default(spark):
    now = datetime.now(timezone.utc)
    stamps = [now, now - timedelta(days=6), now - timedelta(days=8)]
    events = event_frame(spark, [{"timestamp": f"{s:%Y-%m-%dT%H:%M:%SZ}"} for s in stamps])
    assert popular_items(events).first()["total_interactions"] == 2


@pytest.mark.parametrize("name", [n for n, r in REPORTS.items() if window_days(r) is None])
def test_window_of_unbounded_reports(spark, name):
    """All of time by default, arrival days where these are given."""
    events = event_frame(spark, [{"timestamp": at(day), "session_id": day} for day in ("2024-01-01", "2024-03-01")])
    report = REPORTS[name]
    if inspect.signature(report).parameters["days"].default is not None:
        pytest.skip("its window is over event times")

    def rows(frame):
        return frame.drop("extra").collect()

    week, quarter = (rows(report(events, "2024-03-01", days=n)) for n in (7, 90))
    assert week != quarter and quarter == rows(report(events))


def test_unreadable_times_are_left_out(spark):
    events = event_frame(
        spark, [{"timestamp": at("2024-03-01", 5)}, {"timestamp": "soon", "ingested_at": at("2024-03-01")}]
    )
    for name in ("hourly_profile", "device_daily_trend", "category_daily_views"):
        assert REPORTS[name](events).count() == 1
    assert clock_skew(events).first()["unparsed"] == 1


def test_skew_below_a_second(spark):
    events = event_frame(
        spark,
        [{"timestamp": f"2024-03-01T00:00:00.{n:03d}Z", "ingested_at": "2024-03-01T00:00:01Z"} for n in range(1000)],
    )
    row = clock_skew(events).first()
    assert row["p95_skew_s"] == pytest.approx(0.951, rel=0.01)
    assert row["max_skew_s"] == 1.0 and row["min_skew_s"] == pytest.approx(0.001)
