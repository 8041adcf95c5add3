import json

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from builders import VALID, payload, payload_frame, payload_text, rows_of
from plateflow.functions.json_text import float_label
from plateflow.operators.enrichment import enrich, event_records, quarantine_records
from plateflow.operators.validation import (
    accepted_events,
    acknowledge,
    rejected_events,
    validate_events,
)
from plateflow.schema import REQUIRED_FIELDS

NOT_JSON = (400, "body", "Request body is not valid JSON")
NOT_OBJECT = (400, "body", "Request body must be a JSON object")
OK = (200, None, None)
TYPES = "['add_to_cart', 'click', 'order', 'view']"
CATEGORIES = "['Burgers', 'Desserts', 'Drinks', 'Pizza', 'Salads']"
DEVICES = "['kiosk', 'mobile', 'tablet', 'web']"


def bad_type(shown):
    return (400, "event_type", f"Invalid event_type '{shown}'. Must be one of: {TYPES}")


def not_numeric(kind):
    return (400, "price", f"Field 'price' must be a numeric value, got: {kind}")


def not_positive(shown):
    return (400, "price", f"Field 'price' must be a positive number, got: {shown}")


CASES = [
    (payload_text(), OK),
    (json.dumps({"body": payload_text()}), OK),
    (json.dumps({"body": payload()}), OK),
    (json.dumps({"body": None, **payload()}), OK),
    ("  " + payload_text() + "\n ", OK),
    ("junk", NOT_JSON),
    ("", NOT_JSON),
    (payload_text() + " x", NOT_JSON),
    (payload_text() + payload_text(), NOT_JSON),
    (payload_text() + ",1", NOT_JSON),
    (payload_text() + "] x", NOT_JSON),
    (payload_text()[:-1], NOT_JSON),
    (json.dumps({"body": "junk"}), NOT_JSON),
    (json.dumps({"body": ""}), NOT_JSON),
    (json.dumps({"body": payload_text() + "}"}), NOT_JSON),
    (json.dumps({"body": 5}), NOT_JSON),
    (json.dumps({"body": True}), NOT_JSON),
    (json.dumps({"body": [1]}), NOT_JSON),
    (json.dumps({"body": "[1]"}), NOT_OBJECT),
    (json.dumps({"body": "5"}), NOT_OBJECT),
    (json.dumps({"body": "null"}), NOT_OBJECT),
    ("[1]", NOT_OBJECT),
    ("5", NOT_OBJECT),
    ("null", NOT_OBJECT),
    (payload_text(event_type="VIEW"), bad_type("VIEW")),
    (payload_text(event_type=" view"), bad_type(" view")),
    (payload_text(event_type=5), bad_type("5")),
    (payload_text(event_type=True), bad_type("True")),
    (payload_text(event_type=["view"]), bad_type('["view"]')),
    (
        payload_text(category="Sushi"),
        (400, "category", f"Invalid category 'Sushi'. Must be one of: {CATEGORIES}"),
    ),
    (
        payload_text(device_type="watch"),
        (400, "device_type", f"Invalid device_type 'watch'. Must be one of: {DEVICES}"),
    ),
    (payload_text(event_type="x", category="y"), bad_type("x")),
    (
        payload_text(event_type="x", device_type=...),
        (400, "device_type", "Missing required field: 'device_type'"),
    ),
    (
        payload_text(category="y", device_type="z"),
        (400, "category", f"Invalid category 'y'. Must be one of: {CATEGORIES}"),
    ),
    (payload_text(price="abc"), not_numeric("str")),
    (payload_text(price="1.0d"), not_numeric("str")),
    (payload_text(price="true"), not_numeric("str")),
    (payload_text(price="1_000"), not_numeric("str")),
    (payload_text(price="nan"), not_numeric("str")),
    (payload_text(price="inf"), not_numeric("str")),
    (payload_text(price="1e999"), not_numeric("str")),
    (payload_text(price=[1]), not_numeric("list")),
    (payload_text(price={}), not_numeric("dict")),
    (payload_text(price=0), not_positive("0.0")),
    (payload_text(price=-1), not_positive("-1.0")),
    (payload_text(price="-2"), not_positive("-2.0")),
    (payload_text(price=False), not_positive("0.0")),
    (payload_text(price="8.99"), OK),
    (payload_text(price=" 8.99 "), OK),
    (payload_text(price=".5"), OK),
    (payload_text(price=1e3), OK),
    (payload_text(price=True), OK),
    (payload_text(timestamp="soon"), OK),
    (payload_text(event_id=5), OK),
    (payload_text(user_id="u1", platform="ios"), OK),
    ('{"event_id":"first",' + payload_text()[1:], OK),
]
for name in REQUIRED_FIELDS:
    missing = (400, name, f"Missing required field: '{name}'")
    empty = (400, name, f"Required field '{name}' must not be null or empty")
    CASES.append((payload_text(**{name: ...}), missing))
    for value in (None, "", "   ", "\t\n", "  ", "\x1c"):
        CASES.append((payload_text(**{name: value}), empty))


@pytest.fixture(scope="module")
def judged(spark):
    return validate_events(payload_frame(spark, [text for text, _ in CASES])).persist()


def test_truth_table(judged):
    found = {r["row"]: (r["status"], r["field"], r["error"]) for r in rows_of(judged)}
    wrong = [
        (text, found[number], expected)
        for number, (text, expected) in enumerate(CASES)
        if found[number] != expected
    ]
    assert wrong == []


def test_accepted_and_rejected_are_the_whole(judged):
    assert accepted_events(judged).count() + rejected_events(judged).count() == len(CASES)


def test_prices_are_stored_as_numbers(spark):
    texts = [payload_text(price=p) for p in ("8.99", 1e3, True, " 2 ")]
    rows = rows_of(validate_events(payload_frame(spark, texts)))
    assert [r["price"] for r in sorted(rows, key=lambda r: r["row"])] == [8.99, 1000.0, 1.0, 2.0]


def test_last_of_duplicate_keys_counts(spark):
    text = '{"event_id":"first",' + payload_text(event_id="last")[1:]
    assert rows_of(validate_events(payload_frame(spark, [text])))[0]["event_id"] == "last"


def test_enrich_replaces_the_client_stamp_and_keeps_extras(spark):
    text = payload_text(ingested_at="1999-01-01", user_id="u1", platform="ios")
    now = F.lit("2024-03-05 07:08:09.5").cast("timestamp")
    row = rows_of(
        event_records(validate_events(enrich(payload_frame(spark, [text]), now))).withColumn(
            "extra", F.to_json("extra")
        )
    )[0]
    assert str(row["ingested_at"]) == "2024-03-05 07:08:09.500000"
    assert (row["year"], row["month"], row["day"], row["hour"]) == ("2024", "03", "05", "07")
    assert json.loads(row["extra"]) == {"platform": "ios", "user_id": "u1"}


@pytest.mark.parametrize(
    "text, expected",
    [
        ("2024-03-15T14:32:01.123Z", "2024-03-15 14:32:01.123000"),
        ("2024-03-15T14:32:01Z", "2024-03-15 14:32:01"),
        ("2024-03-15T14:32:01+02:00", "2024-03-15 12:32:01"),
        ("2024-03-15", "2024-03-15 00:00:00"),
        ("2024-02-30T00:00:00Z", "None"),
        ("12:30", "None"),
        ("T12:30", "None"),
        ("soon", "None"),
    ],
)
def test_event_time(spark, text, expected):
    frame = enrich(payload_frame(spark, [payload_text(timestamp=text)]))
    assert str(rows_of(event_records(validate_events(frame)).drop("extra"))[0]["event_ts"]) == expected


def test_quarantine_keeps_reason_excerpt_and_whole_text(spark):
    long_text = payload_text(event_type="x" * 500)
    frame = enrich(payload_frame(spark, [long_text, "junk"]))
    rows = {r["error_type"]: r for r in rows_of(quarantine_records(validate_events(frame)))}
    assert rows["domain"]["raw_excerpt"] == long_text[:200]
    assert rows["domain"]["value"] == long_text
    assert rows["domain"]["event_id"] == VALID["event_id"]
    assert rows["domain"]["restaurant_id"] == VALID["restaurant_id"]
    assert rows["not_json"]["event_id"] is None


def test_acknowledgement(spark):
    rows = rows_of(acknowledge(validate_events(payload_frame(spark, [payload_text(), "junk"]))))
    replies = {r["row"]: (r["status"], json.loads(r["body"])) for r in rows}
    assert replies[0] == (200, {"status": "ok", "event_id": "e1"})
    assert replies[1] == (400, {"error": NOT_JSON[2], "field": "body"})


NUMBERS = [-0.0, -1.0, -21.0, -2.5e-5, -1e-4, -0.001234, -1e7, -123456789.5, -1e15, -1e16, -1.5e300,
           -5e-324]


def test_float_labels(spark):
    frame = spark.createDataFrame([(n,) for n in NUMBERS], "n double")
    labels = {r["n"]: r["t"] for r in rows_of(frame.withColumn("t", float_label(F.col("n"))))}
    # The smallest denormal prints differently between language runtimes.
    for number in NUMBERS[:-1]:
        assert labels[number] == repr(number)


json_values = st.recursive(
    st.none() | st.booleans() | st.integers(-(10**6), 10**6) | st.text(max_size=6),
    lambda inner: st.lists(inner, max_size=2) | st.dictionaries(st.text(max_size=3), inner, max_size=2),
    max_leaves=3,
)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    st.lists(
        st.dictionaries(st.sampled_from(REQUIRED_FIELDS), json_values | st.just(...), max_size=3),
        min_size=20,
        max_size=40,
    )
)
def test_field_named_is_one_that_was_changed(spark, changes):
    """Any change is either accepted or blamed on a changed field."""
    texts = [payload_text(**change) for change in changes]
    for row in rows_of(validate_events(payload_frame(spark, texts)).drop("payload")):
        if row["status"] == 400:
            assert row["field"] in changes[row["row"]]
        else:
            assert row["error"] is None


def test_fields_are_read_as_texts_in_one_pass(spark):
    """No VARIANT of each field is built for rows that pass."""
    plan = validate_events(spark.createDataFrame([(payload_text(),)], "value string"))
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    assert "StructField(session_id,StringType,true)" in text
    assert "StructField(session_id,VariantType,true)" not in text
