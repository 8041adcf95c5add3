import json
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from builders import payload_text, rows_of
from plateflow.operators.validation import validate_events
from plateflow.streaming.alarm import ALARM, NO_DATA, OK, PERIOD, alarm_transitions, transitions_of
from plateflow.streaming.metrics import start_metric

START = datetime(2024, 3, 1, tzinfo=timezone.utc)


def periods(*errors_at):
    return [(START + n * PERIOD, errors) for n, errors in errors_at]


def test_states_by_period():
    state, last, changes = transitions_of(None, None, periods((0, 0), (1, 3), (2, 2), (3, 1), (7, 2)), 2, OK)
    assert (state, last) == (ALARM, START + 7 * PERIOD)
    assert [(at, new) for at, _, new, _ in changes] == [
        (START, OK), (START + PERIOD, ALARM), (START + 3 * PERIOD, OK), (START + 7 * PERIOD, ALARM),
    ]


def test_missing_periods_have_a_state_of_their_own():
    found = transitions_of(ALARM, START, periods((2, 5), (3, 0)), 2, NO_DATA)[2]
    assert [(old, new, errors) for _, old, new, errors in found] == [
        (ALARM, NO_DATA, 0), (NO_DATA, ALARM, 5), (ALARM, OK, 0),
    ]


def stream(spark, folder, rows):
    """Payloads as ``(minute, restaurant, valid)``, read as a stream of files."""
    folder.mkdir(exist_ok=True)
    lines = [
        json.dumps({"minute": m, "value": payload_text(restaurant_id=r, **({} if valid else {"price": 0}))})
        for m, r, valid in rows
    ]
    (folder / f"{len(list(folder.iterdir()))}.json").write_text("\n".join(lines) + "\n")
    read = spark.readStream.schema("minute int, value string").json(str(folder))
    start = F.to_timestamp(F.lit("2024-03-01 00:00:00"))
    return validate_events(read.withColumn("ingested_at", F.timestamp_add("MINUTE", F.col("minute"), start)))


def found_in(spark, out):
    rows = rows_of(spark.read.parquet(out))
    minutes = {r["at"]: int((r["at"].replace(tzinfo=timezone.utc) - START) / timedelta(minutes=1)) for r in rows}
    return sorted((r["alarm"], minutes[r["at"]], r["old_state"], r["new_state"], r["errors"]) for r in rows)


def test_transitions_over_batches_and_restarts(spark, tmp_path):
    """The harbour falls silent in alarm while the market goes on; its timer notices that."""
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")
    batches = [
        [(0, "harbour", True), (6, "harbour", False), (7, "harbour", False), (1, "market", True)],
        [(n, "market", True) for n in range(10, 60, 5)],
        [(n, "market", n != 70) for n in range(60, 90, 5)],
        [(100, "harbour", True), (101, "market", True), (150, "market", True)],
    ]
    for rows in batches:
        judged = stream(spark, tmp_path / "in", rows)
        changes = alarm_transitions(judged, "restaurant_id", 2, NO_DATA)
        start_metric(changes, out, checkpoint, available_now=True).awaitTermination()
    found = found_in(spark, out)
    harbour = [row[1:] for row in found if row[0] == "harbour"]
    assert harbour == [
        (0, None, OK, 0), (5, OK, ALARM, 2), (10, ALARM, NO_DATA, 0), (100, NO_DATA, OK, 0), (105, OK, NO_DATA, 0),
    ]
    market = [row[1:] for row in found if row[0] == "market"]
    assert market[0] == (0, None, OK, 0) and (5, OK, NO_DATA, 0) in market and (10, NO_DATA, OK, 0) in market
    assert all(new != ALARM for _, _, new, _ in market)


@pytest.mark.parametrize("threshold, states", [(10, [OK]), (1, [ALARM, OK])])
def test_one_alarm_for_all(spark, tmp_path, threshold, states):
    judged = stream(spark, tmp_path / "in", [(0, "harbour", False), (30, "market", True)])
    out = str(tmp_path / "out")
    changes = alarm_transitions(judged, threshold=threshold)
    start_metric(changes, out, str(tmp_path / "checkpoint"), available_now=True).awaitTermination()
    assert [row[3] for row in found_in(spark, out)] == states
