"""The alarm as a state machine: a stream of its transitions.

Rejected payloads are counted per five minutes and alarm, partly before the shuffle; few rows go on.  Each
alarm keeps its state and the last period it knows in the state store.  A period with ``threshold``
errors or more is ``ALARM``, one with fewer ``OK``; a period without any payload counts as the state
``missing``, by default ``OK``: missing data doesn't breach.  A period that is past the watermark and had
no rows is noticed by a timer, also while only other alarms get payloads.  A row comes out for each
change of state, from the first period on.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from datetime import datetime, timedelta, timezone

from pyspark import cloudpickle
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from plateflow.operators.validation import REJECTED
from plateflow.plans.health import ALARM_ERRORS, METRIC_PERIOD
from plateflow.streaming.ingest import ROCKS_DB, STATE_STORE

# The processor travels with its tasks, so executors need not have this library.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

OK, ALARM, NO_DATA = "OK", "ALARM", "INSUFFICIENT_DATA"
PERIOD = timedelta(minutes=5)
_CHANGE = Row("alarm", "at", "old_state", "new_state", "errors")
TRANSITIONS = "alarm string, at timestamp, old_state string, new_state string, errors bigint"


def transitions_of(
    state: str | None, last: datetime | None, periods: list[tuple[datetime, int]], threshold: int, missing: str
) -> tuple[str | None, datetime | None, list[tuple[datetime, str | None, str, int]]]:
    """State and last period after some more periods in order, and the changes on the way."""
    changes = []

    def turn(at: datetime, new: str, errors: int) -> None:
        nonlocal state
        if new != state:
            changes.append((at, state, new, errors))
            state = new

    for start, errors in periods:
        if last is not None and start > last + PERIOD:
            turn(last + PERIOD, missing, 0)
        turn(start, ALARM if errors >= threshold else OK, errors)
        last = start
    return state, last, changes


class AlarmProcessor(StatefulProcessor):
    """State and last period of each alarm."""

    def __init__(self, threshold: int, missing: str) -> None:
        self._threshold, self._missing = threshold, missing

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        self._state = handle.getValueState("alarm", "state string, last timestamp")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        state, last = self._known()
        periods = sorted((self._utc(row["start"]), row["errors"]) for row in rows)
        state, last, changes = transitions_of(state, last, periods, self._threshold, self._missing)
        self._state.update((state, last))
        for timer in list(self._handle.listTimers()):
            self._handle.deleteTimer(timer)
        # The next period is over, and has no rows, once the watermark has passed its end.
        self._handle.registerTimer(int((last + 2 * PERIOD).timestamp() * 1000))
        for change in changes:
            yield _CHANGE(key[0], *change)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        state, last = self._known()
        if state != self._missing:
            self._state.update((self._missing, last))
            yield _CHANGE(key[0], last + PERIOD, state, self._missing, 0)

    def _known(self) -> tuple[str | None, datetime | None]:
        if not self._state.exists():
            return None, None
        state, last = self._state.get()
        return state, self._utc(last)

    @staticmethod
    def _utc(moment: datetime) -> datetime:
        return moment if moment.tzinfo else moment.astimezone(timezone.utc)

    def close(self) -> None:
        pass


def alarm_transitions(
    validated: DataFrame,
    by: str | None = None,
    threshold: int = ALARM_ERRORS,
    missing: str = OK,
    watermark: str = "10 minutes",
) -> DataFrame:
    """``alarm, at, old_state, new_state, errors`` of each change, for a stream of validated payloads.

    There is one alarm, or one for each value of the column ``by``.
    """
    validated.sparkSession.conf.set(STATE_STORE, ROCKS_DB)
    alarm = F.lit("all") if by is None else F.coalesce(F.col(by), F.lit("unknown"))
    counted = (
        validated.select("ingested_at", "status", alarm.alias("alarm"))
        .withWatermark("ingested_at", watermark)
        .groupBy("alarm", F.window("ingested_at", METRIC_PERIOD))
        .agg(F.count_if(F.col("status") == REJECTED).alias("errors"))
        .select("alarm", "errors", "window.start", F.window_time("window").alias("seen_at"))
    )
    return counted.groupBy("alarm").transformWithState(
        AlarmProcessor(threshold, missing), TRANSITIONS, "append", "eventTime"
    )
