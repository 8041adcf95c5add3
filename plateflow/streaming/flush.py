"""Ingest that flushes by size or by time, whichever comes first.

A trigger of Structured Streaming waits for its interval, however much has come.  Here a batch starts as
soon as the payload folder has grown by ``max_bytes``, and at the latest ``seconds`` after the one before
started.  Each flush is a run of the ingest with ``availableNow`` on the same checkpoint, so a flush that
was interrupted is repeated by the next one and lands once.

The backlog is the growth of the folder, one call to its file system whatever the number of files.  Files
of the folder that are deleted meanwhile make the growth look smaller; payloads then wait for the time.
"""

from __future__ import annotations

import time
from collections import Counter
from collections.abc import Callable
from dataclasses import dataclass
from threading import Event

from pyspark.sql import DataFrame, SparkSession

from plateflow.sources.files import Folder
from plateflow.streaming.ingest import IngestTarget, start_ingest

# Buffering of the delivery stage.
FLUSH_BYTES = 5 << 20
FLUSH_SECONDS = 60.0

START, SIZE, TIME = "start", "size", "time"


@dataclass(frozen=True)
class FlushPolicy:
    """When to flush, and how often to look."""

    max_bytes: int = FLUSH_BYTES
    seconds: float = FLUSH_SECONDS
    poll_seconds: float = 1.0


class FlushLoop:
    """Calls ``flush`` when the policy says so.

    The first look flushes at once: after a restart nobody knows how long payloads have waited.  A flush
    that fails raises, and its backlog counts on; a caller may go on with the loop or begin another.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        flush: Callable[[], None],
        policy: FlushPolicy = FlushPolicy(),
        clock: Callable[[], float] = time.monotonic,
    ) -> None:
        self.flushes: Counter[str] = Counter()
        self._folder, self._flush, self._policy, self._clock = Folder(spark, path), flush, policy, clock
        self._size: int | None = None
        self._since = clock()

    def due(self) -> str | None:
        """Why a flush is due now, or None."""
        return self._reason(self._folder.size())

    def _reason(self, size: int) -> str | None:
        if self._size is None:
            return START
        # A folder that was cleaned is measured from its lesser size on.
        self._size = min(self._size, size)
        if size - self._size >= self._policy.max_bytes:
            return SIZE
        return TIME if self._clock() - self._since >= self._policy.seconds else None

    def step(self) -> str | None:
        """Flush if it is due; returns the reason."""
        size, now = self._folder.size(), self._clock()
        reason = self._reason(size)
        if reason is not None:
            self._flush()
            # Measured before the flush: what came during it may count twice, never not at all.
            self._size, self._since = size, now
            self.flushes[reason] += 1
        return reason

    def run(self, stop: Event) -> None:
        """Step until ``stop`` is set, then flush what is left."""
        while not stop.is_set():
            if self.step() is None:
                stop.wait(self._policy.poll_seconds)
        self._flush()


def flushed_ingest(
    payloads: DataFrame,
    path: str,
    target: IngestTarget,
    policy: FlushPolicy = FlushPolicy(),
    clock: Callable[[], float] = time.monotonic,
    **options,
) -> FlushLoop:
    """The loop for a payload stream that reads the folder ``path``; ``options`` as for ``start_ingest``."""

    def flush() -> None:
        start_ingest(payloads, target, available_now=True, **options).awaitTermination()

    return FlushLoop(payloads.sparkSession, path, flush, policy, clock)
