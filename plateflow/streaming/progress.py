"""Batch durations of running streams, averaged per five minutes, and their table.

The listener keeps sums in the driver.  ``store`` appends what has come since the last time to a table
by day; sums and counts add up, so means hold over restarts and over several drivers.
"""

from __future__ import annotations

import threading
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQueryListener

PERIOD_SECONDS = 300

STORED = T.StructType(
    [
        T.StructField("query", T.StringType()),
        T.StructField("window_start", T.TimestampType()),
        T.StructField("batches", T.LongType()),
        T.StructField("total_ms", T.LongType()),
        T.StructField("day", T.StringType()),
    ]
)


class DurationListener(StreamingQueryListener):
    """Collects how long each micro-batch took.

    Keeps a sum and a count per query and period, never single batches.  Attach with
    ``spark.streams.addListener``.
    """

    def __init__(self) -> None:
        self._lock = threading.Lock()
        self._totals: dict[tuple[str, int], tuple[int, int]] = {}
        self._unstored: dict[tuple[str, int], tuple[int, int]] = {}

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        self.record(
            progress.name or str(progress.id),
            progress.timestamp,
            progress.durationMs.get("triggerExecution", 0),
        )

    def record(self, query: str, timestamp: str, milliseconds: int) -> None:
        moment = datetime.fromisoformat(timestamp.replace("Z", "+00:00"))
        period = int(moment.timestamp()) // PERIOD_SECONDS * PERIOD_SECONDS
        with self._lock:
            for totals in (self._totals, self._unstored):
                total, batches = totals.get((query, period), (0, 0))
                totals[(query, period)] = (total + milliseconds, batches + 1)

    def durations(self, spark: SparkSession) -> DataFrame:
        """``query, window_start, batches, mean_ms``, one row per query and period."""
        with self._lock:
            rows = [
                (query, datetime.fromtimestamp(period, timezone.utc), batches, total / batches)
                for (query, period), (total, batches) in self._totals.items()
            ]
        return spark.createDataFrame(
            rows, "query string, window_start timestamp, batches long, mean_ms double"
        )

    def store(self, spark: SparkSession, path: str) -> int:
        """Append what has come since the last call to the table at ``path``; returns the rows written.

        What can't be written stays for the next call.
        """
        with self._lock:
            taken, self._unstored = self._unstored, {}
        if not taken:
            return 0
        rows = []
        for (query, period), (total, batches) in taken.items():
            start = datetime.fromtimestamp(period, timezone.utc)
            rows.append((query, start, batches, total, f"{start:%Y-%m-%d}"))
        try:
            spark.createDataFrame(rows, STORED).coalesce(1).write.partitionBy("day").mode("append").parquet(path)
        except Exception:
            with self._lock:
                for key, (total, batches) in taken.items():
                    more, also = self._unstored.get(key, (0, 0))
                    self._unstored[key] = (total + more, batches + also)
            raise
        return len(rows)


def read_durations(spark: SparkSession, path: str) -> DataFrame:
    """``query, window_start, batches, mean_ms`` of all that was stored, restarts merged."""
    stored = spark.read.schema(STORED).parquet(path)
    totals = stored.groupBy("query", "window_start").agg(
        F.sum("batches").alias("batches"), F.sum("total_ms").alias("total_ms")
    )
    return totals.select("query", "window_start", "batches", (F.col("total_ms") / F.col("batches")).alias("mean_ms"))
