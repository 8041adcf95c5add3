"""Scan guard: refuse a report whose input files exceed a size limit, or stop it when it has read more.

``plan_scan_bytes`` asks the plan: it holds for any filter and any table, and counts the files that are
left after partition pruning.  Files of columns that a report doesn't need count there, but not in
``ReadLimit``, which adds up what its jobs have read in fact.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from datetime import date, timedelta
from threading import Event, Thread

from pyspark.sql import DataFrame, SparkSession

from plateflow.operators.windows import window_bounds
from plateflow.sources.files import Folder

# Fixed value: bytes one report may read.
SCAN_LIMIT = 104_857_600

# Vectored reads of Parquet run in threads whose bytes no task counts.
VECTORED_READS = "parquet.hadoop.vectored.io.enabled"

# Seconds between two looks at what a report has read.
POLL_SECONDS = 0.5


class ScanLimitExceeded(RuntimeError):
    """The files a report would read are larger than allowed."""


def lake_scan_bytes(
    spark: SparkSession, path: str, as_of: date | str | None = None, days: int | None = None
) -> int:
    """Bytes of the files below a lake path, of the given arrival window or of everything.

    A window lists its own day folders only.  Without one every folder is listed; sizes are added up
    one by one and not kept.
    """
    if days is None:
        return sum(size for _, size in Folder(spark, path).files())
    start, end = window_bounds(as_of, days)
    folders = (start + timedelta(days=n) for n in range((end - start).days + 1))
    return sum(
        size
        for day in folders
        for _, size in Folder(spark, f"{path.rstrip('/')}/{day:year=%Y/month=%m/day=%d}").files()
    )


def check_scan(size: int, max_bytes: int = SCAN_LIMIT) -> int:
    if size > max_bytes:
        raise ScanLimitExceeded(f"query would read {size} bytes, limit is {max_bytes}")
    return size


def guard_scan(
    spark: SparkSession,
    path: str,
    as_of: date | str | None = None,
    days: int | None = None,
    max_bytes: int = SCAN_LIMIT,
) -> int:
    """Bytes a query over a window of a lake would read; refuses more than the limit."""
    return check_scan(lake_scan_bytes(spark, path, as_of, days), max_bytes)


def _scans(plan) -> list:
    """The file scans of a physical plan and its subqueries; a subquery that it uses twice runs once."""
    found, subqueries = [], set()
    nodes = [plan]
    while nodes:
        node = nodes.pop()
        kind = node.getClass().getSimpleName()
        if kind == "AdaptiveSparkPlanExec":
            nodes.append(node.executedPlan())
            continue
        if kind == "FileSourceScanExec":
            found.append(node)
        children, inner = node.children(), node.subqueries()
        nodes.extend(children.apply(k) for k in range(children.size()))
        for subquery in (inner.apply(k) for k in range(inner.size())):
            if subquery.name() not in subqueries:
                subqueries.add(subquery.name())
                nodes.append(subquery.child())
    return found


def plan_scan_bytes(df: DataFrame) -> int:
    """Bytes of the files that a DataFrame's scans would open, after partition pruning.

    A table that is scanned twice counts twice.  Nothing is run.
    """
    plan = df._jdf.queryExecution().executedPlan()
    return sum(scan.selectedPartitions().totalFileSize() for scan in _scans(plan))


@contextmanager
def counted_reads(spark: SparkSession) -> Iterator[None]:
    """Parquet scans that start in here read in the task's own thread, so that all their bytes count."""
    before = spark.conf.get(VECTORED_READS, None)
    spark.conf.set(VECTORED_READS, "false")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(VECTORED_READS)
        else:
            spark.conf.set(VECTORED_READS, before)


class ReadLimit:
    """Stops the jobs of a tag once they have read more than a limit.

    Used as a context around the jobs, inside of ``counted_reads`` if they read Parquet.  ``exceeded`` says whether it has stopped them; what the running
    tasks read until then comes on top of the limit.
    """

    def __init__(self, spark: SparkSession, tag: str, max_bytes: int) -> None:
        self.exceeded = False
        self._context, self._tag, self._max_bytes = spark.sparkContext, tag, max_bytes
        self._ended = Event()
        self._thread = Thread(target=self._watch, daemon=True)

    def __enter__(self) -> ReadLimit:
        self._thread.start()
        return self

    def __exit__(self, *problem) -> None:
        self._ended.set()
        self._thread.join()

    def read(self) -> int:
        """Bytes that the jobs of the tag have read so far; a stage they share counts once."""
        context = self._context._jsc.sc()
        store = context.statusStore()
        stages = set()
        for job in context.statusTracker().getJobIdsForTag(self._tag):
            ids = store.job(job).stageIds()
            stages.update(ids.apply(k) for k in range(ids.size()))
        return sum(store.lastStageAttempt(stage).inputBytes() for stage in stages)

    def _watch(self) -> None:
        while not self._ended.wait(POLL_SECONDS):
            try:
                over = self.read() > self._max_bytes
            except Exception:
                # A stage may not be known yet, or not any more.
                continue
            if over:
                self.exceeded = True
                self._context.cancelJobsWithTag(self._tag)
