"""Running reports together, fetching their first rows and storing their results."""

from __future__ import annotations

import inspect
import uuid
from collections.abc import Callable, Iterable
from concurrent.futures import Future, ThreadPoolExecutor
from concurrent.futures import TimeoutError as WaitTimeout
from contextlib import nullcontext
from dataclasses import dataclass, field
from datetime import date
from time import monotonic, time_ns

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

from plateflow.operators.windows import as_date
from plateflow.plans.registry import CORE_REPORTS, REPORTS
from plateflow.sources.files import Folder
from plateflow.sources.guard import ReadLimit, check_scan, counted_reads, guard_scan, plan_scan_bytes

# Rows shown per report and seconds a report may take.
FETCH_ROWS = 30
MAX_WAIT_SECONDS = 120

# Seconds to wait for a report that was told to stop.
STOP_SECONDS = 30
# Reports that compare a window with the one before.
WINDOWS_READ = {"device_dropoff": 2}
# Reports whose window is over event times, so they read the whole lake.
BY_EVENT_TIME = {"item_interactions", "revenue_by_item", "revenue_kpi"}

SUCCEEDED, FAILED, TIMED_OUT = "SUCCEEDED", "FAILED", "TIMEOUT"


@dataclass
class ReportResult:
    """Outcome of one report: its state, and either rows or a reason.

    ``truncated`` says that the report has more rows than were fetched.
    """

    name: str
    status: str
    columns: list[str] = field(default_factory=list)
    rows: list[list[str]] = field(default_factory=list)
    error: str | None = None
    seconds: float = 0.0
    truncated: bool = False


@dataclass
class Fetched:
    """Column names and rows as text."""

    columns: list[str]
    rows: list[list[str]]
    truncated: bool = False


def fetch(df: DataFrame, max_rows: int | None = FETCH_ROWS) -> Fetched:
    """The first rows as text, NULL as the empty text; all rows where ``max_rows`` is None."""
    rows = df.collect() if max_rows is None else df.limit(max_rows + 1).collect()
    truncated = max_rows is not None and len(rows) > max_rows
    texts = [["" if value is None else str(value) for value in row] for row in rows[:max_rows]]
    return Fetched(df.columns, texts, truncated)


def write_report(df: DataFrame, name: str, out: str) -> str:
    """Store a new version of a report; readers see it once it is complete.

    The version before stays for readers that are still busy with it, older ones are deleted.
    """
    folder = Folder(df.sparkSession, f"{out.rstrip('/')}/{name}")
    version = f"v{time_ns():020d}"
    df.write.parquet(f"{folder.path}/{version}")
    for old in _versions(folder)[:-2]:
        folder.delete(old)
    return f"{folder.path}/{version}"


def _versions(folder: Folder) -> list[str]:
    """Complete versions, oldest first."""
    return [v for v in folder.names() if v.startswith("v") and folder.exists(f"{v}/_SUCCESS")]


def read_report(spark: SparkSession, name: str, out: str) -> DataFrame:
    """The latest complete version of a stored report."""
    folder = Folder(spark, f"{out.rstrip('/')}/{name}")
    versions = _versions(folder)
    if not versions:
        raise FileNotFoundError(f"no stored result of {name} in {out}")
    return spark.read.parquet(f"{folder.path}/{versions[-1]}")


def register_report_view(df: DataFrame, name: str) -> DataFrame:
    """Make a report a relation for SQL datasets."""
    df.createOrReplaceTempView(name)
    return df


def _stop(spark: SparkSession, tag: str, future: Future) -> ReportResult | None:
    """Cancel the jobs of a tag until their report ends, for ``STOP_SECONDS`` at most.

    A report may still be about to start a job, or busy outside of jobs, listing folders.  After the
    limit it is left alone and its outcome is not waited for.
    """
    started = monotonic()
    while monotonic() - started < STOP_SECONDS:
        spark.sparkContext.cancelJobsWithTag(tag)
        try:
            return future.result(timeout=0.5)
        except WaitTimeout:
            continue
    return None


def _run_together(
    spark: SparkSession,
    names: Iterable[str],
    work: Callable[[str], Fetched],
    max_wait: float | None,
    read_limit: int | None = None,
) -> list[ReportResult]:
    """One driver thread per report, so their jobs share the cluster; each report's jobs carry a
    tag by which a report over its time is stopped."""
    run = uuid.uuid4().hex
    names = list(names)
    if not names:
        return []

    def one(name: str) -> ReportResult:
        started = monotonic()
        tag = f"{run}-{name}"
        limit = ReadLimit(spark, tag, read_limit) if read_limit is not None else None
        spark.sparkContext.addJobTag(tag)
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", name)
        try:
            with limit or nullcontext():
                got = work(name)
            result = ReportResult(name, SUCCEEDED, got.columns, got.rows, truncated=got.truncated)
        except Exception as problem:
            stopped = limit is not None and limit.exceeded
            reason = f"query has read more than {read_limit} bytes" if stopped else str(problem)
            result = ReportResult(name, FAILED, error=reason)
        finally:
            spark.sparkContext.removeJobTag(tag)
        result.seconds = monotonic() - started
        return result

    results = []
    pool = ThreadPoolExecutor(len(names))
    started = monotonic()
    pending = {name: pool.submit(inheritable_thread_target(spark)(one), name) for name in names}
    for name, future in pending.items():
        try:
            left = None if max_wait is None else max(0.0, max_wait - (monotonic() - started))
            results.append(future.result(timeout=left))
        except WaitTimeout:
            stopped = _stop(spark, f"{run}-{name}", future)
            if stopped is None or stopped.status != SUCCEEDED:
                stopped = ReportResult(name, TIMED_OUT, error=f"no result within {max_wait} s")
                stopped.seconds = monotonic() - started
            results.append(stopped)
    pool.shutdown(wait=False)
    return results


def window_days(report: Callable[..., DataFrame]) -> int | None:
    """Arrival days that a report reads by default; None for the whole lake."""
    days = inspect.signature(report).parameters.get("days")
    if days is None or days.default is None or report.__name__ in BY_EVENT_TIME:
        return None
    return days.default * WINDOWS_READ.get(report.__name__, 1)


def run_reports(
    spark: SparkSession,
    events: DataFrame,
    names: Iterable[str] | None = None,
    as_of: date | str | None = None,
    max_rows: int | None = FETCH_ROWS,
    max_wait: float | None = MAX_WAIT_SECONDS,
    reports: dict[str, Callable[..., DataFrame]] | None = None,
    max_bytes: int | None = None,
    lake: str | None = None,
    scan_limit: int | None = None,
) -> list[ReportResult]:
    """Run reports at the same time and return the first rows of each.

    One report's failure does not affect the others.  Without names the core suite runs; for
    ``INGEST_REPORTS`` give these as ``reports`` and validated payloads as ``events``.  With
    ``max_bytes`` a report fails before it starts if its window of ``lake``, the folder of the events,
    has more bytes.  With ``scan_limit`` it fails if the files that its plan opens have more, whatever its
    filters are, and is stopped if it has read more than that.
    """
    if max_bytes is not None and lake is None:
        raise ValueError("max_bytes needs the lake's folder")
    day = as_date(as_of)
    known = REPORTS if reports is None else reports
    chosen = list(CORE_REPORTS if names is None else names)
    unknown = [name for name in chosen if name not in known]
    if unknown:
        raise ValueError(f"unknown reports: {', '.join(unknown)}")

    def work(name: str) -> Fetched:
        if max_bytes is not None:
            guard_scan(spark, lake, day, window_days(known[name]), max_bytes)
        report = known[name](events, day)
        if scan_limit is not None:
            check_scan(plan_scan_bytes(report), scan_limit)
        return fetch(report, max_rows)

    with counted_reads(spark) if scan_limit is not None else nullcontext():
        return _run_together(spark, chosen, work, max_wait, scan_limit)


def refresh_report_tables(
    spark: SparkSession,
    events: DataFrame,
    out: str,
    names: Iterable[str] | None = None,
    as_of: date | str | None = None,
    max_wait: float | None = None,
    reports: dict[str, Callable[..., DataFrame]] | None = None,
) -> list[ReportResult]:
    """Recompute reports and store a new version of each below ``out``.

    A report that fails or is stopped leaves the version before as it was.
    """
    day = as_date(as_of)
    chosen = list(CORE_REPORTS if names is None else names)

    known = REPORTS if reports is None else reports

    def work(name: str) -> Fetched:
        return Fetched(["path"], [[write_report(known[name](events, day), name, out)]])

    return _run_together(spark, chosen, work, max_wait)
