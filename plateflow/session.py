"""Session settings the library depends on."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Hours, days and partition folders are UTC.  Of duplicate JSON keys the last one counts.
REQUIRED_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.variant.allowDuplicateKeys": "true",
}


def configure_session(spark: SparkSession) -> SparkSession:
    """Apply the settings every report and the validator rely on."""
    for key, value in REQUIRED_SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def build_session(app_name: str = "plateflow", **settings: str) -> SparkSession:
    """A session for jobs: adaptive execution on, fair pools for concurrent reports.

    Shuffle partition counts are left to the cluster; adaptive execution coalesces small ones.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.scheduler.mode", "FAIR")
    )
    for key, value in {**REQUIRED_SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return configure_session(builder.getOrCreate())
