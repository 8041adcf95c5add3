"""Menu clickstream analytics on Spark.

Sub-packages:

* ``sources``    payload source, event lake, quarantine, scan guard
* ``functions``  column expressions (JSON text, time, ratios)
* ``operators``  envelope, validation, enrichment, date windows
* ``plans``      the reports and the suite that runs them
* ``streaming``  continuous ingest and ingest-health metrics
"""

from plateflow.session import build_session, configure_session

__all__ = ["build_session", "configure_session"]
