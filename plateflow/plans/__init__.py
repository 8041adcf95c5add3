"""Reports.  Each is ``report(events, as_of=None, **params) -> DataFrame`` and lazy."""
