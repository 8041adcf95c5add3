"""Row-level operators: everything between a raw payload and a report."""
