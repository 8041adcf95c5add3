"""Continuous ingest and its metrics."""
