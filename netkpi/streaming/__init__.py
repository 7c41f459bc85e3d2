"""Structured Streaming forms of the ingest and KPI operators."""
