"""Freight-load analytics on Spark: ingest, key checks, star schema, delivery reports."""
