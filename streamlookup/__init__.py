"""Enrich event tables and event streams from lookup tables, on Spark."""
