"""Incremental market-data pipelines as Spark jobs: tolerant ingest, keyed upserts, control tables and reports."""
