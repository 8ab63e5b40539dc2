"""Vector search evaluation on Spark: search, scoring, ingest and result analytics as DataFrame jobs."""
