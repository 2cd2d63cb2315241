"""End-to-end jobs: ingestion, incremental load, star schema, marts, data quality."""
