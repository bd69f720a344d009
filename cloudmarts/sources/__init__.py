"""Readers: landing CSV/JSON, parquet zone tables, test-table domain views."""
