"""Readers and writers: parquet tables, fixture views, request/result CSV files."""
