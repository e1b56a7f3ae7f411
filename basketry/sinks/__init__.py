"""Sinks: versioned Parquet tables."""
