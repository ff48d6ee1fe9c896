"""Readers and writers: revision bundles, staged Parquet, JSON lines, JDBC."""
