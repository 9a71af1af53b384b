"""Readers: regex-delimited latin-1 lines, whitespace columns, meter and header CSV,
parquet tables and document collections."""
