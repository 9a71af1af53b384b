"""Writers: CSV (single file, custom separator, append), text lines, document
collections, constrained tables, partitioned and sorted layouts."""
