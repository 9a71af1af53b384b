"""Table scans (S10, S11): parquet tables addressed by name under a folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# The shared test tables (one parquet file or folder per table).
TEST_TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def read_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """Scan ``{root}/{name}.parquet``. Projections and filters applied later are
    pushed into the parquet reader by Catalyst (``ReadSchema`` / ``PushedFilters``)."""
    return spark.read.parquet(f"{root.rstrip('/')}/{name}.parquet")


def read_documents(spark: SparkSession, path: str, doc_type: str | None = None) -> DataFrame:
    """Scan a document collection written by :func:`tessera.sinks.writers.write_documents`.

    With ``doc_type`` the partition folder is pruned at planning time.
    """
    df = spark.read.parquet(path)
    return df.filter(df.doc_type == doc_type) if doc_type else df
