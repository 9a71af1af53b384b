"""Writers (K1-K8, X2).

Single-file output (``single_file=True``) coalesces to one writer task and is
meant only for small final results (a top-k table, a rank list); everything
else is written in parallel, one file per task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _one(df: DataFrame, single_file: bool) -> DataFrame:
    return df.coalesce(1) if single_file else df


def write_csv(
    df: DataFrame,
    path: str,
    sep: str = ",",
    header: bool = True,
    mode: str = "overwrite",
    single_file: bool = False,
) -> None:
    """K3 / K4 / K5 / K7: CSV with header; quotes inside values are doubled.

    ``mode='append'`` adds files to an existing folder (K5). Array columns are
    written as JSON text.
    """
    cols = [
        F.to_json(F.col(f.name)).alias(f.name)
        if f.dataType.typeName() in ("array", "struct", "map")
        else F.col(f.name)
        for f in df.schema.fields
    ]
    (
        _one(df.select(*cols), single_file)
        .write.mode(mode)
        .option("header", str(header).lower())
        .option("sep", sep)
        .option("quote", '"')
        .option("escape", '"')
        .csv(path)
    )


def write_lines(
    df: DataFrame, columns: Sequence[str], path: str, sep: str = " ", single_file: bool = True
) -> None:
    """K6: one text line per row, ``columns`` joined by ``sep``."""
    line = F.concat_ws(sep, *[F.col(c).cast("string") for c in columns]).alias("value")
    _one(df.select(line), single_file).write.mode("overwrite").text(path)


def write_coded_lines(df: DataFrame, line: str, path: str, header: str | None = None, encoding: str = "ISO-8859-1") -> None:
    """Text lines (column ``line``) in an encoding, one file per task, each with the line
    ``header`` first: the input format of the regex-delimited sources. Nothing is quoted."""
    name = header or "value"
    (
        df.select(F.col(line).alias(name)).write.mode("overwrite").option("encoding", encoding).option("header", str(bool(header)).lower())
        .option("sep", "\u0001").option("quote", "").option("escape", "").option("escapeQuotes", "false").option("emptyValue", "")
        .option("ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false").csv(path)
    )


def append_batch(df: DataFrame, path: str, batch: str, keys: Sequence[str]) -> None:
    """K5: append rows as one batch (a string that names it), repeatable: rows of the batch
    whose keys are in the table already are left out, so an append that failed half-way or is
    run again adds nothing twice. Only the batch's own folder is read, and joined on the keys
    without collecting anything. Rows that the batch itself repeats are all written by one run, none by
    the next. A batch's rows must be the same on every run."""
    spark = df.sparkSession
    folder = f"{path.rstrip('/')}/batch={batch}"
    try:
        stored = spark.read.schema(df.schema).parquet(folder)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        stored = None
    if stored is not None:
        seen = stored.select(*[F.col(k).alias(f"_{k}") for k in keys]).distinct()
        same = F.lit(True)
        for k in keys:
            same = same & df[k].eqNullSafe(seen[f"_{k}"])
        df = df.join(seen, same, "left_anti")
    df.write.mode("append").parquet(folder)


def write_documents(docs: DataFrame, path: str, mode: str = "overwrite") -> None:
    """K2: the document collection as parquet, one folder per ``doc_type``."""
    docs.write.mode(mode).partitionBy("doc_type").parquet(path)


def write_tables(tables: Mapping[str, DataFrame], root: str, mode: str = "overwrite") -> None:
    """K1: load related tables (already constraint-checked) as parquet folders."""
    for name, df in tables.items():
        df.write.mode(mode).parquet(f"{root.rstrip('/')}/{name}")


def write_partitioned(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = (),
    sort_within: Sequence[str] = (),
    mode: str = "overwrite",
    rows_per_file: int = 2_000_000,
) -> None:
    """Physical layout - folders per ``partition_by`` value (e.g. year) and
    rows sorted within each file by ``sort_within`` (e.g. name), so filters on
    the partition column prune folders and parquet min/max stats prune row
    groups for the sort column.

    Rows are range-partitioned by both, in tasks of about ``rows_per_file`` rows: a value
    with many rows is cut into several files with ranges of the sort column, values with
    few rows share a task. (Rows that are equal in all these columns stay together.)"""
    out, by = df, [*partition_by, *sort_within]
    if by:
        out = out.repartitionByRange(max(1, -(-df.count() // rows_per_file)), *by).sortWithinPartitions(*by)
    writer = out.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def write_bucketed(df: DataFrame, table: str, path: str, keys: Sequence[str], buckets: int) -> DataFrame:
    """A table of the session's catalog whose files at ``path`` are bucketed and sorted by
    ``keys``. Tables with equally many buckets join on their keys without an exchange. Returns
    the table."""
    spark = df.sparkSession
    writer = df.repartition(buckets, *keys).write.mode("overwrite").option("path", path)
    writer.bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(table)
    return spark.table(table)


def show(df: DataFrame, n: int = 20) -> None:
    """K8: print the first rows."""
    df.show(n, truncate=False)
