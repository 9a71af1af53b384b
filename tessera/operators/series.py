"""Lag and running sum of one long series without a group.

A window without a partition sorts the series in one task. Here the series is range-partitioned by
time (and what tells rows of one time apart), and written once with the number of each row's
range; the window runs inside each range, and what crosses from range to range, the last
value and the sum so far, is carried over by a small table of one row per range.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.session import stored

#: Rows of a range, about, and ranges at most.
ROWS, MOST = 200_000, 16_384


def ranged_series(df: DataFrame, order: Sequence[str], rows: int | None = None) -> DataFrame:
    """``df``, written, with ``_range``: ranges of the order of about ``rows`` rows, ascending. Only rows
    that are equal in all of ``order`` must share a range."""
    parts = min(MOST, max(1, -(-df.count() // (rows or ROWS))))
    return stored(df.repartitionByRange(parts, *order).withColumn("_range", F.spark_partition_id().cast("bigint")), "series")


def scan_series(df: DataFrame, at: str, value: str, ties: Sequence[str] = (), rows: int | None = None) -> DataFrame:
    """``df`` with ``previous`` (the value before, in the order of ``at`` and ``ties``), ``difference``
    (backward) and ``running`` (sum so far; a missing value adds nothing). Rows without a time are
    left out; rows of one time that ``ties`` do not tell apart come in any order."""
    order = [at, *ties]
    names = df.columns
    df = ranged_series(df.filter(F.col(at).isNotNull()), order, rows)
    carried = df.groupBy("_range").agg(F.max_by(F.struct(value), F.struct(*order)).alias("last"), F.sum(value).alias("total")).collect()
    before, total, carries = None, 0.0, []
    for r in sorted(carried, key=lambda r: r["_range"]):  # a row per range
        carries.append((r["_range"], before, float(total)))
        before, total = float(r["last"][0]) if r["last"][0] is not None else None, total + (r["total"] or 0)
    carry = df.sparkSession.createDataFrame(carries, "_c bigint, _before double, _total double")
    inside = Window.partitionBy("_range").orderBy(*order)
    sofar = F.coalesce(F.sum(value).over(inside.rowsBetween(Window.unboundedPreceding, 0)), F.lit(0.0))
    here = df.withColumns({"_nth": F.row_number().over(inside), "_lag": F.lag(value).over(inside), "_sum": sofar})
    joined = here.join(F.broadcast(carry), F.col("_range") == F.col("_c"))
    previous = F.when(F.col("_nth") == 1, F.col("_before")).otherwise(F.col("_lag").cast("double"))
    return joined.select(*names, previous.alias("previous"), (F.col(value) - previous).alias("difference"), (F.col("_total") + F.col("_sum")).alias("running"))
