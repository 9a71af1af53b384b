"""Exact quantiles by selection (P10, P11, A17): no task and no driver holds a counter per distinct value.

Rank ``q (n - 1)`` and the next one are found by narrowing: the range that holds a rank is cut into
:data:`BINS` equal parts, the rows of each part are counted (with its least and greatest value), and the part
of the rank becomes the next range, until it holds one distinct value. Several ranks are narrowed in the
same passes. Each pass brings at most ``BINS`` rows a rank to the driver.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BINS = 1024


def order_statistics(df: DataFrame, col: str, ranks: Sequence[int]) -> dict[int, float]:
    """The values of the given ranks (from 0) among the non-missing values of ``col``, ascending."""
    values = df.select(F.col(col).cast("double").alias("v")).filter(F.col("v").isNotNull() & ~F.isnan("v"))
    lo, hi = values.agg(F.min("v"), F.max("v")).first()
    found: dict[int, float] = {}
    open_ = {r: (lo, hi, r) for r in ranks if lo is not None}  # range, rank within it
    while open_:
        for r, (a, b, _) in list(open_.items()):
            if a == b:
                found[r] = a
                del open_[r]
        if not open_:
            break
        spans = sorted({(a, b) for a, b, _ in open_.values()})
        v = F.col("v")
        cells = [
            F.when(v.between(a, b), F.struct(F.lit(i).alias("s"), F.least(F.lit(BINS - 1), F.floor((v / 2 - a / 2) / (b / 2 - a / 2) * BINS)).cast("int").alias("b")))
            for i, (a, b) in enumerate(spans)
        ]
        wanted = F.filter(F.array(*cells), lambda c: c.isNotNull())
        counted: dict[int, list] = {}
        rows = values.select("v", F.explode(wanted).alias("c")).groupBy("c.s", "c.b").agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("a"), F.max("v").alias("z"))
        for row in rows.collect():  # BINS a span
            counted.setdefault(row["s"], []).append((row["b"], row["n"], row["a"], row["z"]))
        for r, (a, b, k) in list(open_.items()):
            for _, n, low, high in sorted(counted[spans.index((a, b))]):
                if k < n:
                    open_[r] = (low, high, k)
                    break
                k -= n
    return found


def exact_quantiles(df: DataFrame, col: str, probabilities: Sequence[float]) -> list[float | None]:
    """Quantiles with linear interpolation between the two nearest ranks, as ``percentile`` gives; None without a value."""
    values = df.filter(F.col(col).isNotNull() & ~F.isnan(F.col(col).cast("double")))
    n = values.count()
    if not n:
        return [None for _ in probabilities]
    spots = [q * (n - 1) for q in probabilities]
    at = order_statistics(values, col, sorted({f(s) for s in spots for f in (math.floor, math.ceil)}))
    return [at[math.floor(s)] + (s - math.floor(s)) * (at[math.ceil(s)] - at[math.floor(s)]) for s in spots]
