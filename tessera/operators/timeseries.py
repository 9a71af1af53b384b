"""Calendar resampling, degree days and series shaping.

Resampling follows pandas ``resample``: bins are labelled (day, Sunday of a
Monday-Sunday week, last day of the month), every bin between the first and
the last one is emitted, and an empty bin has sum 0 while its mean/min/max
are missing. The bins are a grouped aggregate (map-side partials); the gap
bins come from a spine of labels generated per key from the key's first and
last label, so the spine grows with the time range, not with the data.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions import calendar as cal
from tessera.functions import weather as wx

AGG_KINDS = ("sum", "min", "max", "mean", "count")


def _agg(kind: str, col: str) -> Column:
    c = F.col(col)
    return {
        "sum": F.sum(c),
        "min": F.min(c),
        "max": F.max(c),
        "mean": F.avg(c),
        "count": F.count(c),
    }[kind]


def spine(bounds: DataFrame, grain: str, label: str = "label") -> DataFrame:
    """Labels from ``_lo`` to ``_hi`` (inclusive) per row of ``bounds``.

    With key columns the (small) bounds frame is first spread over tasks by key,
    so the labels of many keys are generated in parallel rather than by the one
    task that happens to hold the bounds."""
    if grain == "month":
        firsts = F.sequence(
            F.trunc("_lo", "month"), F.trunc("_hi", "month"), F.expr("INTERVAL 1 MONTH")
        )
        labels = F.transform(firsts, lambda d: F.last_day(d))
    else:
        labels = F.sequence(F.col("_lo"), F.col("_hi"), cal.step_for(grain))
    keys = [c for c in bounds.columns if c not in ("_lo", "_hi")]
    if keys:
        bounds = bounds.repartition(*keys)
    return bounds.select(*keys, F.explode(labels).alias(label))


def resample(
    df: DataFrame,
    ts: str,
    grain: str,
    aggs: Sequence[tuple[str, str, str]],
    keys: Sequence[str] = (),
    fill_gaps: bool = True,
    label: str = "label",
    extent: DataFrame | None = None,
) -> DataFrame:
    """Aggregate ``df`` into calendar bins of ``grain``.

    ``aggs`` are ``(output, kind, column)`` with kind in sum/min/max/mean/count.
    Sums and counts of gap bins are 0, the other aggregates NULL. ``extent``
    (``keys..., _lo, _hi`` labels) fixes the span of the gap bins instead of the
    data's own first and last bin, so a pre-filtered slice of a series gets
    exactly the bins the whole series would have in that range.
    """
    keys = list(keys)
    for _, kind, _ in aggs:
        if kind not in AGG_KINDS:
            raise ValueError(f"unknown aggregate {kind!r}")
    binned = df.withColumn(label, cal.label_for(grain, ts)).groupBy(*keys, label).agg(
        *[_agg(kind, col).alias(out) for out, kind, col in aggs]
    )
    if not fill_gaps:
        return binned
    bounds = (
        extent
        if extent is not None
        else binned.groupBy(*keys).agg(F.min(label).alias("_lo"), F.max(label).alias("_hi"))
    )
    full = spine(bounds, grain, label).join(binned, [*keys, label], "left")
    return full.select(
        *keys,
        label,
        *[
            F.coalesce(F.col(out), F.lit(0).cast(full.schema[out].dataType)).alias(out)
            if kind in ("sum", "count")
            else F.col(out)
            for out, kind, _ in aggs
        ],
    )


def label_extent(df: DataFrame, ts: str, grain: str, keys: Sequence[str] = ()) -> DataFrame:
    """First and last bin label of ``df`` (per key) as ``_lo`` / ``_hi``; reads
    only the key and time columns."""
    lab = cal.label_for(grain, ts)
    return df.groupBy(*keys).agg(F.min(lab).alias("_lo"), F.max(lab).alias("_hi"))


def join_on_time(left: DataFrame, right: DataFrame, on: str = "ts") -> DataFrame:
    """Inner join of two series on their time stamp (both sides keep every
    row of a repeated stamp, as an index join does)."""
    return left.join(right, on, "inner")


def with_degree_days(
    df: DataFrame,
    mean_c: str,
    hdd_above: str = "zero",
    cdd_above: str | None = "null",
) -> DataFrame:
    """Add ``mean_f`` and HDD (and CDD when ``cdd_above`` is given)."""
    out = df.withColumn("mean_f", wx.fahrenheit(mean_c)).withColumn(
        "hdd", wx.heating_degree_days("mean_f", above=hdd_above)
    )
    if cdd_above:
        out = out.withColumn("cdd", wx.cooling_degree_days("mean_f", above=cdd_above))
    return out


def hdd_by_period(
    daily: DataFrame,
    grain: str,
    day: str = "label",
    hdd: str = "hdd",
    keys: Sequence[str] = (),
) -> DataFrame:
    """Sum of daily HDD per week (days in ``(previous
    Sunday, Sunday]``) or per month, labelled like :func:`resample`."""
    return (
        daily.withColumn("_p", cal.label_for(grain, day))
        .groupBy(*keys, "_p")
        .agg(F.sum(hdd).alias("hdd"))
        .withColumnRenamed("_p", "label")
    )


def weekly_hdd_rule(weekly: DataFrame, hdd: str = "hdd", label: str = "label") -> DataFrame:
    """The first week has no predecessor and gets NULL; a zero weekly
    total becomes NULL. The first label is a scalar subquery (a global
    aggregate evaluated once), not a single-partition window."""
    first = weekly.select(F.min(label)).scalar()
    return weekly.withColumn(
        hdd,
        F.when(F.col(label) == first, F.lit(None).cast("double")).otherwise(
            F.nullif(F.col(hdd), F.lit(0.0))
        ),
    )


def backward_difference(
    df: DataFrame, value: str, partition: Sequence[str], order: str, name: str | None = None
) -> DataFrame:
    """``x - lag(x)`` within each partition (first row NULL)."""
    w = Window.partitionBy(*partition).orderBy(order)
    return df.withColumn(name or f"{value}_diff", F.col(value) - F.lag(value).over(w))


def quantile_threshold(df: DataFrame, col: str, q: float, approx: bool = False) -> DataFrame:
    """One-row frame with the ``q`` quantile of ``col`` (linear interpolation
    like pandas; exact unless ``approx``)."""
    agg = F.percentile_approx(col, q) if approx else F.percentile(col, q)
    return df.agg(agg.cast("double").alias("threshold"))


def coldest_days(daily: DataFrame, mean_col: str, q: float = 0.05, day: str = "label") -> DataFrame:
    """Days whose mean temperature is at or below the ``q`` quantile (the
    threshold is a scalar subquery)."""
    thr = quantile_threshold(daily, mean_col, q).scalar()
    return daily.filter(F.col(mean_col) <= thr).select(F.col(day).alias("date"))


def coldest_day_profiles(
    hourly: DataFrame, daily: DataFrame, mean_col: str, q: float = 0.05, ts: str = "ts"
) -> DataFrame:
    """T18 + T16 + T17: hourly rows of the coldest days with energy in MJ and
    the backward differences of energy and temperature within each day."""
    days = coldest_days(daily, mean_col, q)
    rows = hourly.withColumn("date", F.to_date(ts)).join(days, "date", "left_semi")
    rows = rows.withColumn("hour", F.hour(ts)).withColumn("mj", wx.kwh_to_mj("kwh"))
    rows = backward_difference(rows, "mj", ["date"], ts, "mj_h")
    return backward_difference(rows, "temp", ["date"], ts, "temp_h")


def heating_season(df: DataFrame, ts: str = "ts", months: Sequence[int] = (1, 2, 3, 4, 11, 12)) -> DataFrame:
    """Rows in the heating-season months, with hour and month columns."""
    return (
        df.withColumn("hour", F.hour(ts))
        .withColumn("month", F.month(ts))
        .filter(F.col("month").isin(list(months)))
    )


def seasonal_positions(df: DataFrame, label: str, by: str = "week") -> DataFrame:
    """``year`` and position within the year (T6 week number or month)
    for each labelled row, so series of several years overlay on one axis."""
    pos = cal.week_number(label) if by == "week" else F.month(label)
    return df.withColumn("year", F.year(label)).withColumn("position", pos)


def slice_between(df: DataFrame, ts: str, start: Column, end: Column) -> DataFrame:
    """Rows with ``start <= ts <= end``."""
    return df.filter(F.col(ts).between(start, end))
