"""Meter readings joined with weather observations, and the day / week / month
frames built from them (J4, T1-T4, T7-T11, T15).

``readings``: ``(ts, kwh)`` meter readings; ``observations``: ``(ts, temp, wspd)``
weather observations (deg C, wind speed). Readings are summed per hour (a meter
hour without readings is 0 kWh); observations are averaged per hour and only
observed hours exist, so the inner join keeps the hours with weather.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions import weather as wx
from tessera.operators import timeseries as ts

PERIOD_AGGS = [
    ("kwh_sum", "sum", "kwh"),
    ("temp_min", "min", "temp"),
    ("temp_max", "max", "temp"),
    ("temp_mean", "mean", "temp"),
]


def hourly(
    readings: DataFrame,
    observations: DataFrame,
    start: Column | None = None,
    end: Column | None = None,
) -> DataFrame:
    """J4 + T15: hourly usage joined with hourly weather, plus wind chill.

    With ``start`` / ``end`` (hour stamps, both included) only that slice is
    built: both inputs are filtered on their own time stamp (pushed into the
    scans), and the meter's gap bins are clipped to the whole series' first and
    last hour, so the slice equals the same rows of the full frame.
    """
    r, o = readings, observations
    extent = None
    if start is not None and end is not None:
        whole = ts.label_extent(r, "ts", "hour")
        extent = whole.select(F.greatest("_lo", start).alias("_lo"), F.least("_hi", end).alias("_hi"))
        upper = end + F.expr("INTERVAL 1 HOUR")
        r = r.filter((F.col("ts") >= start) & (F.col("ts") < upper))
        o = o.filter((F.col("ts") >= start) & (F.col("ts") < upper))
    usage = ts.resample(r, "ts", "hour", [("kwh", "sum", "kwh")], extent=extent)
    weather = ts.resample(
        o, "ts", "hour", [("temp", "mean", "temp"), ("wspd", "mean", "wspd")], fill_gaps=False
    )
    joined = ts.join_on_time(
        usage.withColumnRenamed("label", "ts"), weather.withColumnRenamed("label", "ts")
    )
    return joined.withColumn("wchill", wx.wind_chill("temp", "wspd"))


def daily(hourly_frame: DataFrame, hdd_above: str = "null", with_wind: bool = True) -> DataFrame:
    """T1 + T4 + T7-T9: daily bins with ``mean_f`` and HDD (and CDD).

    ``hdd_above='null'`` is the descriptive frame (HDD and CDD missing above /
    below the base); ``'zero'`` gives HDD 0 above the base and no CDD, the form
    the weekly / monthly sums and the regressions use.
    """
    aggs = list(PERIOD_AGGS)
    if with_wind:
        aggs += [("wspd_mean", "mean", "wspd"), ("wchill_mean", "mean", "wchill")]
    d = ts.resample(hourly_frame, "ts", "day", aggs)
    cdd = "null" if hdd_above == "null" else None
    return ts.with_degree_days(d, "temp_mean", hdd_above=hdd_above, cdd_above=cdd)


def weekly(hourly_frame: DataFrame) -> DataFrame:
    """T2 + T10: weekly bins; HDD is the sum of the week's daily HDD, NULL for
    the first week and for a zero total."""
    w = ts.resample(hourly_frame, "ts", "week", PERIOD_AGGS)
    hdd = ts.hdd_by_period(daily(hourly_frame, "zero", with_wind=False), "week")
    return ts.weekly_hdd_rule(w.join(hdd, "label", "left"))


def monthly(hourly_frame: DataFrame) -> DataFrame:
    """T3 + T11: monthly bins; HDD is the sum of the month's daily HDD."""
    m = ts.resample(hourly_frame, "ts", "month", PERIOD_AGGS)
    hdd = ts.hdd_by_period(daily(hourly_frame, "zero", with_wind=False), "month")
    return m.join(hdd, "label", "left").withColumn("hdd", F.coalesce("hdd", F.lit(0.0)))
