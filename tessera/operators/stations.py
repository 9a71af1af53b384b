"""Weather-station catalogue choices and multi-station degree-day panels
(S12-S15, C6, C7, J12, J14, P9, P10, T12-T14, T21-T23, A6, A15, A16).

``catalogue``: ``station, name, country, region, latitude, longitude,
hourly_start, hourly_end, daily_start, daily_end``.
``daily``: ``station, date, tmin, tmax`` (and optionally ``tavg``), deg C.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions import weather as wx
from tessera.operators.quality import complete_groups, covering, zero_to_null


def within_radius(
    catalogue: DataFrame, lat: float, lon: float, radius_miles: float
) -> DataFrame:
    """Stations within ``radius_miles`` of a point, with ``distance``
    in metres, nearest first."""
    dist = wx.haversine_m(F.lit(lat), F.lit(lon), F.col("latitude"), F.col("longitude"))
    return (
        catalogue.withColumn("distance", dist)
        .filter(F.col("distance") <= F.lit(radius_miles * wx.METERS_PER_MILE))
        .orderBy("distance", "station")
    )


def in_region(catalogue: DataFrame, country: str, region: str) -> DataFrame:
    """Stations of one country / region."""
    return catalogue.filter((F.col("country") == country) & (F.col("region") == region))


def arg_min(df: DataFrame, key: str, by: str | Column) -> DataFrame:
    """One row with the ``key`` of the smallest ``by`` (ties: smallest key)."""
    order = F.col(by) if isinstance(by, str) else by
    return df.agg(F.min_by(F.col(key), F.struct(order, F.col(key))).alias(key))


def arg_max(df: DataFrame, key: str, by: str | Column) -> DataFrame:
    """One row with the ``key`` of the largest numeric ``by`` (ties: smallest key)."""
    order = F.col(by) if isinstance(by, str) else by
    return df.agg(F.min_by(F.col(key), F.struct(-order, F.col(key))).alias(key))


def covering_stations(
    catalogue: DataFrame, series: DataFrame, ts: str, start: str = "hourly_start", end: str = "hourly_end"
) -> DataFrame:
    """Stations whose record spans the whole time range of ``series``."""
    return covering(catalogue, series, ts, start, end)


def nearest_covering(
    catalogue: DataFrame, series: DataFrame, ts: str, lat: float, lon: float, radius_miles: float
) -> DataFrame:
    """S12 + C7 + J12: the nearest station that covers ``series``' range."""
    near = within_radius(catalogue, lat, lon, radius_miles)
    return arg_min(covering_stations(near, series, ts), "station", "distance")


def earliest_among_closest(near: DataFrame, start: str = "hourly_start") -> DataFrame:
    """P10 + A6: among stations no farther than the median distance, the one
    with the earliest record."""
    med = near.select(F.percentile("distance", 0.5)).scalar()
    return arg_min(near.filter(F.col("distance") <= med), "station", start)


def older_than_average(catalogue: DataFrame, start: str = "daily_start") -> DataFrame:
    """Stations whose record starts before the average start, oldest first."""
    secs = F.unix_timestamp(F.col(start).cast("timestamp"))
    mean = catalogue.select(F.avg(secs)).scalar()
    return catalogue.filter(secs < mean).orderBy(start, "station")


def year_extent(catalogue: DataFrame, start: str = "daily_start", end: str = "daily_end") -> DataFrame:
    """First year of any record and last year of any record (one row)."""
    return catalogue.agg(
        F.min(F.year(start)).alias("start_year"), F.max(F.year(end)).alias("end_year")
    )


def with_daily_hdd(daily: DataFrame, tavg_mode: str = "midpoint", tavg: str | None = None) -> DataFrame:
    """T14 + T7 + T8: daily mean (estimated from the extremes unless a recorded
    ``tavg`` column is named), in deg F, and HDD ("0 above base")."""
    mean = F.col(tavg) if tavg else wx.daily_mean_from_extremes("tmin", "tmax", tavg_mode)
    return (
        daily.withColumn("tavg_est", mean)
        .withColumn("tavg_f", wx.fahrenheit("tavg_est"))
        .withColumn("hdd", wx.heating_degree_days("tavg_f", above="zero"))
    )


def complete_years(daily: DataFrame, station: str = "station", date: str = "date") -> DataFrame:
    """Rows of (station, year) groups that hold 365 or 366 days."""
    return complete_groups(daily.withColumn("year", F.year(date)), [station, "year"], (365, 366))


def annual_hdd(
    daily: DataFrame, tavg_mode: str = "midpoint", station: str = "station", date: str = "date"
) -> DataFrame:
    """``(station, year, hdd)`` over complete years; a zero total is NULL."""
    rows = with_daily_hdd(complete_years(daily, station, date), tavg_mode)
    return (
        rows.groupBy(station, "year")
        .agg(F.sum("hdd").alias("hdd"))
        .withColumn("hdd", zero_to_null("hdd"))
    )


def monthly_hdd(
    daily: DataFrame, tavg_mode: str = "midpoint", station: str = "station", date: str = "date"
) -> DataFrame:
    """``(station, month_end, hdd)`` over complete years; zero is NULL."""
    rows = with_daily_hdd(complete_years(daily, station, date), tavg_mode)
    return (
        rows.groupBy(station, F.last_day(date).alias("month_end"))
        .agg(F.sum("hdd").alias("hdd"))
        .withColumn("hdd", zero_to_null("hdd"))
    )


def in_extent(daily: DataFrame, catalogue: DataFrame, date: str = "date") -> DataFrame:
    """Rows of the catalogue's stations in the years from the first start to
    the last end of their records; the last year itself is excluded."""
    extent = year_extent(catalogue)
    first, end = (extent.select(c).scalar() for c in ("start_year", "end_year"))
    own = daily.join(catalogue.select("station"), "station", "left_semi")
    return own.filter((F.year(date) >= first) & (F.year(date) < end))


def region_panel(
    catalogue: DataFrame, daily: DataFrame, country: str, region: str, tavg_mode: str = "midpoint"
) -> DataFrame:
    """S13 + P9 + A15 + T12: annual HDD of a region's stations older than its average,
    one row per station and year of the extent (``station, year, hdd``; NULL where the
    year is incomplete or its total is zero). :func:`panel` lays it out wide."""
    chosen = older_than_average(in_region(catalogue, country, region))
    extent = year_extent(chosen)
    cells = chosen.select(
        "station",
        extent.select("start_year").scalar().alias("first"),
        extent.select("end_year").scalar().alias("end"),
    ).filter("first < end")
    cells = cells.select("station", F.explode(F.sequence("first", F.col("end") - 1)).alias("year"))
    return cells.join(annual_hdd(in_extent(daily, chosen), tavg_mode), ["station", "year"], "left")


def region_monthly(
    catalogue: DataFrame, daily: DataFrame, country: str, region: str, tavg_mode: str = "midpoint"
) -> DataFrame:
    """T13 over the same stations and years: ``station, month_end, hdd``."""
    chosen = older_than_average(in_region(catalogue, country, region))
    return monthly_hdd(in_extent(daily, chosen), tavg_mode)


def panel(
    long: DataFrame,
    stations: Sequence | None,
    first_year: int,
    end_year: int,
    value: str = "hdd",
    station: str = "station",
) -> DataFrame:
    """Wide panel, one row per year in ``[first_year, end_year)`` (the end is
    exclusive, as in the reference) and one column per station; missing cells
    are NULL. ``stations`` names the columns; when ``None`` Spark finds the
    distinct stations itself (bounded by ``spark.sql.pivotMaxValues``)."""
    years = long.sparkSession.range(first_year, end_year).select(
        F.col("id").cast("int").alias("year")
    )
    pivoted = long.groupBy("year").pivot(station, list(stations) if stations else None)
    wide = pivoted.agg(F.first(value))
    return years.join(wide, "year", "left").orderBy("year")


def observations_for(
    df: DataFrame, station, start: str, end: str, ts: str = "date", station_col: str = "station"
) -> DataFrame:
    """One station's rows in the closed range ``[start, end]``."""
    lo = F.lit(start).cast(df.schema[ts].dataType)
    hi = F.lit(end).cast(df.schema[ts].dataType)
    return df.filter((F.col(station_col) == F.lit(station)) & F.col(ts).between(lo, hi))


def year_to_date(daily: DataFrame, as_of: str, date: str = "date") -> DataFrame:
    """Days from January 1 of ``as_of``'s year up to ``as_of``."""
    end = F.to_date(F.lit(as_of))
    start = F.make_date(F.year(end), F.lit(1), F.lit(1))
    return daily.filter(F.col(date).between(start, end))


def ytd_hdd(daily: DataFrame, as_of: str, station: str = "station") -> DataFrame:
    """A16 + T22: cumulative HDD per station for the year to date."""
    rows = with_daily_hdd(year_to_date(daily, as_of), tavg="tavg")
    return rows.groupBy(station).agg(F.sum("hdd").alias("hdd"))


def ytd_running(daily: DataFrame, as_of: str, station: str = "station") -> DataFrame:
    """A16 running form: cumulative HDD per station through the year to date.

    The window is partitioned by station and year, so a partition holds at most
    366 rows whatever the data volume."""
    from pyspark.sql import Window

    rows = with_daily_hdd(year_to_date(daily, as_of), tavg="tavg")
    w = (
        Window.partitionBy(station, F.year("date"))
        .orderBy("date")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return rows.select(station, "date", "hdd", F.sum("hdd").over(w).alias("hdd_to_date"))


def coldest_day(daily: DataFrame, as_of: str, station: str = "station") -> DataFrame:
    """T22 + A6: per station, the year-to-date day with the largest HDD (the
    first such day on ties) and its mean temperature in deg F."""
    rows = with_daily_hdd(year_to_date(daily, as_of), tavg="tavg")
    order = F.struct(F.col("hdd"), -F.datediff(F.col("date"), F.lit("1970-01-01").cast("date")))
    best = F.max_by(F.struct("date", "tavg_f"), order)
    return rows.groupBy(station).agg(best.alias("_b")).select(station, "_b.date", "_b.tavg_f")
