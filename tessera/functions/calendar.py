"""Calendar expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def is_leap_year(year: Column | str) -> Column:
    """Gregorian leap year: divisible by 4, and not by 100 unless by 400."""
    y = _c(year)
    return ((y % 4) == 0) & (((y % 100) != 0) | ((y % 400) == 0))


def day_label(ts: Column | str) -> Column:
    """Daily bin label (pandas ``resample('D')``)."""
    return F.to_date(_c(ts))


def week_label(ts: Column | str) -> Column:
    """Weekly bin label of pandas ``resample('W')``: weeks run Monday-Sunday and
    carry the Sunday's date."""
    return F.date_add(F.to_date(F.date_trunc("week", _c(ts))), 6)


def month_label(ts: Column | str) -> Column:
    """Monthly bin label of pandas ``resample('M'/'ME')``: the month's last day."""
    return F.last_day(F.to_date(_c(ts)))


def week_number(day: Column | str) -> Column:
    """Week position ``int((d - Dec 31 of the previous year).days / 7)``.

    Not ISO ``weekofyear``: days 1-6 of the year are week 0.
    """
    d = F.to_date(_c(day))
    dec31 = F.make_date(F.year(d) - 1, F.lit(12), F.lit(31))
    return F.floor(F.datediff(d, dec31) / F.lit(7)).cast("int")


def label_for(grain: str, ts: Column | str) -> Column:
    """Bin label for ``grain`` in {'hour', 'day', 'week', 'month'}."""
    if grain == "hour":
        return F.date_trunc("hour", _c(ts))
    if grain == "day":
        return day_label(ts)
    if grain == "week":
        return week_label(ts)
    if grain == "month":
        return month_label(ts)
    raise ValueError(f"unknown grain {grain!r}")


def step_for(grain: str) -> Column:
    """The interval between consecutive labels of ``grain``."""
    return {
        "hour": F.expr("INTERVAL 1 HOUR"),
        "day": F.expr("INTERVAL 1 DAY"),
        "week": F.expr("INTERVAL 7 DAYS"),
        "month": F.expr("INTERVAL 1 MONTH"),
    }[grain]
