"""Weather and energy expressions (T7-T9, T14-T16, F13, F18). All JVM-side."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values used by the reference's formulas.
HDD_BASE_F = 65.0
KWH_TO_MJ = 3.6
EARTH_RADIUS_M = 6_371_000.0
METERS_PER_MILE = 1609.344


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def fahrenheit(celsius: Column | str) -> Column:
    """``c * 1.8 + 32``."""
    return _c(celsius) * F.lit(1.8) + F.lit(32.0)


def heating_degree_days(mean_f: Column | str, base: float = HDD_BASE_F, above: str = "zero") -> Column:
    """``base - mean_f`` when ``mean_f <= base``.

    ``above='zero'`` gives 0 above the base and for a missing mean (a comparison
    with a missing value is false); ``above='null'`` gives NULL in both cases.
    """
    m = _c(mean_f)
    hot = F.lit(base) - m
    if above == "zero":
        return F.when(m <= F.lit(base), hot).otherwise(F.lit(0.0))
    if above == "null":
        return F.when(m <= F.lit(base), hot)
    raise ValueError("above must be 'zero' or 'null'")


def cooling_degree_days(mean_f: Column | str, base: float = HDD_BASE_F, above: str = "null") -> Column:
    """``mean_f - base`` when ``mean_f >= base`` (so exactly at base both are 0)."""
    m = _c(mean_f)
    cold = m - F.lit(base)
    if above == "zero":
        return F.when(m >= F.lit(base), cold).otherwise(F.lit(0.0))
    if above == "null":
        return F.when(m >= F.lit(base), cold)
    raise ValueError("above must be 'zero' or 'null'")


def wind_chill(temp_c: Column | str, wspd: Column | str) -> Column:
    """``13.12 + 0.6215 T - 11.37 v^0.16 + 0.3965 T v^0.16``."""
    t = _c(temp_c)
    v16 = F.pow(_c(wspd), F.lit(0.16))
    return F.lit(13.12) + F.lit(0.6215) * t - F.lit(11.37) * v16 + F.lit(0.3965) * t * v16


def kwh_to_mj(kwh: Column | str) -> Column:
    """Energy in megajoules."""
    return _c(kwh) * F.lit(KWH_TO_MJ)


def daily_mean_from_extremes(tmin: Column | str, tmax: Column | str, mode: str = "midpoint") -> Column:
    """Daily mean estimated from the extremes.

    ``'midpoint'`` is ``(tmax + tmin) / 2``; ``'as_written'`` reproduces the
    reference's unparenthesised ``tmax + tmin / 2``.
    """
    lo, hi = _c(tmin), _c(tmax)
    if mode == "midpoint":
        return (hi + lo) / F.lit(2.0)
    if mode == "as_written":
        return hi + lo / F.lit(2.0)
    raise ValueError("mode must be 'midpoint' or 'as_written'")


def haversine_m(lat1, lon1, lat2, lon2) -> Column:
    """great-circle distance in metres."""
    p1, p2 = F.radians(_c(lat1)), F.radians(_c(lat2))
    dp = p2 - p1
    dl = F.radians(_c(lon2)) - F.radians(_c(lon1))
    a = F.pow(F.sin(dp / 2), 2) + F.cos(p1) * F.cos(p2) * F.pow(F.sin(dl / 2), 2)
    return F.lit(2 * EARTH_RADIUS_M) * F.asin(F.sqrt(a))
