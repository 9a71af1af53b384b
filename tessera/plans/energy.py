"""Hourly energy use joined with weather, resampled to day / week / month
(workloads W6, W7) over the ``events`` table.

Stand-ins (rows in the reference's schema, nothing else):

* meter readings ``(ts, kwh)``: ``purchase`` events, ``kwh = value``
* weather observations ``(ts, temp, wspd)``: ``view`` events give
  ``temp = value - 30`` (deg C), ``click`` events give ``wspd = value / 5``
* a series of several years: first lines of orders are readings (``kwh = quantity / 1000``)
  on their ship date, the other lines are observations (``temp = quantity - 30``)

The library then builds the hourly meter series (hour bins, gaps as 0 kWh),
the hourly weather series (hour means, observed hours only), joins them on the
hour and derives every frame below.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.operators import energy as E
from tessera.operators import timeseries as ts
from tessera.plans.common import rounded, two_step_round
from tessera.session import pin_utc
from tessera.sources.tables import read_table

AS_OF = "2024-01-15 13:25:00"


def readings(spark, root) -> DataFrame:
    ev = read_table(spark, root, "events")
    return ev.filter(F.col("event_type") == "purchase").select("ts", F.col("value").alias("kwh"))


def observations(spark, root) -> DataFrame:
    ev = read_table(spark, root, "events")
    return ev.filter(F.col("event_type").isin("view", "click")).select(
        "ts",
        F.when(F.col("event_type") == "view", F.col("value") - 30.0).alias("temp"),
        F.when(F.col("event_type") == "click", F.col("value") / 5.0).alias("wspd"),
    )


def hourly(spark, root, start: Column | None = None, end: Column | None = None) -> DataFrame:
    """J4 + T15 over the stand-ins (see :func:`tessera.operators.energy.hourly`)."""
    pin_utc(spark)
    return E.hourly(readings(spark, root), observations(spark, root), start, end)


def long_hourly(spark, root) -> DataFrame:
    """The same frame over the series of several years."""
    pin_utc(spark)
    li = read_table(spark, root, "lineitem")
    stamp, first = F.col("l_shipdate").cast("timestamp_ntz").alias("ts"), F.col("l_linenumber") == 1
    meter = li.filter(first).select(stamp, (F.col("l_quantity") / 1000.0).alias("kwh"))
    weather = li.filter(~first).select(stamp, (F.col("l_quantity") - 30.0).alias("temp"), F.lit(None).cast("double").alias("wspd"))
    return E.hourly(meter, weather)


def daily(spark, root) -> DataFrame:
    """T1 + T4 + T8 + T9: daily bins with HDD / CDD ("missing above base")."""
    return E.daily(hourly(spark, root), "null")


def daily_zero_hdd(spark, root) -> DataFrame:
    """Daily bins with HDD in its "0 above base" form (the regression input)."""
    return E.daily(hourly(spark, root), "zero", with_wind=False)


def weekly(spark, root) -> DataFrame:
    """T2 + T10: weekly bins with the week's HDD."""
    return E.weekly(hourly(spark, root))


def monthly(spark, root) -> DataFrame:
    """T3 + T11: monthly bins with the month's HDD."""
    return E.monthly(hourly(spark, root))


def q_usage_weather_hourly(spark, root):
    return rounded(hourly(spark, root).select("ts", "kwh", "temp", "wspd", "wchill"))


def q_daily_observations(spark, root):
    return rounded(daily(spark, root).withColumnRenamed("label", "date"))


def q_weekly_observations(spark, root):
    return rounded(weekly(spark, root).withColumnRenamed("label", "week"))


def q_monthly_observations(spark, root):
    return rounded(monthly(spark, root).withColumnRenamed("label", "month_end"))


def q_heating_season_hours(spark, root):
    h = ts.heating_season(hourly(spark, root))
    return rounded(h.select("ts", "hour", "month", "kwh"))


def q_coldest_days_gradient(spark, root):
    prof = ts.coldest_day_profiles(hourly(spark, root), daily(spark, root), "temp_mean", 0.05)
    return rounded(prof.select("date", "ts", "hour", "kwh", "temp", "mj", "mj_h", "temp_h"))


def q_seasonality_weekly(spark, root):
    w = ts.seasonal_positions(weekly(spark, root), "label", "week").filter(F.col("hdd").isNotNull())
    return rounded(w.select("year", F.col("position").alias("week"), "hdd", "kwh_sum"))


def q_today_hourly(spark, root):
    """today's hours from midnight to the current hour of ``AS_OF``."""
    t = F.lit(AS_OF).cast("timestamp_ntz")
    start = F.date_trunc("day", t).cast("timestamp_ntz")
    end = F.date_trunc("hour", t).cast("timestamp_ntz")
    h = ts.slice_between(hourly(spark, root, start, end), "ts", start, end)
    return rounded(h.select("ts", "kwh", "temp", "wspd"))


QUERIES = {
    "usage_weather_hourly": q_usage_weather_hourly,
    "daily_observations": q_daily_observations,
    "weekly_observations": q_weekly_observations,
    "monthly_observations": q_monthly_observations,
    "heating_season_hours": q_heating_season_hours,
    "coldest_days_gradient": q_coldest_days_gradient,
    "seasonality_weekly": q_seasonality_weekly,
    "today_hourly": q_today_hourly,
}

# ---------------------------------------------------------------- DuckDB oracles

HOURLY_SQL = """
WITH usage_raw AS (
  SELECT date_trunc('hour', ts) AS ts, sum(value) AS kwh FROM events
  WHERE event_type = 'purchase' GROUP BY 1),
usage_span AS (SELECT unnest(generate_series(min(ts), max(ts), INTERVAL 1 HOUR)) AS ts FROM usage_raw),
usage AS (SELECT s.ts, coalesce(u.kwh, 0) AS kwh FROM usage_span s LEFT JOIN usage_raw u USING (ts)),
weather AS (
  SELECT date_trunc('hour', ts) AS ts,
         avg(CASE WHEN event_type = 'view' THEN value - 30 END) AS temp,
         avg(CASE WHEN event_type = 'click' THEN value / 5 END) AS wspd
  FROM events WHERE event_type IN ('view', 'click') GROUP BY 1),
hourly AS (
  SELECT u.ts, u.kwh, w.temp, w.wspd,
         13.12 + 0.6215 * w.temp - 11.37 * pow(w.wspd, 0.16) + 0.3965 * w.temp * pow(w.wspd, 0.16) AS wchill
  FROM usage u JOIN weather w USING (ts)),
day_raw AS (
  SELECT CAST(ts AS DATE) AS label, sum(kwh) AS kwh_sum, min(temp) AS temp_min,
         max(temp) AS temp_max, avg(temp) AS temp_mean, avg(wspd) AS wspd_mean,
         avg(wchill) AS wchill_mean
  FROM hourly GROUP BY 1),
day_span AS (SELECT CAST(unnest(generate_series(min(label), max(label), INTERVAL 1 DAY)) AS DATE) AS label FROM day_raw),
daily AS (
  SELECT s.label, coalesce(d.kwh_sum, 0) AS kwh_sum, d.temp_min, d.temp_max, d.temp_mean,
         d.wspd_mean, d.wchill_mean, d.temp_mean * 1.8 + 32 AS mean_f
  FROM day_span s LEFT JOIN day_raw d USING (label)),
daily_hdd AS (
  SELECT *, CASE WHEN mean_f <= 65 THEN 65 - mean_f ELSE 0 END AS hdd0 FROM daily),
week_raw AS (
  SELECT CAST(date_trunc('week', ts) + INTERVAL 6 DAY AS DATE) AS label, sum(kwh) AS kwh_sum,
         min(temp) AS temp_min, max(temp) AS temp_max, avg(temp) AS temp_mean
  FROM hourly GROUP BY 1),
week_span AS (SELECT CAST(unnest(generate_series(min(label), max(label), INTERVAL 7 DAY)) AS DATE) AS label FROM week_raw),
week_hdd AS (
  SELECT CAST(date_trunc('week', label) + INTERVAL 6 DAY AS DATE) AS label, sum(hdd0) AS hdd
  FROM daily_hdd GROUP BY 1),
weekly AS (
  SELECT s.label, coalesce(w.kwh_sum, 0) AS kwh_sum, w.temp_min, w.temp_max, w.temp_mean,
         CASE WHEN s.label = (SELECT min(label) FROM week_span) THEN NULL
              ELSE nullif(h.hdd, 0) END AS hdd
  FROM week_span s LEFT JOIN week_raw w USING (label) LEFT JOIN week_hdd h USING (label)),
month_raw AS (
  SELECT last_day(ts) AS label, sum(kwh) AS kwh_sum, min(temp) AS temp_min,
         max(temp) AS temp_max, avg(temp) AS temp_mean
  FROM hourly GROUP BY 1),
month_span AS (
  SELECT last_day(CAST(unnest(generate_series(date_trunc('month', min(label)), date_trunc('month', max(label)), INTERVAL 1 MONTH)) AS DATE)) AS label
  FROM month_raw),
month_hdd AS (SELECT last_day(label) AS label, sum(hdd0) AS hdd FROM daily_hdd GROUP BY 1),
monthly AS (
  SELECT s.label, coalesce(m.kwh_sum, 0) AS kwh_sum, m.temp_min, m.temp_max, m.temp_mean,
         coalesce(h.hdd, 0) AS hdd
  FROM month_span s LEFT JOIN month_raw m USING (label) LEFT JOIN month_hdd h USING (label))
"""

#: The series of several years, in the shape of ``events``.
LONG_SQL = """
WITH events AS (
  SELECT CAST(l_shipdate AS TIMESTAMP) AS ts, CASE WHEN l_linenumber = 1 THEN 'purchase' ELSE 'view' END AS event_type,
         CASE WHEN l_linenumber = 1 THEN l_quantity / 1000 ELSE l_quantity END AS value FROM lineitem),
""" + HOURLY_SQL.replace("WITH", "", 1)


def _r(expr: str, name: str) -> str:
    return f"round({expr}, 6) AS {name}"


ORACLE = {
    "usage_weather_hourly": HOURLY_SQL
    + f"SELECT ts, {_r('kwh','kwh')}, {_r('temp','temp')}, {_r('wspd','wspd')}, {_r('wchill','wchill')} FROM hourly",
    "daily_observations": HOURLY_SQL
    + "SELECT label AS date, "
    + ", ".join(
        _r(c, c)
        for c in ["kwh_sum", "temp_min", "temp_max", "temp_mean", "wspd_mean", "wchill_mean", "mean_f"]
    )
    + ", round(CASE WHEN mean_f <= 65 THEN 65 - mean_f END, 6) AS hdd"
    + ", round(CASE WHEN mean_f >= 65 THEN mean_f - 65 END, 6) AS cdd FROM daily",
    "weekly_observations": HOURLY_SQL
    + "SELECT label AS week, "
    + ", ".join(_r(c, c) for c in ["kwh_sum", "temp_min", "temp_max", "temp_mean", "hdd"])
    + " FROM weekly",
    "monthly_observations": HOURLY_SQL
    + "SELECT label AS month_end, "
    + ", ".join(_r(c, c) for c in ["kwh_sum", "temp_min", "temp_max", "temp_mean", "hdd"])
    + " FROM monthly",
    "heating_season_hours": HOURLY_SQL
    + "SELECT ts, CAST(hour(ts) AS INTEGER) AS hour, CAST(month(ts) AS INTEGER) AS month, "
    + _r("kwh", "kwh")
    + " FROM hourly WHERE month(ts) IN (1, 2, 3, 4, 11, 12)",
    "coldest_days_gradient": HOURLY_SQL
    + """,
thr AS (SELECT quantile_cont(temp_mean, 0.05) AS t FROM daily),
days AS (SELECT label AS date FROM daily WHERE temp_mean <= (SELECT t FROM thr)),
rows AS (SELECT CAST(ts AS DATE) AS date, ts, CAST(hour(ts) AS INTEGER) AS hour, kwh, temp,
                kwh * 3.6 AS mj FROM hourly WHERE CAST(ts AS DATE) IN (SELECT date FROM days))
SELECT date, ts, hour, round(kwh, 6) AS kwh, round(temp, 6) AS temp, round(mj, 6) AS mj,
       round(mj - lag(mj) OVER (PARTITION BY date ORDER BY ts), 6) AS mj_h,
       round(temp - lag(temp) OVER (PARTITION BY date ORDER BY ts), 6) AS temp_h
FROM rows""",
    "seasonality_weekly": HOURLY_SQL
    + """
SELECT CAST(year(label) AS INTEGER) AS year,
       CAST(floor(date_diff('day', make_date(CAST(year(label) AS INTEGER) - 1, 12, 31), label) / 7.0) AS INTEGER) AS week,
       round(hdd, 6) AS hdd, round(kwh_sum, 6) AS kwh_sum
FROM weekly WHERE hdd IS NOT NULL""",
    "today_hourly": HOURLY_SQL
    + f"""
SELECT ts, round(kwh, 6) AS kwh, round(temp, 6) AS temp, round(wspd, 6) AS wspd FROM hourly
WHERE ts BETWEEN date_trunc('day', TIMESTAMP '{AS_OF}') AND date_trunc('hour', TIMESTAMP '{AS_OF}')""",
}

# Same presentation rounding as the Spark side (see plans.common.round_half_away).
ORACLE = {k: two_step_round(v) for k, v in ORACLE.items()}
