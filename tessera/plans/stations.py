"""Station catalogue choices and multi-station HDD panels (W8, W9) over the test tables.

Stand-ins (rows in the reference's schema, nothing else):

* daily observations ``(station, date, tmin, tmax, tavg)``: one row per
  ``(l_returnflag, ship date)`` with the day's min / max / mean of
  ``l_quantity - 30`` as deg C
* station catalogue: one station per ``nation`` with grid coordinates
  ``latitude = 43 + 0.5 * (key % 5)``, ``longitude = -71 + 0.6 * (key div 5)``,
  region = region name, record span = first / last ship date of the nation's
  suppliers
* stations of a region with records of their own: line number modulo 4; station ``k``
  reports from 1994 + ``k`` to the end of 2000 (a complete last year); station 0 lies in
  another region
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators import models as M
from tessera.operators import periods, quantiles, series, spatial
from tessera.operators import stations as S
from tessera.plans.common import rounded, two_step_round
from tessera.session import pin_utc
from tessera.sources.tables import read_table

POINT = (44.5, -70.4)
RADIUS_MILES = 150.0
AS_OF = "1998-06-30"
REGION = "AMERICA"


def daily_series(spark, root) -> DataFrame:
    li = read_table(spark, root, "lineitem")
    q = F.col("l_quantity") - 30.0
    return li.groupBy(
        F.col("l_returnflag").alias("station"), F.to_date("l_shipdate").alias("date")
    ).agg(F.min(q).alias("tmin"), F.max(q).alias("tmax"), F.avg(q).alias("tavg"))


def catalogue(spark, root) -> DataFrame:
    n = read_table(spark, root, "nation")
    r = read_table(spark, root, "region")
    s = read_table(spark, root, "supplier").select("s_suppkey", "s_nationkey")
    li = read_table(spark, root, "lineitem").select("l_suppkey", "l_shipdate")
    span = (
        li.join(s, li.l_suppkey == s.s_suppkey)
        .groupBy("s_nationkey")
        .agg(F.min("l_shipdate").alias("start"), F.max("l_shipdate").alias("end"))
    )
    key = F.col("n_nationkey")
    return (
        n.join(r, n.n_regionkey == r.r_regionkey, "left")
        .join(span, n.n_nationkey == span.s_nationkey, "left")
        .select(
            key.alias("station"),
            F.col("n_name").alias("name"),
            F.lit("US").alias("country"),
            F.col("r_name").alias("region"),
            (F.lit(43.0) + F.lit(0.5) * (key % 5)).alias("latitude"),
            (F.lit(-71.0) + F.lit(0.6) * F.floor(key / 5)).alias("longitude"),
            F.col("start").alias("hourly_start"),
            F.col("end").alias("hourly_end"),
            F.col("start").alias("daily_start"),
            F.col("end").alias("daily_end"),
        )
    )


def panel_daily(spark, root) -> DataFrame:
    li = read_table(spark, root, "lineitem")
    station, q = F.col("l_linenumber") % 4, F.col("l_quantity") - 30.0
    rows = li.filter(F.year("l_shipdate").between(station + 1994, F.lit(2000)))
    return rows.groupBy(station.alias("station"), F.to_date("l_shipdate").alias("date")).agg(
        F.min(q).alias("tmin"), F.max(q).alias("tmax")
    )


def panel_catalogue(daily: DataFrame) -> DataFrame:
    spans = daily.groupBy("station").agg(F.min("date").alias("daily_start"), F.max("date").alias("daily_end"))
    return spans.withColumn("country", F.lit("US")).withColumn("region", F.when(F.col("station") == 0, "NH").otherwise("ME"))


def monthly_z(spark, root) -> DataFrame:
    """T13 + N6: monthly HDD per station (complete years), z-scored per station."""
    m = S.monthly_hdd(daily_series(spark, root))
    return M.zscore(m, "hdd", ["station"], "hdd_z")


def q_annual_hdd_by_station(spark, root):
    pin_utc(spark)
    return rounded(S.annual_hdd(daily_series(spark, root)))


def q_annual_hdd_panel(spark, root):
    pin_utc(spark)
    daily = daily_series(spark, root)
    first, end = daily.agg(F.min(F.year("date")), F.max(F.year("date"))).first()
    long = S.annual_hdd(daily)
    return rounded(S.panel(long, None, first, end))


def q_monthly_hdd_zscore(spark, root):
    pin_utc(spark)
    return rounded(monthly_z(spark, root))


def q_monthly_trends(spark, root):
    pin_utc(spark)
    z = monthly_z(spark, root).select(
        F.month("month_end").alias("month"), F.year("month_end").alias("year"), "hdd_z"
    )
    t = M.linear_trends(z, "month", "year", "hdd_z")
    return rounded(t.select("month", "slope", "intercept", "r_squared", "stdev", "mse", "rmse"))


def q_nearest_station(spark, root):
    pin_utc(spark)
    series = daily_series(spark, root).filter(F.col("station") == "A")
    return S.nearest_covering(catalogue(spark, root), series, "date", *POINT, RADIUS_MILES)


def q_stations_below_median(spark, root):
    pin_utc(spark)
    near = S.within_radius(catalogue(spark, root), *POINT, RADIUS_MILES)
    return S.earliest_among_closest(near)


def q_older_stations(spark, root):
    pin_utc(spark)
    cat = S.in_region(catalogue(spark, root), "US", REGION)
    return S.older_than_average(cat).select("station", "name", "daily_start", "daily_end")


def q_station_year_extent(spark, root):
    pin_utc(spark)
    return S.year_extent(catalogue(spark, root))


def q_region_annual_hdd(spark, root):
    """Region, older than average, extent, annual HDD with the daily mean as written."""
    pin_utc(spark)
    daily = panel_daily(spark, root)
    return rounded(S.region_panel(panel_catalogue(daily), daily, "US", "ME", "as_written"))


def q_region_monthly_trends(spark, root):
    """The same choice, monthly HDD z-scored per station, a trend per month of the year."""
    pin_utc(spark)
    daily = panel_daily(spark, root)
    m = S.region_monthly(panel_catalogue(daily), daily, "US", "ME", "as_written")
    z = M.zscore(m, "hdd", ["station"], "hdd_z").select(
        F.month("month_end").alias("month"), F.year("month_end").alias("year"), "hdd_z"
    )
    t = M.linear_trends(z, "month", "year", "hdd_z")
    return rounded(t.select("month", "slope", "intercept", "r_squared", "stdev", "mse", "rmse"))


def q_ytd_hdd(spark, root):
    pin_utc(spark)
    return rounded(S.ytd_hdd(daily_series(spark, root), AS_OF))


def q_ytd_hdd_running(spark, root):
    pin_utc(spark)
    return rounded(S.ytd_running(daily_series(spark, root), AS_OF))


def q_station_slice(spark, root):
    """One station's daily rows over a closed date range."""
    pin_utc(spark)
    rows = S.observations_for(daily_series(spark, root), "R", "1997-03-01", "1997-03-31")
    return rounded(rows.select("station", "date", "tmin", "tmax", "tavg"))


def q_seasonality_monthly(spark, root):
    """Monthly HDD per station laid out as (year, month) for overlaying years."""
    pin_utc(spark)
    m = S.monthly_hdd(daily_series(spark, root))
    return rounded(
        m.select("station", F.year("month_end").alias("year"), F.month("month_end").alias("month"), "hdd")
    )


def q_coldest_day(spark, root):
    pin_utc(spark)
    return rounded(S.coldest_day(daily_series(spark, root), AS_OF))


def wide_catalogue(spark, root) -> DataFrame:
    """A station per supplier, over the whole globe; some report too late or too short."""
    s = read_table(spark, root, "supplier")
    key = F.col("s_suppkey").cast("double")
    return s.select(
        F.col("s_suppkey").alias("station"), (key * 53.1373 % 160 - 80).alias("latitude"), (key * 71.9131 % 360 - 180).alias("longitude"),
        F.date_add(F.lit("2023-12-20").cast("date"), (F.col("s_suppkey") % 20).cast("int")).cast("timestamp").alias("hourly_start"),
        F.date_add(F.lit("2024-03-10").cast("date"), (F.col("s_suppkey") % 7).cast("int")).cast("timestamp").alias("hourly_end"),
    )


def q_nearest_stations(spark, root):
    """S12 + C7 + J12 for many points: the three nearest stations of every customer whose record covers the events."""
    pin_utc(spark)
    key = F.col("c_custkey").cast("double")
    points = read_table(spark, root, "customer").select("c_custkey", (key * 37.3717 % 180 - 90).alias("latitude"), (key * 91.7117 % 360 - 180).alias("longitude"))
    covering = S.covering_stations(wide_catalogue(spark, root), read_table(spark, root, "events"), "ts")
    near = spatial.k_nearest(points, covering, 3)
    return rounded(near.select("c_custkey", "nearest_rank", "station", "distance"), 2)


def daily_a(spark, root) -> DataFrame:
    """Daily HDD of station A."""
    return S.with_daily_hdd(daily_series(spark, root).filter("station = 'A'")).select("date", "hdd")


def billing_periods(spark, root) -> DataFrame:
    """A period per order, of 0 to 59 days, and of many years for a few: overlaps and gaps."""
    days = F.when(F.col("o_orderkey") % 1000 == 0, 3000).otherwise(F.col("o_orderkey") % 60).cast("int")
    start = F.to_date("o_orderdate")
    return read_table(spark, root, "orders").select(F.col("o_orderkey").alias("period"), start.alias("start"), F.date_add(start, days).alias("end"))


def q_billing_hdd(spark, root):
    """Heating degree days of arbitrary billing periods (start, end]."""
    pin_utc(spark)
    totals = periods.period_totals(daily_a(spark, root), billing_periods(spark, root), "date", "hdd", "period")
    return rounded(totals.select("period", "start", "end", "n", "hdd"))


def q_event_running(spark, root):
    """N5 + T17 + A16 without a group: backward difference and running sum over all events in time."""
    pin_utc(spark)
    e = read_table(spark, root, "events").select("ts", "event_id", "value")
    out = series.scan_series(e, "ts", "value", ["event_id"])
    return rounded(out.select("event_id", "previous", "difference", "running"))


def q_price_quantiles(spark, root):
    """P10 + A17: exact quantiles of all prices by selection."""
    ranks = [0.0, 0.1, 0.25, 0.5, 0.9, 0.99, 1.0]
    values = quantiles.exact_quantiles(read_table(spark, root, "lineitem"), "l_extendedprice", ranks)
    return rounded(spark.createDataFrame(list(zip(ranks, values)), "q double, price double"))


QUERIES = {
    "nearest_stations": q_nearest_stations,
    "billing_hdd": q_billing_hdd,
    "event_running": q_event_running,
    "price_quantiles": q_price_quantiles,
    "annual_hdd_by_station": q_annual_hdd_by_station,
    "annual_hdd_panel": q_annual_hdd_panel,
    "monthly_hdd_zscore": q_monthly_hdd_zscore,
    "monthly_trends": q_monthly_trends,
    "nearest_station": q_nearest_station,
    "stations_below_median": q_stations_below_median,
    "older_stations": q_older_stations,
    "station_year_extent": q_station_year_extent,
    "region_annual_hdd": q_region_annual_hdd,
    "region_monthly_trends": q_region_monthly_trends,
    "ytd_hdd": q_ytd_hdd,
    "coldest_day": q_coldest_day,
    "ytd_hdd_running": q_ytd_hdd_running,
    "station_slice": q_station_slice,
    "seasonality_monthly": q_seasonality_monthly,
}

# ---------------------------------------------------------------- DuckDB oracles

DAILY_SQL = """
WITH daily AS (
  SELECT l_returnflag AS station, CAST(l_shipdate AS DATE) AS date,
         min(l_quantity - 30) AS tmin, max(l_quantity - 30) AS tmax, avg(l_quantity - 30) AS tavg
  FROM lineitem GROUP BY 1, 2),
complete AS (
  SELECT d.*, CAST(year(d.date) AS INTEGER) AS year FROM daily d
  JOIN (SELECT station, year(date) AS y FROM daily GROUP BY 1, 2 HAVING count(*) IN (365, 366)) c
    ON c.station = d.station AND c.y = year(d.date)),
hdd_rows AS (
  SELECT *, CASE WHEN ((tmax + tmin) / 2) * 1.8 + 32 <= 65
                 THEN 65 - (((tmax + tmin) / 2) * 1.8 + 32) ELSE 0 END AS hdd
  FROM complete),
annual AS (SELECT station, year, nullif(sum(hdd), 0) AS hdd FROM hdd_rows GROUP BY 1, 2),
monthly AS (SELECT station, last_day(date) AS month_end, nullif(sum(hdd), 0) AS hdd
            FROM hdd_rows GROUP BY 1, 2),
mz AS (
  SELECT m.station, m.month_end, m.hdd, (m.hdd - s.mu) / s.sd AS hdd_z
  FROM monthly m JOIN (SELECT station, avg(hdd) AS mu, stddev_samp(hdd) AS sd
                       FROM monthly GROUP BY 1) s USING (station))
"""

CATALOGUE_SQL = """
WITH span AS (
  SELECT s_nationkey, min(l_shipdate) AS s0, max(l_shipdate) AS s1
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY 1),
cat AS (
  SELECT n_nationkey AS station, n_name AS name, 'US' AS country, r_name AS region,
         43.0 + 0.5 * (n_nationkey % 5) AS latitude, -71.0 + 0.6 * floor(n_nationkey / 5) AS longitude,
         s0 AS hourly_start, s1 AS hourly_end, s0 AS daily_start, s1 AS daily_end
  FROM nation LEFT JOIN region ON n_regionkey = r_regionkey
              LEFT JOIN span ON n_nationkey = s_nationkey),
near AS (
  SELECT *, 2 * 6371000.0 * asin(sqrt(
      pow(sin((radians(latitude) - radians({lat})) / 2), 2)
      + cos(radians({lat})) * cos(radians(latitude))
        * pow(sin((radians(longitude) - radians({lon})) / 2), 2))) AS distance
  FROM cat),
within AS (SELECT * FROM near WHERE distance <= {radius} * 1609.344)
""".format(lat=POINT[0], lon=POINT[1], radius=RADIUS_MILES)

REGION_SQL = """
WITH pd AS (
  SELECT l_linenumber % 4 AS station, CAST(l_shipdate AS DATE) AS date,
         min(l_quantity - 30) AS tmin, max(l_quantity - 30) AS tmax
  FROM lineitem WHERE year(l_shipdate) BETWEEN 1994 + l_linenumber % 4 AND 2000 GROUP BY 1, 2),
spans AS (SELECT station, min(date) AS d0, max(date) AS d1 FROM pd WHERE station <> 0 GROUP BY 1),
chosen AS (SELECT * FROM spans WHERE epoch(d0) < (SELECT avg(epoch(d0)) FROM spans)),
years AS (SELECT CAST(y AS INTEGER) AS year
          FROM range((SELECT min(year(d0)) FROM chosen), (SELECT max(year(d1)) FROM chosen)) t(y)),
days AS (
  SELECT station, date, y.year, greatest(65 - ((tmax + tmin / 2) * 1.8 + 32), 0) AS hdd,
         count(*) OVER (PARTITION BY station, y.year) AS n
  FROM pd JOIN chosen USING (station) JOIN years y ON y.year = year(date)),
rm AS (SELECT station, CAST(month(date) AS INTEGER) AS month, year, nullif(sum(hdd), 0) AS hdd
       FROM days WHERE n >= 365 GROUP BY 1, 2, 3),
rz AS (SELECT month, CAST(year AS DOUBLE) AS x, (hdd - avg(hdd) OVER (PARTITION BY station))
         / stddev_samp(hdd) OVER (PARTITION BY station) AS y FROM rm)
"""

ORACLE = {
    "nearest_stations": f"""
WITH points AS (SELECT c_custkey, CAST(c_custkey AS DOUBLE) * 37.3717 % 180 - 90 AS lat, CAST(c_custkey AS DOUBLE) * 91.7117 % 360 - 180 AS lon FROM customer),
stations AS (
  SELECT s_suppkey AS station, CAST(s_suppkey AS DOUBLE) * 53.1373 % 160 - 80 AS lat, CAST(s_suppkey AS DOUBLE) * 71.9131 % 360 - 180 AS lon FROM supplier
  WHERE DATE '2023-12-20' + CAST(s_suppkey % 20 AS INTEGER) <= (SELECT min(ts) FROM events)
    AND DATE '2024-03-10' + CAST(s_suppkey % 7 AS INTEGER) >= (SELECT max(ts) FROM events)),
far AS (
  SELECT c_custkey, station, 2 * {S.wx.EARTH_RADIUS_M} * asin(sqrt(pow(sin((radians(s.lat) - radians(p.lat)) / 2), 2)
           + cos(radians(p.lat)) * cos(radians(s.lat)) * pow(sin((radians(s.lon) - radians(p.lon)) / 2), 2))) AS distance
  FROM points p, stations s),
ranked AS (SELECT *, row_number() OVER (PARTITION BY c_custkey ORDER BY distance, station) AS r FROM far)
SELECT c_custkey, CAST(r AS INTEGER) AS nearest_rank, station, round(distance, 2) AS distance FROM ranked WHERE r <= 3""",
    "billing_hdd": """
WITH days AS (
  SELECT CAST(l_shipdate AS DATE) AS date, greatest(65 - ((min(l_quantity - 30) + max(l_quantity - 30)) / 2 * 9 / 5 + 32), 0) AS hdd
  FROM lineitem WHERE l_returnflag = 'A' GROUP BY 1),
periods AS (
  SELECT o_orderkey AS period, CAST(o_orderdate AS DATE) AS start,
         CAST(o_orderdate AS DATE) + CAST(CASE WHEN o_orderkey % 1000 = 0 THEN 3000 ELSE o_orderkey % 60 END AS INTEGER) AS "end" FROM orders)
SELECT period, start, "end", count(date) AS n, round(sum(hdd), 6) AS hdd
FROM periods LEFT JOIN days ON date > start AND date <= "end" GROUP BY ALL""",
    "event_running": """
SELECT event_id, round(lag(value) OVER w, 6) AS previous, round(value - lag(value) OVER w, 6) AS difference,
       round(coalesce(sum(value) OVER w, 0), 6) AS running
FROM events WHERE ts IS NOT NULL WINDOW w AS (ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)""",
    "price_quantiles": "\nUNION ALL\n".join(
        f"SELECT CAST({q} AS DOUBLE) AS q, round(quantile_cont(l_extendedprice, {q}), 6) AS price FROM lineitem" for q in (0.0, 0.1, 0.25, 0.5, 0.9, 0.99, 1.0)
    ),
    "region_annual_hdd": REGION_SQL
    + """
SELECT c.station, y.year, round(nullif(sum(d.hdd), 0), 6) AS hdd
FROM chosen c CROSS JOIN years y LEFT JOIN days d ON d.station = c.station AND d.year = y.year AND d.n >= 365
GROUP BY 1, 2""",
    "region_monthly_trends": REGION_SQL
    + """
SELECT month, round(regr_slope(y, x), 6) AS slope, round(regr_intercept(y, x), 6) AS intercept,
       round(pow(corr(y, x), 2), 6) AS r_squared, round(stddev_pop(y), 6) AS stdev,
       round(var_pop(y) * (1 - pow(corr(y, x), 2)), 6) AS mse,
       round(sqrt(var_pop(y) * (1 - pow(corr(y, x), 2))), 6) AS rmse
FROM rz WHERE y IS NOT NULL GROUP BY month""",
    "annual_hdd_by_station": DAILY_SQL + "SELECT station, year, round(hdd, 6) AS hdd FROM annual",
    "annual_hdd_panel": DAILY_SQL
    + """,
years AS (SELECT CAST(range AS INTEGER) AS year FROM range(
  (SELECT min(year(date)) FROM daily), (SELECT max(year(date)) FROM daily)))
SELECT y.year,
  round(max(CASE WHEN a.station = 'A' THEN a.hdd END), 6) AS "A",
  round(max(CASE WHEN a.station = 'N' THEN a.hdd END), 6) AS "N",
  round(max(CASE WHEN a.station = 'R' THEN a.hdd END), 6) AS "R"
FROM years y LEFT JOIN annual a ON a.year = y.year GROUP BY y.year""",
    "monthly_hdd_zscore": DAILY_SQL
    + "SELECT station, month_end, round(hdd, 6) AS hdd, round(hdd_z, 6) AS hdd_z FROM mz",
    "monthly_trends": DAILY_SQL
    + """,
pts AS (SELECT CAST(month(month_end) AS INTEGER) AS month, CAST(year(month_end) AS DOUBLE) AS x,
               hdd_z AS y FROM mz WHERE hdd_z IS NOT NULL)
SELECT month, round(regr_slope(y, x), 6) AS slope, round(regr_intercept(y, x), 6) AS intercept,
       round(pow(corr(y, x), 2), 6) AS r_squared, round(stddev_pop(y), 6) AS stdev,
       round((regr_syy(y, x) - regr_sxy(y, x) * regr_sxy(y, x) / regr_sxx(y, x)) / regr_count(y, x), 6) AS mse,
       round(sqrt((regr_syy(y, x) - regr_sxy(y, x) * regr_sxy(y, x) / regr_sxx(y, x)) / regr_count(y, x)), 6) AS rmse
FROM pts GROUP BY month""",
    "nearest_station": CATALOGUE_SQL
    + """
SELECT station FROM within
WHERE hourly_start <= (SELECT min(l_shipdate) FROM lineitem WHERE l_returnflag = 'A')
  AND hourly_end >= (SELECT max(l_shipdate) FROM lineitem WHERE l_returnflag = 'A')
ORDER BY distance, station LIMIT 1""",
    "stations_below_median": CATALOGUE_SQL
    + """
SELECT station FROM within
WHERE distance <= (SELECT quantile_cont(distance, 0.5) FROM within)
ORDER BY hourly_start, station LIMIT 1""",
    "older_stations": CATALOGUE_SQL
    + f"""
SELECT station, name, daily_start, daily_end FROM cat
WHERE country = 'US' AND region = '{REGION}'
  AND epoch(daily_start) < (SELECT avg(epoch(daily_start)) FROM cat
                            WHERE country = 'US' AND region = '{REGION}')""",
    "station_year_extent": CATALOGUE_SQL
    + "SELECT CAST(min(year(daily_start)) AS INTEGER) AS start_year,"
    " CAST(max(year(daily_end)) AS INTEGER) AS end_year FROM cat",
    "ytd_hdd": DAILY_SQL
    + f"""
SELECT station, round(sum(CASE WHEN tavg * 1.8 + 32 <= 65 THEN 65 - (tavg * 1.8 + 32) ELSE 0 END), 6) AS hdd
FROM daily WHERE date BETWEEN make_date(year(DATE '{AS_OF}'), 1, 1) AND DATE '{AS_OF}'
GROUP BY station""",
    "ytd_hdd_running": DAILY_SQL
    + f""",
ytd AS (
  SELECT station, date,
         CASE WHEN tavg * 1.8 + 32 <= 65 THEN 65 - (tavg * 1.8 + 32) ELSE 0 END AS hdd
  FROM daily WHERE date BETWEEN make_date(year(DATE '{AS_OF}'), 1, 1) AND DATE '{AS_OF}')
SELECT station, date, round(hdd, 6) AS hdd,
       round(sum(hdd) OVER (PARTITION BY station, year(date) ORDER BY date
                            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 6) AS hdd_to_date
FROM ytd""",
    "station_slice": DAILY_SQL
    + """
SELECT station, date, round(tmin, 6) AS tmin, round(tmax, 6) AS tmax, round(tavg, 6) AS tavg
FROM daily WHERE station = 'R' AND date BETWEEN DATE '1997-03-01' AND DATE '1997-03-31'""",
    "seasonality_monthly": DAILY_SQL
    + """
SELECT station, CAST(year(month_end) AS INTEGER) AS year, CAST(month(month_end) AS INTEGER) AS month,
       round(hdd, 6) AS hdd FROM monthly""",
    "coldest_day": DAILY_SQL
    + f""",
ytd AS (
  SELECT station, date, tavg * 1.8 + 32 AS tavg_f,
         CASE WHEN tavg * 1.8 + 32 <= 65 THEN 65 - (tavg * 1.8 + 32) ELSE 0 END AS hdd
  FROM daily WHERE date BETWEEN make_date(year(DATE '{AS_OF}'), 1, 1) AND DATE '{AS_OF}')
SELECT station, date, round(tavg_f, 6) AS tavg_f FROM (
  SELECT *, row_number() OVER (PARTITION BY station ORDER BY hdd DESC, date) AS rn FROM ytd)
WHERE rn = 1""",
}

# Same presentation rounding as the Spark side (see plans.common.round_half_away).
ORACLE = {k: two_step_round(v) for k, v in ORACLE.items()}
