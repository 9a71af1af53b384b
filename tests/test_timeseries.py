import datetime as dt

import pytest
from pyspark.sql import functions as F

from tessera.functions import calendar as cal
from tessera.functions import weather as wx
from tessera.operators import timeseries as ts


def _ts(s):
    return dt.datetime.fromisoformat(s)


def test_week_labels_sunday_vs_monday(spark):
    df = spark.createDataFrame([(_ts("2022-01-02 23:00:00"),), (_ts("2022-01-03 00:00:00"),)], "ts timestamp_ntz")
    got = [r[0] for r in df.select(cal.week_label("ts")).collect()]
    assert got == [dt.date(2022, 1, 2), dt.date(2022, 1, 9)]


def test_month_label_and_week_number(spark):
    df = spark.createDataFrame(
        [(dt.date(2024, 2, 10),), (dt.date(2022, 1, 1),), (dt.date(2022, 1, 7),), (dt.date(2022, 12, 31),)],
        "d date",
    )
    got = df.select(cal.month_label("d").alias("m"), cal.week_number("d").alias("w")).collect()
    assert got[0].m == dt.date(2024, 2, 29)
    assert [r.w for r in got[1:]] == [0, 1, 52]


def test_leap_year_predicate(spark):
    df = spark.createDataFrame([(1900,), (2000,), (1996,), (1995,)], "y int")
    assert [r[0] for r in df.select(cal.is_leap_year("y")).collect()] == [False, True, True, False]


def test_resample_emits_gap_bins(spark):
    rows = [(_ts("2022-01-03 10:00:00"), 1.0, 5.0), (_ts("2022-01-17 10:00:00"), 2.0, 7.0)]
    df = spark.createDataFrame(rows, "ts timestamp_ntz, kwh double, temp double")
    w = ts.resample(df, "ts", "week", [("kwh", "sum", "kwh"), ("t", "mean", "temp"), ("n", "count", "temp")])
    got = [tuple(r) for r in w.orderBy("label").collect()]
    assert got == [
        (dt.date(2022, 1, 9), 1.0, 5.0, 1),
        (dt.date(2022, 1, 16), 0.0, None, 0),
        (dt.date(2022, 1, 23), 2.0, 7.0, 1),
    ]
    m = ts.resample(
        spark.createDataFrame([(_ts("2022-01-05 00:00:00"), 1.0), (_ts("2022-03-05 00:00:00"), 1.0)], "ts timestamp_ntz, kwh double"),
        "ts", "month", [("kwh", "sum", "kwh")],
    )
    assert [r.label for r in m.orderBy("label").collect()] == [
        dt.date(2022, 1, 31), dt.date(2022, 2, 28), dt.date(2022, 3, 31)
    ]


def test_degree_day_variants(spark):
    df = spark.createDataFrame([(None,), ((65 - 32) / 1.8,), (0.0,), (30.0,)], "c double")
    out = ts.with_degree_days(df, "c", hdd_above="zero", cdd_above="null").collect()
    assert out[0].hdd == 0.0 and out[0].cdd is None  # missing day: 0 / missing
    assert out[1].hdd == pytest.approx(0.0) and out[1].cdd == pytest.approx(0.0)  # exactly 65 F
    assert out[2].hdd == pytest.approx(33.0) and out[2].cdd is None
    assert out[3].hdd == 0.0 and out[3].cdd == pytest.approx(30 * 1.8 + 32 - 65)
    nul = ts.with_degree_days(df, "c", hdd_above="null", cdd_above=None).collect()
    assert nul[0].hdd is None and nul[3].hdd is None


def test_quantile_linear_interpolation(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (10.0,)], "v double")
    assert ts.quantile_threshold(df, "v", 0.05).first().threshold == pytest.approx(1.15)


def test_weekly_rule_first_week_and_zero(spark):
    df = spark.createDataFrame(
        [(dt.date(2022, 1, 2), 10.0), (dt.date(2022, 1, 9), 0.0), (dt.date(2022, 1, 16), 4.0)],
        "label date, hdd double",
    )
    got = [tuple(r) for r in ts.weekly_hdd_rule(df).orderBy("label").collect()]
    assert got == [(dt.date(2022, 1, 2), None), (dt.date(2022, 1, 9), None), (dt.date(2022, 1, 16), 4.0)]


def test_hdd_by_week_uses_monday_to_sunday(spark):
    days = spark.createDataFrame(
        [(dt.date(2022, 1, 2), 1.0), (dt.date(2022, 1, 3), 2.0), (dt.date(2022, 1, 9), 4.0)],
        "label date, hdd double",
    )
    got = {r.label: r.hdd for r in ts.hdd_by_period(days, "week").collect()}
    assert got == {dt.date(2022, 1, 2): 1.0, dt.date(2022, 1, 9): 6.0}


def test_backward_difference_and_coldest_profiles(spark):
    hourly = spark.createDataFrame(
        [
            (_ts("2022-01-01 00:00:00"), 1.0, -10.0),
            (_ts("2022-01-01 01:00:00"), 3.0, -12.0),
            (_ts("2022-01-02 00:00:00"), 1.0, 5.0),
            (_ts("2022-01-02 01:00:00"), 1.0, 6.0),
        ],
        "ts timestamp_ntz, kwh double, temp double",
    )
    daily = ts.resample(hourly, "ts", "day", [("temp_mean", "mean", "temp")])
    prof = ts.coldest_day_profiles(hourly, daily, "temp_mean", 0.05).orderBy("ts").collect()
    assert [r.date for r in prof] == [dt.date(2022, 1, 1)] * 2
    assert prof[0].mj_h is None and prof[1].mj_h == pytest.approx(7.2)
    assert prof[1].temp_h == pytest.approx(-2.0)


def test_wind_chill_and_units(spark):
    df = spark.createDataFrame([(-10.0, 20.0)], "t double, v double")
    r = df.select(wx.wind_chill("t", "v").alias("w"), wx.kwh_to_mj(F.lit(2.0)).alias("mj")).first()
    want = 13.12 + 0.6215 * -10 - 11.37 * 20**0.16 + 0.3965 * -10 * 20**0.16
    assert r.w == pytest.approx(want) and r.mj == pytest.approx(7.2)


def test_keyed_resample_spines_per_key(spark):
    rows = [
        ("a", _ts("2022-01-01 05:00:00"), 1.0),
        ("a", _ts("2022-01-04 05:00:00"), 2.0),
        ("b", _ts("2022-01-10 05:00:00"), 3.0),
    ]
    df = spark.createDataFrame(rows, "station string, ts timestamp_ntz, kwh double")
    got = ts.resample(df, "ts", "day", [("kwh", "sum", "kwh")], keys=["station"])
    out = sorted((r.station, r.label.day, r.kwh) for r in got.collect())
    assert out == [("a", 1, 1.0), ("a", 2, 0.0), ("a", 3, 0.0), ("a", 4, 2.0), ("b", 10, 3.0)]


def test_meter_csv_to_daily_frame(spark, tmp_dir):
    import os

    from tessera.operators import energy
    from tessera.sources import text

    path = os.path.join(tmp_dir, "usage.csv")
    with open(path, "w") as f:
        f.write("a,b,c,1/1/2022 12:00:00 AM,x,1.0\na,b,c,1/1/2022 1:00:00 AM,x,2.0\na,b,c,1/1/2022 3:00:00 AM,x,4.0\n")
    readings = text.read_meter_csv(spark, path)
    obs = spark.createDataFrame(
        [
            (_ts("2022-01-01 00:10:00"), -5.0, None),
            (_ts("2022-01-01 00:40:00"), -3.0, 4.0),
            (_ts("2022-01-01 01:20:00"), 0.0, 10.0),
            (_ts("2022-01-01 03:00:00"), 2.0, 6.0),
        ],
        "ts timestamp_ntz, temp double, wspd double",
    )
    hourly = energy.hourly(readings, obs)
    got = [(r.ts.hour, r.kwh, r.temp) for r in hourly.orderBy("ts").collect()]
    assert got == [(0, 1.0, -4.0), (1, 2.0, 0.0), (3, 4.0, 2.0)]  # hour 2 has no weather
    (day,) = energy.daily(hourly, "zero", with_wind=False).collect()
    mean = (-4.0 + 0.0 + 2.0) / 3
    assert day.kwh_sum == 7.0 and day.temp_mean == pytest.approx(mean)
    assert day.hdd == pytest.approx(65 - (mean * 1.8 + 32))
