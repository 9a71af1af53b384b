"""Nearest stations of many points, periods, scans of one series, exact quantiles, bitmaps, nested blocks."""

import datetime as dt
import math
import random
import re

import pytest
from pyspark.sql import functions as F

from tessera.functions import weather as wx
from tessera.operators import articles as A
from tessera.operators import periods, quantiles, relational, series, spatial
from tests.conftest import rows


def metres(a, b):
    p1, p2, dl = math.radians(a[0]), math.radians(b[0]), math.radians(b[1]) - math.radians(a[1])
    h = math.sin((p2 - p1) / 2) ** 2 + math.cos(p1) * math.cos(p2) * math.sin(dl / 2) ** 2
    return 2 * wx.EARTH_RADIUS_M * math.asin(math.sqrt(min(1.0, h)))


@pytest.mark.parametrize("n,k,cluster", [(60, 3, False), (400, 2, True), (2, 3, False), (1, 1, False)])
def test_k_nearest_equals_full_distance(spark, n, k, cluster):
    rng = random.Random(n)
    stations = [(i, rng.uniform(-90, 90), rng.uniform(-180, 180)) if not cluster or i % 3 == 0 else (i, 44 + rng.uniform(0, 0.5), 179.9 + rng.uniform(0, 0.2) - 360 * (i % 2)) for i in range(n)]
    points = [(i, rng.uniform(-90, 90), rng.uniform(-180, 180)) for i in range(60)] + [(100, 90.0, 0.0), (101, -90.0, 5.0), (102, 44.2, 180.0), (103, 44.2, -180.0), (104, None, 3.0), (105, 44.2, 180.0)]
    stations_df = spark.createDataFrame([*stations, (n + 5, None, 1.0)], "station int, latitude double, longitude double")
    got = spatial.k_nearest(spark.createDataFrame(points, "p int, latitude double, longitude double"), stations_df, k)
    have = {}
    for r in got.collect():
        have.setdefault(r["p"], {})[r["nearest_rank"]] = (r["station"], r["distance"])
    for p, lat, lon in points:
        if lat is None:
            assert p not in have
            continue
        want = sorted((metres((lat, lon), (a, b)), s) for s, a, b in stations)[:k]
        assert [have[p][i + 1][0] for i in range(len(want))] == [s for _, s in want]
        assert all(abs(have[p][i + 1][1] - d) < 1e-3 for i, (d, _) in enumerate(want)) and len(have[p]) == len(want)


def test_k_nearest_far_from_all_stations_meets_few(spark):
    rng = random.Random(8)
    stations = [(i, rng.uniform(70, 80), rng.uniform(-180, 180)) for i in range(4000)] + [(9000 + i, 75.0, 10.0) for i in range(1500)]
    points = [(i, rng.uniform(84, 89), rng.uniform(-180, 180)) for i in range(200)] + [(900, float("nan"), 1.0), (901, 75.0, 10.0)]
    s = spark.createDataFrame([*stations, (9999, float("nan"), 5.0)], "station int, latitude double, longitude double")
    p = spark.createDataFrame(points, "p int, latitude double, longitude double")
    have = {(r["p"], r["nearest_rank"]): r["station"] for r in spatial.k_nearest(p, s, 3).collect()}
    for i, lat, lon in points:
        want = [0, 1, 2] if i == 900 else [x for _, x in sorted((metres((lat, lon), (a, b)), x) for x, a, b in stations)[:3]]
        assert [have.pop((i, r)) for r in (1, 2, 3)] == want
    assert not have
    asked, sited = (spatial._numbered(spatial.on_sphere(df.filter("not isnan(latitude)"), "latitude", "longitude")) for df in (p, s.filter("station < 9000")))
    measured = 0
    for level, cells in spatial._candidates(asked, sited, 3).items():
        lists = cells.select("_q", "_total").distinct()
        measured += asked.withColumn("_q", spatial._cell(level)).join(lists, "_q").agg({"_total": "sum"}).first()[0]
    assert measured < 0.05 * len(points) * 4000


def test_k_nearest_has_no_cross_join(spark):
    empty = spark.createDataFrame([], "station int, latitude double, longitude double")
    points = spark.createDataFrame([(1, 2.0, 3.0)], "p int, latitude double, longitude double")
    assert spatial.k_nearest(points, empty, 2).count() == 0 and spatial.k_nearest(points.limit(0), empty, 2).count() == 0
    plan = spatial.k_nearest(points, empty, 2)._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan


def test_periods_equal_a_range_join(spark):
    rng = random.Random(4)
    day = dt.datetime(2020, 1, 1)
    points = [(i, day + dt.timedelta(hours=rng.randrange(0, 24 * 900)), float(i)) for i in range(300)] + [(900, None, 1.0), (901, day, 2.0), (902, day, 3.0)]
    spans = [(i, day + dt.timedelta(hours=rng.randrange(0, 20_000)), dt.timedelta(hours=rng.choice([1, 24, 24 * 7, 24 * 31, 24 * 365]))) for i in range(150)]
    spans = [(i, a, a + d) for i, a, d in spans]
    spans += [(500, day - dt.timedelta(days=36_500), day + dt.timedelta(days=36_500)), (501, day, day), (502, day + dt.timedelta(1), day), (503, None, day), (504, day, None)]
    spans += [(600 + i, day, day + dt.timedelta(days=1)) for i in range(200)]  # a hot bin
    p = spark.createDataFrame(points, "id int, at timestamp, v double")
    s = spark.createDataFrame(spans, "period int, start timestamp, end timestamp")
    want = sorted((q, i) for q, a, b in spans for i, t, _ in points if a and b and t and a < t <= b)
    pairs = periods.assign_periods(p, s, "at")
    assert rows(pairs, "period", "id") == want
    plan = pairs._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan
    totals = {r["period"]: (r["n"], r["v"]) for r in periods.period_totals(p, s, "at", "v", "period").collect()}
    assert totals == {q: (sum(1 for w, _ in want if w == q), sum(float(i) if i < 900 else i - 899.0 for w, i in want if w == q) if any(w == q for w, _ in want) else None) for q, _, _ in spans}
    assert periods.assign_periods(p, s.limit(0), "at").count() == periods.assign_periods(p.limit(0), s, "at").count() == 0


@pytest.mark.parametrize("limit", [1, 7, 1000])
def test_scan_equals_one_window(spark, limit):
    rng = random.Random(limit)
    day = dt.datetime(2021, 3, 1)
    data = [(i, day + dt.timedelta(seconds=rng.choice([rng.randrange(10**7), rng.randrange(500), 77])), rng.choice([None, float(rng.randrange(-50, 50))])) for i in range(400)]
    data.append((999, None, 5.0))
    df = spark.createDataFrame(data, "id int, ts timestamp, v double")
    out = series.scan_series(df, "ts", "v", ["id"], rows=limit)
    last, total, want = None, 0.0, []
    for i, t, v in sorted((r for r in data if r[1]), key=lambda r: (r[1], r[0])):
        total += v or 0.0
        want.append((i, last, v - last if v is not None and last is not None else None, total))
        last = v
    assert rows(out, "id", "previous", "difference", "running") == sorted(want)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan
    if limit == 7:  # a third of the rows have one time
        sizes = [r["count"] for r in series.ranged_series(df.filter("ts is not null"), ["ts", "id"], 7).groupBy("_range").count().collect()]
        assert len(sizes) > 30 and max(sizes) < 40
    assert series.scan_series(df.limit(0), "ts", "v").count() == 0


def test_quantiles_equal_percentile(spark, monkeypatch):
    rng = random.Random(9)
    qs = [0.0, 0.01, 0.25, 0.5, 0.77, 1.0]
    for bins in (2, 1024):
        monkeypatch.setattr(quantiles, "BINS", bins)
        for values in ([rng.gauss(0, 1) for _ in range(200)], [1.0] * 50, [rng.choice([1.0, 2.0, 1e300, -1e300]) for _ in range(60)], [5.0], [0.1, 0.1 + 1e-17, 0.3]):
            df = spark.createDataFrame([(v,) for v in values] + [(None,), (float("nan"),)], "v double").repartition(3)
            want = [df.filter("not isnan(v)").agg(F.percentile("v", q)).first()[0] for q in (qs if bins == 1024 else qs[2:4])]
            got = quantiles.exact_quantiles(df, "v", qs if bins == 1024 else qs[2:4])
            assert got == pytest.approx(want, rel=1e-12)
    assert quantiles.exact_quantiles(spark.createDataFrame([], "v double"), "v", [0.5]) == [None]


@pytest.mark.parametrize("bitmap_from", [1, 4, 10**6])
def test_distinct_directors_by_bitmaps(spark, bitmap_from):
    rng = random.Random(6)
    acts = [(rng.randrange(40), rng.randrange(12)) for _ in range(200)] + [(None, 1), (1, None)]
    directs = [(rng.choice([rng.randrange(30), 32_760 + rng.randrange(20), 10**12 + rng.randrange(3)]), rng.choice([0, rng.randrange(12)])) for _ in range(150)] + [(None, 1), (3, None)]
    want = {}
    for p, m in acts:
        for d, n in directs:
            if p is not None and m is not None and m == n and d is not None:
                want.setdefault(p, set()).add(d)
    a, d = spark.createDataFrame(acts, "pid bigint, mid bigint"), spark.createDataFrame(directs, "did bigint, mid bigint")
    assert rows(relational.directors_per_actor(a, d, bitmap_from), "pid", "num_directors") == sorted((p, len(x)) for p, x in want.items())


def blocks_of(html, tag, attributes):
    """Blocks by a walk over the tags with a stack."""
    html = re.sub(A.HIDDEN, "", html or "")
    open_, out = [], []
    for m in re.finditer(rf"(?is)</?{tag}\b[^>]*>", html):
        if m[0].startswith("</"):
            if open_:
                at, start = open_.pop()
                if at is not None:
                    out[at] = html[start : m.start()]
        else:
            wanted = re.search(attributes, m[0])
            open_.append((len(out) if wanted else None, m.end()))
            if wanted:
                out.append(None)
    for at, start in open_:
        if at is not None:
            out[at] = html[start:]
    return out


def test_nested_blocks_equal_a_stack_walk(spark):
    rng = random.Random(12)
    pieces = ['<div class="r">', '<div class="r">', "<div>", "</div>", "</div>", "</DIV >", "text ", "<p>x</p>", "<!-- <div> -->", '<script>"<div>"</script>', "<divider>"]
    pages = [(i, "".join(rng.choice(pieces) for _ in range(rng.randrange(0, 40)))) for i in range(120)]
    pages += [(200, None), (201, ""), (202, "no tags"), (203, "</div></div><div class=\"r\">a</div>"), (204, '<div class="r">' * 30 + "x" + "</div>" * 30), (0, '<div class="r">again</div>')]
    df = spark.createDataFrame([(i, h, "clash") for i, h in pages], "page_id int, html string, block string").repartition(4)
    got = A.nested_blocks(df, "div", 'class="r"')
    assert rows(got) == sorted((i, n, b) for i, h in pages for n, b in enumerate(blocks_of(h, "div", 'class="r"')))


def test_nested_blocks_of_a_big_page(spark):
    html = "".join(f'<div class="r"><div>in {i}</div> out</div>' for i in range(20_000))
    got = A.nested_blocks(spark.createDataFrame([(1, html)], "page_id int, html string"), "div", 'class="r"')
    assert got.count() == 20_000 and got.filter("block = '<div>in 7</div> out'").count() == 1


def test_nested_blocks_pass_page_by_page(spark):
    pages = [(1, '<div class="r">a<div>b</div>c'), (2, None), (3, "no tags"), (1, '</div><div class="r"><div class="r">x</div></div>')]
    got = A.nested_blocks(spark.createDataFrame(pages, "page_id int, html string"), "div", 'class="r"')
    want = [(1, 0, '<div class="r">x</div>'), (1, 0, "a<div>b</div>c"), (1, 1, "x")]
    assert sorted(tuple(r) for r in got.collect()) == want
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Sort" not in plan and "Window" not in plan
