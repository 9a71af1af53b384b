import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from tessera.plans import catalog
from tessera.operators import articles as A
from tessera.operators import documents as D
from tessera.operators import stations as S
from tessera.sinks import writers
from tessera.sources.tables import read_documents
from tests.conftest import SF_SMALL, rows

# ------------------------------------------------------------------ stations


@pytest.fixture()
def catalogue(spark):
    t = dt.datetime
    return spark.createDataFrame(
        [
            (1, "near-new", "US", "R1", 44.04, -70.00, t(2000, 1, 1), t(2030, 1, 1)),
            (2, "near-old", "US", "R1", 44.24, -70.10, t(1950, 1, 1), t(2030, 1, 1)),
            (3, "mid", "US", "R1", 44.84, -70.00, t(1940, 1, 1), t(2030, 1, 1)),
            (4, "far", "US", "R2", 46.94, -70.00, t(1900, 1, 1), t(2030, 1, 1)),
            (5, "short", "US", "R1", 44.01, -70.00, t(2020, 1, 1), t(2021, 1, 1)),
        ],
        "station int, name string, country string, region string, latitude double, "
        "longitude double, hourly_start timestamp_ntz, hourly_end timestamp_ntz",
    ).withColumn("daily_start", F.col("hourly_start")).withColumn("daily_end", F.col("hourly_end"))


def test_radius_nearest_and_median_choice(spark, catalogue):
    near = S.within_radius(catalogue, 44.0, -70.0, 70)
    assert [r.station for r in near.collect()] == [5, 1, 2, 3]
    assert near.first().distance == pytest.approx(1111.95, rel=1e-3)  # 0.01 degree of latitude
    series = spark.createDataFrame([(dt.datetime(2010, 1, 1),), (dt.datetime(2022, 1, 1),)], "ts timestamp_ntz")
    assert S.nearest_covering(catalogue, series, "ts", 44.0, -70.0, 70).first().station == 1
    # median distance of 4 stations -> two nearest; the older of them is 1
    assert S.earliest_among_closest(near).first().station == 1
    assert [r.station for r in S.older_than_average(S.in_region(catalogue, "US", "R1")).collect()] == [3, 2]
    ext = S.year_extent(catalogue).first()
    assert (ext.start_year, ext.end_year) == (1900, 2030)


def _year_of_days(station, year, n, tmin, tmax):
    start = dt.date(year, 1, 1)
    return [(station, start + dt.timedelta(days=i), tmin, tmax, (tmin + tmax) / 2) for i in range(n)]


def test_annual_panel_complete_years_only(spark):
    data = (
        _year_of_days("A", 2001, 365, -10.0, 10.0)
        + _year_of_days("A", 2002, 300, -10.0, 10.0)
        + _year_of_days("B", 2001, 365, 30.0, 40.0)
    )
    daily = spark.createDataFrame(data, "station string, date date, tmin double, tmax double, tavg double")
    annual = {(r.station, r.year): r.hdd for r in S.annual_hdd(daily).collect()}
    # midpoint 0 C = 32 F -> 33 HDD a day; B is never below 65 F -> total 0 -> NULL
    assert annual == {("A", 2001): pytest.approx(365 * 33.0), ("B", 2001): None}
    as_written = S.annual_hdd(daily, "as_written").filter("station = 'A'").first().hdd
    assert as_written == pytest.approx(365 * (65 - ((10 - 5) * 1.8 + 32)))
    panel = S.panel(S.annual_hdd(daily), ["A", "B"], 2000, 2002).collect()
    assert [r.year for r in panel] == [2000, 2001]  # end year exclusive
    assert panel[0].A is None and panel[1].A == pytest.approx(365 * 33.0)


def test_ytd_and_coldest_day_first_on_ties(spark):
    data = [
        ("A", dt.date(2023, 12, 31), 0.0, 0.0, -40.0),
        ("A", dt.date(2024, 1, 1), 0.0, 0.0, -5.0),
        ("A", dt.date(2024, 1, 2), 0.0, 0.0, -20.0),
        ("A", dt.date(2024, 1, 3), 0.0, 0.0, -20.0),
        ("A", dt.date(2024, 2, 1), 0.0, 0.0, -30.0),
    ]
    daily = spark.createDataFrame(data, "station string, date date, tmin double, tmax double, tavg double")
    ytd = S.ytd_hdd(daily, "2024-01-31").first().hdd
    assert ytd == pytest.approx((65 - 23) + 2 * (65 - (-4)))
    cold = S.coldest_day(daily, "2024-01-31").first()
    assert cold.date == dt.date(2024, 1, 2) and cold.tavg_f == pytest.approx(-4.0)


# ------------------------------------------------------------------ articles


def test_clean_articles_rules(spark):
    raw = spark.createDataFrame(
        [
            ('[PDF] "Deep [HTML] Nets"  ', "A, B - Conf, 2022 - Pub", "Cited by 100"),
            ("two parts", "A - Conf 2022", "Cited by 5"),
            ("four parts", "A - B - C 2022 - D", "Cited by 5"),
            ("nbsp", "A - Journal 2021 - Pub", "Cited by 7"),
            ("only year", "A - 2022 - Pub", "Cited by 9"),
            ("no cites", "A - V 2022 - Pub", None),
            ("two numbers", "A - V 2022 - Pub", "Cited by 3 of 4"),
            ("no year", "A - Venue only - Pub", "Cited by 1"),
            ("title", "publication_info", "cited_by"),
        ],
        "title string, publication_info string, cited_by string",
    )
    got = {r.title: r for r in A.clean_articles(raw, 2024).collect()}
    assert sorted(got) == ["Deep  Nets", "nbsp", "only year"]
    deep = got["Deep  Nets"]
    assert (deep.authors, deep.venue, deep.year, deep.publisher) == ("A, B", "Conf,", 2022, "Pub")
    assert deep.citation_count == 100 and deep.avg_citations_per_year == pytest.approx(100 / 3)
    assert got["nbsp"].authors == "A" and got["nbsp"].venue == " Journal" and got["nbsp"].year == 2021
    assert got["only year"].venue is None and got["only year"].year == 2022
    recent = A.highly_cited(A.clean_articles(raw, 2024), 50, 2022).collect()
    assert [r.title for r in recent] == ["Deep  Nets"]


def test_year_counts_and_histogram(spark):
    clean = spark.createDataFrame(
        [(2022, 10, 1.0), (2022, 30, 2.0), (2024, 5, 5.0)],
        "year int, citation_count int, avg_citations_per_year double",
    )
    per_year = rows(A.articles_per_year(clean, [2022, 2023, 2024]))
    assert per_year == [(2022, 2), (2023, 0), (2024, 1)]
    cites = {r.year: r for r in A.citations_per_year(clean, [2022, 2023, 2024]).collect()}
    assert cites[2022].mean_citations == 20.0 and cites[2023].mean_citations is None
    hist = A.histogram(clean, "avg_citations_per_year", 50).orderBy("bin").collect()
    assert len(hist) == 50 and sum(r["count"] for r in hist) == 3
    assert hist[49]["count"] == 1 and hist[0]["count"] == 1  # the maximum lands in the last bin
    assert hist[49].bin_hi == pytest.approx(5.0)


def test_extract_records_first_matching_link(spark):
    html = (
        '<div class="gs_ri"><h3 class="gs_rt">A &amp; B</h3><div class="gs_a">X - V, 2022 - P</div>'
        '<div class="gs_fl"><a href="#">Save</a><a href="#">Cited by 12</a><a>Cited by 99</a></div></div>'
        '<div class="gs_ri"><h3 class="gs_rt">C</h3><div class="gs_a">Y</div>'
        '<div class="gs_fl"><a>Related</a></div></div>'
    )
    pages = spark.createDataFrame([(1, html)], "page_id long, html string")
    got = A.extract_records(
        pages,
        r'(?s)<div class="gs_ri">(.*?</div></div>)',
        r'(?s)<h3 class="gs_rt">(.*?)</h3>',
        r'(?s)<div class="gs_a">(.*?)</div>',
        "Cited by",
    ).orderBy("pos").collect()
    assert [(r.title, r.publication_info, r.cited_by) for r in got] == [
        ("A & B", "X - V, 2022 - P", "Cited by 12"),
        ("C", "Y", None),
    ]


# ------------------------------------------------------------------ documents


def test_documents_aligned_lists_and_lookup(spark, tmp_dir):
    movies = spark.createDataFrame(
        [(1, "Named (2001)", 2001, 8.1), (2, "Other", 1999, None)], "id long, name string, year int, rank double"
    )
    persons = spark.createDataFrame(
        [(10, "A", "a", "M"), (11, "B", "b", "F"), (12, "C", None, None)],
        "id long, fname string, lname string, gender string",
    )
    directors = spark.createDataFrame([(20, "D", "d"), (21, "E", "e"), (22, "Idle", "x")], "id long, fname string, lname string")
    acts = spark.createDataFrame(
        [(11, 1, "[Sidekick]", 1), (10, 1, "Lead/Narrator", 2), (11, 2, None, 3)],
        "pid long, mid long, role string, ord long",
    )
    directs = spark.createDataFrame([(21, 1), (20, 1), (23, 2)], "did long, mid long")
    docs = D.build_documents(movies, persons, directors, acts, directs, ["ord"])
    named = docs.filter("doc_type = 'movie' AND movie_id = 1").first()
    assert named.director_ids == [20, 21]
    assert named.actor_ids == [11, 10] and named.actor_roles == ["Sidekick", "Lead/Narrator"]
    other = docs.filter("doc_type = 'movie' AND movie_id = 2").first()
    assert other.rank is None and other.actor_roles == [None]
    heads = {r.director_id: r for r in docs.filter("doc_type = 'director'").collect()}
    assert sorted(heads) == [20, 21, 23]  # 22 has no movie; 23 has no name
    assert heads[23].first_name is None
    person = {r.person_id: r for r in docs.filter("doc_type = 'person'").collect()}
    assert person[11].movie_ids == [1, 2] and person[12].movie_ids is None

    path = os.path.join(tmp_dir, "docs")
    writers.write_documents(docs, path)
    back = read_documents(spark, path)
    anchor = D.find_one(back, doc_type="movie", name="Named (2001)")
    related = D.find_related(read_documents(spark, path, "person"), anchor, "actor_ids", "person_id")
    assert sorted(r.first_name for r in related.collect()) == ["A", "B"]


# ------------------------------------------------------------------ entry


def test_entry_and_registry(spark):
    df = E.entry(spark)
    assert df.columns == ["id", "name", "year", "rank"]
    assert df.count() > 0
    qs, oracle = E.queries(), E.oracle_sql()
    assert set(oracle) <= set(qs)
    assert set(catalog.QUERIES) <= set(qs)
    assert set(catalog.QUERIES) == set(oracle) & set(catalog.QUERIES)


@pytest.mark.parametrize("name", sorted(E.queries()))
def test_every_query_runs_small(spark, name):
    E.queries()[name](spark, SF_SMALL).write.format("noop").mode("overwrite").save()


def test_hot_key_lists_are_bucketed(spark):
    links = spark.createDataFrame(
        [(1, i, f"r{i}", i) for i in range(50)] + [(2, 7, "x", 0), (2, 3, "y", 1)],
        "mid long, pid long, role string, ord long",
    )
    lists = D.group_to_lists(links, "mid", ["pid", "role"], ["ord"], ["ids", "roles"], page=10)
    hot = lists.filter("mid = 1").collect()
    assert len(hot) == 5  # ceil(50 / 10) chunks
    assert sorted(i for r in hot for i in r.ids) == list(range(50))
    for r in hot:
        assert r.ids == sorted(r.ids) and r.roles == [f"r{i}" for i in r.ids]
    (cold,) = lists.filter("mid = 2").collect()
    assert cold.chunk == 0 and cold.ids == [7, 3] and cold.roles == ["x", "y"]
