import pytest

from tessera.operators import quality as Q
from tessera.operators import relational as R
from tests.conftest import rows


@pytest.fixture()
def movie_tables(spark):
    movies = spark.createDataFrame(
        [
            (1, "Old (1890)", 1890, 5.0),
            (2, "Border (1900)", 1900, 6.0),
            (3, "Mid (1925)", 1925, 7.0),
            (4, "Leap (1996)", 1996, 8.0),
            (5, "NoLeap (1900b)", 1900, 4.0),
            (6, "Y2K (2000)", 2000, 9.0),
            (7, "Plain (1995)", 1995, None),
            (8, "Named (2001)", 2001, 8.1),
            (9, "Better (2001)", 2001, 9.1),
            (10, "Best (2001)", 2001, 9.5),
            (11, "Worse (2001)", 2001, 7.0),
        ],
        "id long, name string, year int, rank double",
    )
    persons = spark.createDataFrame(
        [(100, "A", "X", "M"), (101, "B", "Y", "F"), (102, "C", None, "M")],
        "id long, fname string, lname string, gender string",
    )
    directors = spark.createDataFrame(
        [(200, "D1", "L1"), (201, "D2", "L2"), (202, "D3", None)],
        "id long, fname string, lname string",
    )
    acts_in = spark.createDataFrame(
        [(100, 1, "r"), (100, 3, "r"), (101, 2, "r"), (102, 1, "r"), (102, 4, "r"), (101, 4, "r")],
        "pid long, mid long, role string",
    )
    directs = spark.createDataFrame(
        [(200, 4), (200, 6), (201, 5), (202, 1), (201, 4)], "did long, mid long"
    )
    return movies, persons, directors, acts_in, directs


def test_primary_key_keeps_first_and_reports_rest(spark):
    df = spark.createDataFrame(
        [(1, 2, "late", 5), (1, 2, "early", 1), (1, 3, "x", 2), (1, 2, "dup", 9), (1, 3, "x", 2)],
        "pid long, mid long, role string, ord long",
    )
    got = Q.enforce_primary_key(df, ["pid", "mid"], order_by=["ord"])
    assert rows(got.kept) == [(1, 2, "early", 1), (1, 3, "x", 2)]
    assert rows(got.rejects) == [(1, 2, "dup", 9), (1, 2, "late", 5), (1, 3, "x", 2)]
    assert got.kept.count() + got.rejects.count() == df.count()


def test_set_primary_key_on_all_columns(spark):
    df = spark.createDataFrame([(1, 2), (1, 2), (3, 4)], "did long, mid long")
    got = Q.enforce_primary_key(df, ["did", "mid"])
    assert rows(got.kept) == [(1, 2), (3, 4)]
    assert rows(got.rejects) == [(1, 2)]


def test_foreign_key_rejects_unknown_parent_keeps_null(spark):
    parent = spark.createDataFrame([(1,), (2,)], "id long")
    child = spark.createDataFrame([(1, "a"), (3, "b"), (None, "c"), (2, "d")], "mid long, v string")
    got = Q.enforce_foreign_key(child, parent, ["mid"], ["id"])
    assert rows(got.kept, "v") == [("a",), ("c",), ("d",)]
    assert rows(got.rejects, "v") == [("b",)]
    with pytest.raises(Q.ConstraintViolation):
        Q.strict(got, "fk")
    ok = Q.enforce_foreign_key(child.filter("mid = 1"), parent, ["mid"], ["id"])
    assert Q.strict(ok).count() == 1


def test_clean_text_and_zero_to_null(spark):
    df = spark.createDataFrame([("it's",), ("",), (None,)], "s string")
    assert [r[0] for r in df.select(Q.clean_text("s")).collect()] == ['it"s', None, None]
    z = spark.createDataFrame([(0.0,), (2.0,)], "h double").select(Q.zero_to_null("h"))
    assert [r[0] for r in z.collect()] == [None, 2.0]


def test_completeness_365_366_only(spark):
    import datetime as dt

    data = []
    for station, n in (("a", 364), ("b", 365), ("c", 366), ("d", 367)):
        start = dt.date(2000, 1, 1)
        data += [(station, 2000, start + dt.timedelta(days=i % 366)) for i in range(n)]
    df = spark.createDataFrame(data, "station string, year int, date date")
    kept = Q.complete_groups(df, ["station", "year"])
    assert sorted({r.station for r in kept.collect()}) == ["b", "c"]


def test_nan_to_null(spark):
    df = spark.createDataFrame([(float("nan"), 1.0), (2.0, None)], "a double, b double")
    assert rows(Q.nan_to_null(df)) == [(2.0, None), (None, 1.0)]


def test_top_k_per_year_ties_and_nulls(spark, movie_tables):
    movies = movie_tables[0]
    got = R.top_movies_per_year(movies, 1995, 2004, 2).collect()
    assert [(r.year, r.id) for r in got] == [(1996, 4), (2000, 6), (2001, 10), (2001, 9)]


def test_both_periods_border_year_counts_twice(spark, movie_tables):
    movies, persons, _, acts_in, _ = movie_tables
    got = R.active_in_both_periods(persons, acts_in, movies, (1850, 1900), (1900, 1949))
    # 100: 1890 and 1925; 101: only 1900 (border, counts for both); 102: 1890 and 1996.
    assert [r.id for r in got.collect()] == [100, 101]


def test_leap_years(spark, movie_tables):
    movies, _, directors, _, directs = movie_tables
    got = R.leap_year_directors(directors, directs, movies)
    # 1996 and 2000 are leap years, 1900 and 1890 are not.
    assert [r.id for r in got.collect()] == [200, 201]


def test_better_than_named(spark, movie_tables):
    movies = movie_tables[0]
    got = R.better_than_named(movies, "Named (2001)")
    assert [r.id for r in got.collect()] == [10, 9]
    assert R.better_than_named(movies, "Absent").count() == 0
    twice = movies.unionByName(movies.filter("id = 8"))
    with pytest.raises(Exception, match="SCALAR_SUBQUERY_TOO_MANY_ROWS|more than one row"):
        R.better_than_named(twice, "Named (2001)").collect()


def test_counts_and_distinct_counts(spark, movie_tables):
    movies, persons, directors, acts_in, directs = movie_tables
    top = R.top_directors_by_count(directors, directs, 2).collect()
    assert [(r.id, r.num) for r in top] == [(200, 2), (201, 2)]
    most = R.movies_by_cast_size(movies, acts_in, 2, most=True).collect()
    assert [(r.id, r.num_actors) for r in most] == [(1, 2), (4, 2)]
    fewest = R.movies_by_cast_size(movies, acts_in, 2, most=False).collect()
    assert [(r.id, r.num_actors) for r in fewest] == [(2, 1), (3, 1)]
    many = R.actors_with_many_directors(persons, acts_in, directs, 2).collect()
    # 102: movie 1 (202) and movie 4 (200, 201); 101: movie 4 only.
    assert [(r.id, r.num_directors) for r in many] == [(102, 3), (101, 2)]


def test_top_k_plan_limits_before_shuffle(spark, movie_tables):
    plan = R.top_movies_per_year(movie_tables[0], 1995, 2004, 2)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_top_k_before_labels_equals_join_first(spark, movie_tables):
    movies, persons, directors, acts_in, directs = movie_tables
    for fk in (False, True):
        assert [tuple(r) for r in R.top_directors_by_count(directors, directs, 2, assume_fk=fk).collect()] == [
            (200, "D1", "L1", 2),
            (201, "D2", "L2", 2),
        ]
        most = R.movies_by_cast_size(movies, acts_in, 2, most=True, assume_fk=fk).collect()
        assert [(r.id, r.num_actors) for r in most] == [(1, 2), (4, 2)]
        many = R.actors_with_many_directors(persons, acts_in, directs, 2, assume_fk=fk).collect()
        assert [(r.id, r.num_directors) for r in many] == [(102, 3), (101, 2)]
