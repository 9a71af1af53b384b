import os

import pytest

from tessera.sources import text as T
from tests.conftest import rows


def _write(tmp_dir, name, lines, encoding="latin-1"):
    path = os.path.join(tmp_dir, name)
    with open(path, "w", encoding=encoding, newline="") as f:
        f.write("\n".join(lines) + "\n")
    return path


def test_movie_lines_commas_quotes_missing_rank_latin1(spark, tmp_dir):
    path = _write(
        tmp_dir,
        "movies.txt",
        [
            "id,name,year,rank",
            "1,Hello, World (1999),1999,7.5",
            "2,It's Méliès and Pål (1902),1902,",
            "3,Plain (2001),2001,8",
            "garbage line",
        ],
    )
    got = T.read_regex_lines(spark, path, T.MOVIE)
    kept = rows(got.kept, "id", "name", "year", "rank")
    assert kept == [
        (1, "Hello, World (1999)", 1999, 7.5),
        (2, 'It"s Méliès and Pål (1902)', 1902, None),
        (3, "Plain (2001)", 2001, 8.0),
    ]
    assert [r.value for r in got.rejects.collect()] == ["garbage line"]


def test_failfast_raises_on_unmatched(spark, tmp_dir):
    path = _write(tmp_dir, "m.txt", ["h", "1,A (1),1999,1.0", "nope"])
    with pytest.raises(Exception, match="does not match"):
        T.read_regex_lines(spark, path, T.MOVIE, mode="failfast").kept.collect()


def test_person_greedy_split_and_nulls(spark, tmp_dir):
    path = _write(
        tmp_dir,
        "p.txt",
        ["id,fname,lname,gender", "5,Jean, Jr.,Doe,M", "6,Solo,,", "7,A,B,"],
    )
    got = rows(T.read_regex_lines(spark, path, T.PERSON).kept, "id", "fname", "lname", "gender")
    assert got == [(5, "Jean, Jr.", "Doe", "M"), (6, "Solo", None, None), (7, "A", "B", None)]


def test_pairs_prefix_match_and_cast_role(spark, tmp_dir):
    p1 = _write(tmp_dir, "md.txt", ["did,mid", "10,20,extra", "11,21"])
    assert rows(T.read_regex_lines(spark, p1, T.MOVIE_DIRECTOR).kept, "did", "mid") == [
        (10, 20),
        (11, 21),
    ]
    p2 = _write(tmp_dir, "cast.txt", ["pid,mid,role", "1,2,[Hero]", "3,4,"])
    assert rows(T.read_regex_lines(spark, p2, T.CAST).kept, "pid", "mid", "role") == [
        (1, 2, "[Hero]"),
        (3, 4, None),
    ]


def test_ordinal_follows_file_order(spark, tmp_dir):
    path = _write(tmp_dir, "d.txt", ["id,f,l"] + [f"{i},F{i},L{i}" for i in (9, 3, 7, 1)])
    df = T.read_regex_lines(spark, path, T.DIRECTOR).kept.orderBy("ord")
    assert [r.id for r in df.collect()] == [9, 3, 7, 1]


def test_whitespace_columns(spark, tmp_dir):
    path = _write(tmp_dir, "e.txt", ["0 2", "  2\t0 ", "", "1  3"], encoding="utf-8")
    assert rows(T.read_edges(spark, path)) == [(0, 2), (1, 3), (2, 0)]
    lab = _write(tmp_dir, "v.txt", ["0 Adam", "1 Lisa"], encoding="utf-8")
    assert rows(T.read_labels(spark, lab)) == [(0, "Adam"), (1, "Lisa")]


def test_meter_csv_unpadded_stamps(spark, tmp_dir):
    path = _write(
        tmp_dir,
        "u.csv",
        ["a,b,c,1/5/2022 1:00:00 AM,x,1.5", "a,b,c,12/25/2022 11:00:00 PM,x,2.25"],
        encoding="utf-8",
    )
    got = [(str(r.ts), r.kwh) for r in T.read_meter_csv(spark, path).orderBy("ts").collect()]
    assert got == [("2022-01-05 01:00:00", 1.5), ("2022-12-25 23:00:00", 2.25)]


def test_header_csv_with_declared_schema(spark, tmp_dir):
    path = _write(tmp_dir, "obs.csv", ["ts,kwh,temp", "2022-01-01 00:00:00,1.5,-3.0", "2022-01-01 01:00:00,2.0,"], "utf-8")
    df = T.read_header_csv(spark, path, "ts timestamp_ntz, kwh double, temp double")
    assert [(r.kwh, r.temp) for r in df.orderBy("ts").collect()] == [(1.5, -3.0), (2.0, None)]


def test_text_nan_becomes_null(spark, tmp_dir):
    path = _write(tmp_dir, "n.csv", ["ts,kwh", "2022-01-01 00:00:00,NaN", "2022-01-01 01:00:00,2.5"], "utf-8")
    df = T.read_header_csv(spark, path, "ts timestamp_ntz, kwh double")
    assert [r.kwh for r in df.orderBy("ts").collect()] == [None, 2.5]
    ranks = _write(tmp_dir, "r.txt", ["0 nan", "1 0.5"], "utf-8")
    assert sorted((r.vertex, r.rank) for r in T.read_ranks(spark, ranks).collect()) == [(0, None), (1, 0.5)]


def test_meter_csv_empty_reading_is_null(spark, tmp_dir):
    path = _write(tmp_dir, "e.csv", ["a,b,c,1/5/2022 1:00:00 AM,x,", "a,b,c,1/5/2022 2:00:00 AM,x,3"], "utf-8")
    got = [r.kwh for r in T.read_meter_csv(spark, path).orderBy("ts").collect()]
    assert got == [None, 3.0]
