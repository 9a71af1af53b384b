"""Line numbers of files, the stored load, repeatable appends, coded lines."""

import os

import pytest

from tessera.operators import documents as D
from tessera.operators import moviedb
from tessera.plans import movies as PM
from tessera.sinks import writers
from tessera.sources import text
from tests.conftest import rows


@pytest.mark.parametrize("split", [64, 1 << 20])
def test_lines_are_numbered_over_splits_and_files(spark, tmp_dir, split):
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(split))
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        want = []
        for name, n in (("a", 50), ("b", 0), ("c", 1), ("d", 70)):
            lines = [f"{name}{i}," + "x" * (i % 9) for i in range(n)]
            with open(os.path.join(tmp_dir, name), "w") as f:
                f.write("\n".join(["head", *lines]) + "\n")
            want += lines
        numbered = text.number_lines(text.read_lines(spark, tmp_dir))
        assert [(r.ord, r.value) for r in numbered.orderBy("ord").collect()] == list(enumerate(want))
        assert dict(numbered.dtypes)["ord"] == "bigint"
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_no_lines(spark, tmp_dir):
    with open(os.path.join(tmp_dir, "empty"), "w") as f:
        f.write("only a header\n")
    assert text.number_lines(text.read_lines(spark, tmp_dir)).count() == 0


def test_documents_of_a_hot_key_from_files(spark, tmp_dir, monkeypatch):
    """One movie holds nearly all cast lines: its list has the lines' order, and is numbered range by range."""
    files = {"movies": ["id,name,year,rank", "1,Hot,1990,5.0", "2,Cold,1991,"], "persons": ["id,fname,lname,gender", "7,A,B,M"],
             "directors": ["id,fname,lname", "3,D,E"], "directs": ["did,mid", "3,1", "3,1", "4,1"],
             "cast": ["pid,mid,role"] + [f"{(i * 37) % 101},{2 if i == 5 else 1},[r{i}]" for i in range(400)]}
    paths = {}
    for name, lines in files.items():
        paths[name] = os.path.join(tmp_dir, name)
        with open(paths[name], "w", encoding="latin-1") as f:
            f.write("\n".join(lines) + "\n")
    t = moviedb.read_link_rows(spark, **paths)
    lists = D.group_to_lists(t.acts_in, "mid", ["pid", "role"], ["ord"], page=50)
    pages = sorted((r.mid, r.chunk, r.pid) for r in lists.collect())
    assert [p for m, _, part in pages if m == 1 for p in part] == [(i * 37) % 101 for i in range(400) if i != 5]
    assert max(len(part) for _, _, part in pages) == 50
    plan = lists._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(mid" in plan and "_part" in plan  # ranges of the line number share the sort
    (hot,) = D.movie_documents(t.movies, t.acts_in, t.directs, ["ord"], ["ord"]).filter("movie_id = 1").collect()
    assert hot.director_ids == [3, 3, 4] and hot.actor_roles[:2] == ["r0", "r1"]


def test_lists_without_an_order_are_ranged_by_the_value(spark):
    df = spark.createDataFrame([(1, (i * 53) % 997) for i in range(500)], "k int, v int")
    pages = D.group_to_lists(df, "k", ["v"], page=100).orderBy("chunk").collect()
    assert [v for r in pages for v in r.v] == sorted((i * 53) % 997 for i in range(500))


def test_load_is_stored_once(spark):
    root = "/root/testdata/sf0.001"
    first = PM.load_movie_tables(spark, root)
    again = PM.load_movie_tables(spark, root)
    assert first.acts_in.inputFiles() == again.acts_in.inputFiles()
    plain = PM.constrained_tables(spark, root)
    for a, b in zip(first, plain):
        assert a.columns == b.columns and rows(a) == rows(b)


def test_repeated_append_adds_nothing_twice(spark, tmp_dir):
    path = os.path.join(tmp_dir, "table")
    df = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c")], "k int, v string")
    for _ in range(3):
        writers.append_batch(df, path, "one", ["k"])
    writers.append_batch(df, path, "two", ["k"])  # another batch of equal rows is added
    assert rows(spark.read.parquet(path), "k", "v", "batch") == sorted(
        [(k, v, b) for k, v in ((1, "a"), (2, "b"), (None, "c")) for b in ("one", "two")], key=lambda t: tuple((x is None, x) for x in t)
    )


def test_append_after_a_failure_completes_the_batch(spark, tmp_dir):
    path = os.path.join(tmp_dir, "table")
    df = spark.range(100).selectExpr("id AS k", "id * id AS v")
    writers.append_batch(df.filter("k % 3 = 0"), path, "b", ["k"])  # what a run that stopped half-way left
    writers.append_batch(df, path, "b", ["k"])
    assert rows(spark.read.parquet(path), "k", "v") == [(i, i * i) for i in range(100)]


def test_coded_lines_read_back(spark, tmp_dir):
    lines = ['1,"Été", l\'an,1999,5.5', "2,,2000,", '3,a\\b"c" ,2001,1.0', ""]
    path = os.path.join(tmp_dir, "lines")
    writers.write_coded_lines(spark.createDataFrame([(x,) for x in lines], "line string").coalesce(1), "line", path, "id,name,year,rank")
    got = sorted(r.value for r in text.read_lines(spark, path).collect())
    assert got == sorted(x for x in lines if x)  # blank lines are not lines of a CSV reader
    part = next(p for p in os.listdir(path) if p.startswith("part"))
    with open(os.path.join(path, part), "rb") as f:
        assert b"\xc9t\xe9" in f.read()


def test_a_hot_partition_value_gets_several_files(spark, tmp_dir):
    df = spark.range(4000).selectExpr("IF(id % 10 = 0, 1990 + id % 7, 2000) AS year", "id * 7919 % 4001 AS name")
    path = os.path.join(tmp_dir, "t")
    writers.write_partitioned(df, path, ["year"], ["name"], rows_per_file=400)
    back = spark.read.parquet(path)
    assert rows(back, "year", "name") == rows(df, "year", "name")
    parts = [p for p in os.listdir(os.path.join(path, "year=2000")) if p.endswith(".parquet")]
    assert len(parts) >= 7
    for p in parts:
        names = [r.name for r in spark.read.parquet(os.path.join(path, "year=2000", p)).collect()]
        assert names == sorted(names) and len(names) < 1000
    ranges = sorted((min(n), max(n)) for n in ([r.name for r in spark.read.parquet(os.path.join(path, "year=2000", p)).collect()] for p in parts))
    assert all(a[1] < b[0] for a, b in zip(ranges, ranges[1:]))  # each file a range of its own
    plan = back.filter("year = 2000")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan


def test_bucketed_tables_join_without_an_exchange(spark, tmp_dir):
    a = writers.write_bucketed(spark.range(1000).selectExpr("id AS k", "id % 3 AS v"), "bucketed_a", os.path.join(tmp_dir, "a"), ["k"], 4)
    b = writers.write_bucketed(spark.range(3000).selectExpr("id % 1000 AS j", "id AS w"), "bucketed_b", os.path.join(tmp_dir, "b"), ["j"], 4)
    joined = a.join(b.hint("merge"), a.k == b.j)
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Exchange" not in plan
    assert joined.count() == 3000
