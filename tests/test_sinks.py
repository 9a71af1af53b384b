import glob
import os

from tessera.sinks import writers


def _read_all(folder, pattern="part-*"):
    out = []
    for f in sorted(glob.glob(os.path.join(folder, pattern))):
        with open(f, encoding="utf-8") as fh:
            out.append(fh.read())
    return "".join(out)


def test_semicolon_csv_doubles_quotes_single_file(spark, tmp_dir):
    df = spark.createDataFrame([(1, 'Say "hi" (1999)', 1999, 7.5)], "id long, name string, year int, rank double")
    path = os.path.join(tmp_dir, "best")
    writers.write_csv(df, path, sep=";", single_file=True)
    assert len(glob.glob(os.path.join(path, "part-*"))) == 1
    assert _read_all(path).splitlines() == ["id;name;year;rank", '1;"Say ""hi"" (1999)";1999;7.5']


def test_append_adds_files_and_arrays_become_json(spark, tmp_dir):
    path = os.path.join(tmp_dir, "raw")
    df = spark.createDataFrame([("t", [1, 2])], "title string, ids array<int>")
    writers.write_csv(df, path, single_file=True)
    writers.write_csv(df, path, mode="append", single_file=True)
    text = _read_all(path)
    assert text.count("title,ids") == 2 and text.count('"[1,2]"') == 2


def test_text_lines_and_partitioned_layout(spark, tmp_dir):
    df = spark.createDataFrame([(0, 0.25), (1, 0.75)], "vertex long, rank double")
    path = os.path.join(tmp_dir, "ranks")
    writers.write_lines(df.orderBy("vertex"), ["vertex", "rank"], path)
    assert _read_all(path).splitlines() == ["0 0.25", "1 0.75"]
    movies = spark.createDataFrame(
        [(1, "b", 2000), (2, "a", 2000), (3, "c", 2001)], "id long, name string, year int"
    )
    out = os.path.join(tmp_dir, "by_year")
    writers.write_partitioned(movies, out, ["year"], ["name"])
    assert sorted(os.path.basename(p) for p in glob.glob(os.path.join(out, "year=*"))) == ["year=2000", "year=2001"]
    back = spark.read.parquet(out).filter("year = 2000")
    assert sorted(r.name for r in back.collect()) == ["a", "b"]
    tables = {"movie": movies}
    writers.write_tables(tables, os.path.join(tmp_dir, "db"))
    assert spark.read.parquet(os.path.join(tmp_dir, "db", "movie")).count() == 3
