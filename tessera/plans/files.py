"""Registered queries of the file sources and sinks (S1-S9, K1, K3, K5, K6): each writes a
test table in the source's file format, in the shared folder, with the library's writers, and
returns what the library's readers make of the files.

The five movie files are ISO-8859-1 lines; titles hold a comma and letters beyond ASCII. Link
lines are written in the order of (order key, line number), so a line's number is its place in that
order.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators import documents as D
from tessera.operators import moviedb, relational
from tessera.plans import movies as PM
from tessera.plans.documents import flat
from tessera.session import checkpoint_dir, pin_utc, small_tasks, stored
from tessera.sinks import writers
from tessera.sources import text
from tessera.sources.tables import read_table

TITLE = "Série, numéro "


def folder(spark: SparkSession, label: str) -> str:
    return f"{checkpoint_dir(spark)}/{label}-{uuid.uuid4().hex}"


def _lines(df: DataFrame, header: str, *fields: str | Column) -> tuple[DataFrame, str]:
    parts = [F.coalesce(F.col(f).cast("string") if isinstance(f, str) else f, F.lit("")) for f in fields]
    return df.select(F.concat_ws(",", *parts).alias("line")), header


def movie_files(spark: SparkSession, root: str, only: tuple[str, ...] = ()) -> dict[str, str]:
    """Writes the stand-ins as the five files; returns their folders by name."""
    pin_utc(spark)
    ordered = read_table(spark, root, "lineitem").orderBy("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag")
    made = {
        "movies": lambda: _lines(
            PM.raw_movies(spark, root), "id,name,year,rank", "id", F.concat(F.lit(TITLE), F.col("id").cast("string")), "year",
            F.col("rank").cast("decimal(18,2)").cast("string"),
        ),
        "persons": lambda: _lines(PM.raw_persons(spark, root), "id,fname,lname,gender", "id", "fname", "lname", "gender"),
        "directors": lambda: _lines(PM.raw_directors(spark, root), "id,fname,lname", "id", "fname", "lname"),
        "directs": lambda: _lines(ordered, "did,mid", "l_suppkey", "l_orderkey"),
        "cast": lambda: _lines(ordered, "pid,mid,role", "l_partkey", "l_orderkey", F.concat(F.lit("["), "l_returnflag", F.lit("]"))),
    }
    base, paths = folder(spark, "movie-files"), {}
    for name in only or made:
        lines, header = made[name]()
        paths[name] = f"{base}/{name}"
        writers.write_coded_lines(lines, "line", paths[name], header)
    return paths


def _read(spark, root, name: str, spec: text.LineSpec, dense: bool = False) -> DataFrame:
    return text.read_regex_lines(spark, movie_files(spark, root, (name,))[name], spec, dense=dense).kept


def q_file_movies(spark, root):
    """Movies parsed from ISO-8859-1 lines."""
    return _read(spark, root, "movies", text.MOVIE).drop("ord")


def q_file_persons(spark, root):
    """S2."""
    return _read(spark, root, "persons", text.PERSON).drop("ord")


def q_file_directors(spark, root):
    """S3."""
    return _read(spark, root, "directors", text.DIRECTOR).drop("ord")


def q_file_directs(spark, root):
    """S4, with the dense line number."""
    return _read(spark, root, "directs", text.MOVIE_DIRECTOR, True)


def q_file_cast(spark, root):
    """S5, with the dense line number."""
    return _read(spark, root, "cast", text.CAST, True)


def q_file_person_documents(spark, root):
    """S1-S5 + G3: person documents from the files, lists in the order of the lines."""
    t = moviedb.read_link_rows(spark, **movie_files(spark, root))
    docs = D.person_documents(t.persons, t.acts_in, ["ord"])
    return docs.select("first_name", "last_name", "gender", "person_id", "chunk", flat("movie_ids"), flat("movie_roles"))


def q_file_movie_documents(spark, root):
    """S1-S5 + G3: movie documents from the files, lists in the order of the lines."""
    t = moviedb.read_link_rows(spark, **movie_files(spark, root))
    docs = D.movie_documents(t.movies, t.acts_in, t.directs, ["ord"], ["ord"])
    return docs.select("name", "year", "rank", "movie_id", "chunk", flat("director_ids"), flat("actor_ids"), flat("actor_roles"))


def q_file_load_most_actors(spark, root):
    """S1-S5 + K1 + Q5: the constrained load of the files, stored, then a query on it."""
    with small_tasks(spark, read_table(spark, root, "lineitem").count()):
        tables, _ = moviedb.read_movie_files(spark, **movie_files(spark, root))
        t = moviedb.stored_tables(spark, moviedb.store_tables(tables, folder(spark, "movie-load")))
        top = stored(relational.movies_by_cast_size(t.movies, t.acts_in, 10, most=True, assume_fk=True), "top")
    return top.orderBy(F.desc("num_actors"), "id")


def q_file_edges(spark, root):
    """K6 + S6: an edge list written as lines and read back."""
    path = folder(spark, "edges")
    edges = read_table(spark, root, "lineitem").select(F.col("l_partkey").alias("src"), F.col("l_suppkey").alias("dst"))
    writers.write_lines(edges, ["src", "dst"], path, single_file=False)
    return text.read_edges(spark, path)


def q_file_ranks(spark, root):
    """K6 + S7: vertex and value lines."""
    path = folder(spark, "ranks")
    writers.write_lines(read_table(spark, root, "customer").select("c_custkey", "c_acctbal"), ["c_custkey", "c_acctbal"], path, single_file=False)
    return text.read_ranks(spark, path)


def q_file_meter(spark, root):
    """Meter readings by position from headerless CSV with 12-hour stamps."""
    path = folder(spark, "meter")
    e = read_table(spark, root, "events")
    stamp = F.date_format("ts", "M/d/yyyy h:mm:ss a")
    writers.write_csv(e.select("event_id", "user_id", "event_type", stamp.alias("stamp"), "props", "value"), path, header=False)
    return text.read_meter_csv(spark, path)


def q_file_orders_csv(spark, root):
    """K3 + K5 + S9: an order table as CSV with a header, half of it appended as a batch that is run
    twice, both halves read back."""
    o = read_table(spark, root, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice", F.to_date("o_orderdate").alias("o_orderdate"))
    odd = F.col("o_orderkey") % 2 == 1
    path, batches = folder(spark, "orders-csv"), folder(spark, "orders-batches")
    writers.write_csv(o.filter(~odd), path, sep=",")
    for _ in range(2):
        writers.append_batch(o.filter(odd), batches, "odd", ["o_orderkey"])
    half = text.read_header_csv(spark, path, "o_orderkey bigint, o_orderstatus string, o_totalprice double, o_orderdate date")
    return half.unionByName(spark.read.parquet(batches).drop("batch"))


def q_orders_of_a_year(spark, root):
    """Orders laid out by year and sorted by price, hot years in several files; one year read back."""
    pin_utc(spark)
    o = read_table(spark, root, "orders").select("o_orderkey", "o_totalprice", F.year("o_orderdate").alias("year"))
    path = folder(spark, "orders-by-year")
    writers.write_partitioned(o, path, ["year"], ["o_totalprice"], rows_per_file=2_000)
    return spark.read.parquet(path).filter("year = 1996 and o_totalprice < 50000")


def q_bucketed_totals(spark, root):
    """Orders and their lines, bucketed by the order, joined bucket by bucket."""
    pin_utc(spark)
    name = uuid.uuid4().hex
    o = writers.write_bucketed(read_table(spark, root, "orders").select("o_orderkey", "o_orderstatus"), f"orders_{name}", folder(spark, "orders-bucketed"), ["o_orderkey"], 8)
    li = read_table(spark, root, "lineitem").select("l_orderkey", "l_quantity")
    li = writers.write_bucketed(li, f"lines_{name}", folder(spark, "lines-bucketed"), ["l_orderkey"], 8)
    joined = o.join(li.hint("merge"), o.o_orderkey == li.l_orderkey)
    return joined.groupBy("o_orderkey", "o_orderstatus").agg(F.count(F.lit(1)).alias("n"), F.sum("l_quantity").alias("quantity"))


QUERIES = {
    "orders_of_a_year": q_orders_of_a_year,
    "bucketed_totals": q_bucketed_totals,
    "file_movies": q_file_movies,
    "file_persons": q_file_persons,
    "file_directors": q_file_directors,
    "file_directs": q_file_directs,
    "file_cast": q_file_cast,
    "file_person_documents": q_file_person_documents,
    "file_movie_documents": q_file_movie_documents,
    "file_load_most_actors": q_file_load_most_actors,
    "file_edges": q_file_edges,
    "file_ranks": q_file_ranks,
    "file_meter": q_file_meter,
    "file_orders_csv": q_file_orders_csv,
}

_CAST = """
SELECT l_partkey AS pid, l_orderkey AS mid, concat('[', l_returnflag, ']') AS role, l_suppkey AS did,
       row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_returnflag) - 1 AS ord
FROM lineitem"""
_TITLED = f"SELECT o_orderkey AS id, concat('{TITLE}', o_orderkey) AS name, CAST(year(o_orderdate) AS INTEGER) AS year, o_totalprice AS rank FROM orders"

ORACLE = {
    "orders_of_a_year": "SELECT o_orderkey, o_totalprice, CAST(1996 AS INTEGER) AS year FROM orders WHERE year(o_orderdate) = 1996 AND o_totalprice < 50000",
    "bucketed_totals": """
SELECT o_orderkey, o_orderstatus, count(*) AS n, sum(l_quantity) AS quantity
FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY ALL""",
    "file_movies": _TITLED,
    "file_persons": "SELECT p_partkey AS id, p_name AS fname, p_brand AS lname, p_type AS gender FROM part",
    "file_directors": "SELECT s_suppkey AS id, s_name AS fname, n_name AS lname FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey",
    "file_directs": f"SELECT did, mid, ord FROM ({_CAST})",
    "file_cast": f"SELECT pid, mid, role, ord FROM ({_CAST})",
    "file_person_documents": f"""
SELECT p_name AS first_name, p_brand AS last_name, p_type AS gender, p_partkey AS person_id, 0 AS chunk, movie_ids, movie_roles
FROM part LEFT JOIN (
  SELECT pid, string_agg(CAST(mid AS VARCHAR), ',' ORDER BY ord) AS movie_ids, string_agg(trim(role, '[]'), ',' ORDER BY ord) AS movie_roles
  FROM ({_CAST}) GROUP BY pid) ON pid = p_partkey""",
    "file_movie_documents": f"""
SELECT name, year, rank, id AS movie_id, 0 AS chunk, director_ids, actor_ids, actor_roles
FROM ({_TITLED}) LEFT JOIN (
  SELECT mid, string_agg(CAST(did AS VARCHAR), ',' ORDER BY ord) AS director_ids,
         string_agg(CAST(pid AS VARCHAR), ',' ORDER BY ord) AS actor_ids, string_agg(trim(role, '[]'), ',' ORDER BY ord) AS actor_roles
  FROM ({_CAST}) GROUP BY mid) ON mid = id""",
    "file_load_most_actors": f"""
SELECT id, any_value(name) AS name, any_value(year) AS year, count(DISTINCT pid) AS num_actors
FROM ({_TITLED}) JOIN ({_CAST}) ON mid = id
WHERE pid IN (SELECT p_partkey FROM part)
GROUP BY id ORDER BY num_actors DESC, id LIMIT 10""",
    "file_edges": "SELECT l_partkey AS src, l_suppkey AS dst FROM lineitem",
    "file_ranks": "SELECT c_custkey AS vertex, c_acctbal AS rank FROM customer",
    "file_meter": "SELECT date_trunc('second', ts) AS ts, value AS kwh FROM events",
    "file_orders_csv": "SELECT o_orderkey, o_orderstatus, o_totalprice, CAST(o_orderdate AS DATE) AS o_orderdate FROM orders",
}
