"""Registered document queries.

As in the reference, the collection is built from the raw link rows, not from
the constrained tables: a repeated link stays in the lists, and a link to an id
without a parent row keeps NULL parent fields (J7). List order is the links'
input ordinal (``l_linenumber`` in the stand-ins), ties broken by the values.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.operators import documents as D
from tessera.operators.moviedb import MovieTables
from tessera.plans import movies as PM
from tessera.session import pin_utc

ORDER = ["ord"]


def raw_tables(spark, root) -> MovieTables:
    pin_utc(spark)
    return MovieTables(
        PM.raw_movies(spark, root),
        PM.raw_persons(spark, root),
        PM.raw_directors(spark, root),
        PM.raw_acts_in(spark, root),
        PM.raw_directs_ordered(spark, root),
    )


def flat(col: str) -> Column:
    """An array as comma-joined text (NULL elements as empty text) for hashing."""
    return F.array_join(F.transform(col, lambda x: x.cast("string")), ",", "").alias(col)


def q_movie_documents(spark, root) -> DataFrame:
    t = raw_tables(spark, root)
    docs = D.movie_documents(t.movies, t.acts_in, t.directs, ORDER, ORDER)
    return docs.select(
        "doc_type", "name", "year", "rank", "movie_id", "chunk",
        flat("director_ids"), flat("actor_ids"), flat("actor_roles"),
    )


def q_director_documents(spark, root) -> DataFrame:
    t = raw_tables(spark, root)
    docs = D.director_documents(t.directors, t.directs, ORDER)
    return docs.select("doc_type", "first_name", "last_name", "director_id", "chunk", flat("movie_ids"))


def q_person_documents(spark, root) -> DataFrame:
    t = raw_tables(spark, root)
    docs = D.person_documents(t.persons, t.acts_in, ORDER)
    return docs.select(
        "doc_type", "first_name", "last_name", "gender", "person_id", "chunk",
        flat("movie_ids"), flat("movie_roles"),
    )


def _anchor(t: MovieTables, name: str) -> DataFrame:
    """The named movie's document (``find_one``).

    As with a document store, the lookup is two steps: the first matching
    movie's id is fetched (one scalar), then only that movie's links are read;
    the id filter is pushed into the parquet scans. The lists stay distributed."""
    first = t.movies.filter(F.col("name") == F.lit(name)).agg(F.min("id")).first()[0]
    movie = t.movies.filter(F.col("id") == F.lit(first)) if first is not None else t.movies.limit(0)
    mid = F.lit(first).cast("long")
    docs = D.movie_documents(
        movie,
        t.acts_in.filter(F.col("mid") == mid),
        t.directs.filter(F.col("mid") == mid),
        ORDER,
        ORDER,
    )
    return D.find_one(docs, doc_type="movie", name=name)


def q_related_directors(spark, root) -> DataFrame:
    """Director documents of the named movie's ``director_ids`` (the ``$in``
    lookup is an explode of the anchor's list and a semi join, J5); only those
    directors' documents are built."""
    t = raw_tables(spark, root)
    wanted = _anchor(t, PM.NAMED_MOVIE).select(F.explode("director_ids").alias("did"))
    links = t.directs.join(wanted, "did", "left_semi")
    heads = t.directors.join(wanted.withColumnRenamed("did", "id"), "id", "left_semi")
    docs = D.director_documents(heads, links, ORDER)
    return docs.filter("chunk = 0").select("director_id", "first_name", "last_name")


def q_related_actors(spark, root) -> DataFrame:
    """Person documents of the named movie's ``actor_ids`` (explode + semi join)."""
    t = raw_tables(spark, root)
    wanted = _anchor(t, PM.NAMED_MOVIE).select(F.explode("actor_ids").alias("id"))
    people = t.persons.join(wanted, "id", "left_semi")
    links = t.acts_in.join(wanted.withColumnRenamed("id", "pid"), "pid", "left_semi")
    docs = D.person_documents(people, links, ORDER)
    return docs.filter("chunk = 0").select("person_id", "first_name", "last_name", "gender")


def q_related_actor_roles(spark, root) -> DataFrame:
    """The named movie's cast with the role aligned to each id, in list order."""
    t = raw_tables(spark, root)
    cast = _anchor(t, PM.NAMED_MOVIE).select(
        "chunk", F.posexplode(F.arrays_zip("actor_ids", "actor_roles")).alias("pos", "entry")
    ).select((F.col("chunk").cast("long") * D.PAGE + F.col("pos")).alias("pos"), F.col("entry.actor_ids").alias("person_id"), F.col("entry.actor_roles").alias("role"))
    people = t.persons.select(F.col("id").alias("person_id"), F.col("fname").alias("first_name"), F.col("lname").alias("last_name"))
    return cast.join(people, "person_id").select("pos", "person_id", "first_name", "last_name", "role")


def q_movie_collection(spark, root) -> DataFrame:
    """U4: movies, directors and persons as one collection."""
    docs = D.build_documents(*raw_tables(spark, root), ORDER, ORDER)
    return docs.select(
        "doc_type", "name", "year", "rank", "movie_id", "director_id", "person_id", "first_name", "last_name", "gender",
        "chunk", *[flat(c) for c in D.ARRAY_FIELDS],
    )


QUERIES = {
    "movie_documents": q_movie_documents,
    "director_documents": q_director_documents,
    "person_documents": q_person_documents,
    "related_directors": q_related_directors,
    "related_actors": q_related_actors,
    "related_actor_roles": q_related_actor_roles,
    "movie_collection": q_movie_collection,
}

_DOCS = (
    "WITH"
    + PM._RAW
    + """,
heads AS (SELECT mid, string_agg(CAST(did AS VARCHAR), ',' ORDER BY ord, did) AS director_ids
          FROM raw_directs_o GROUP BY mid),
cast_lists AS (SELECT mid,
    string_agg(CAST(pid AS VARCHAR), ',' ORDER BY ord, pid, role) AS actor_ids,
    string_agg(coalesce(trim(role, '[]'), ''), ',' ORDER BY ord, pid, role) AS actor_roles
  FROM raw_acts GROUP BY mid),
movie_docs AS (
  SELECT 'movie' AS doc_type, name, year, rank, id AS movie_id, 0 AS chunk,
         director_ids, actor_ids, actor_roles
  FROM raw_movies LEFT JOIN heads ON heads.mid = raw_movies.id
                  LEFT JOIN cast_lists ON cast_lists.mid = raw_movies.id),
anchor AS (SELECT min(id) AS movie_id FROM raw_movies WHERE name = '%s')
""" % PM.NAMED_MOVIE
)

ORACLE = {
    "movie_documents": _DOCS + "SELECT * FROM movie_docs",
    "director_documents": _DOCS
    + """
SELECT 'director' AS doc_type, d.fname AS first_name, d.lname AS last_name,
       f.did AS director_id, 0 AS chunk, f.movie_ids
FROM (SELECT did, string_agg(CAST(mid AS VARCHAR), ',' ORDER BY ord, mid) AS movie_ids
      FROM raw_directs_o GROUP BY did) f
LEFT JOIN raw_directors d ON d.id = f.did""",
    "person_documents": _DOCS
    + """
SELECT 'person' AS doc_type, p.fname AS first_name, p.lname AS last_name, p.gender,
       p.id AS person_id, 0 AS chunk, f.movie_ids, f.movie_roles
FROM raw_persons p LEFT JOIN (
  SELECT pid,
    string_agg(CAST(mid AS VARCHAR), ',' ORDER BY ord, mid, role) AS movie_ids,
    string_agg(coalesce(trim(role, '[]'), ''), ',' ORDER BY ord, mid, role) AS movie_roles
  FROM raw_acts GROUP BY pid) f ON f.pid = p.id""",
    "related_directors": _DOCS
    + """
SELECT f.did AS director_id, d.fname AS first_name, d.lname AS last_name
FROM (SELECT DISTINCT did FROM raw_directs_o
      WHERE did IN (SELECT did FROM raw_directs_o WHERE mid = (SELECT movie_id FROM anchor))) f
LEFT JOIN raw_directors d ON d.id = f.did""",
    "related_actors": _DOCS
    + """
SELECT p.id AS person_id, p.fname AS first_name, p.lname AS last_name, p.gender
FROM raw_persons p
WHERE p.id IN (SELECT pid FROM raw_acts WHERE mid = (SELECT movie_id FROM anchor))""",
}

ORACLE["related_actor_roles"] = _DOCS + """
SELECT row_number() OVER (ORDER BY ord, pid, trim(role, '[]')) - 1 AS pos, pid AS person_id,
       fname AS first_name, lname AS last_name, trim(role, '[]') AS role
FROM raw_acts JOIN raw_persons ON raw_persons.id = pid
WHERE mid = (SELECT movie_id FROM anchor)"""

ORACLE["movie_collection"] = f"""
SELECT doc_type, name, year, rank, movie_id, NULL::BIGINT AS director_id, NULL::BIGINT AS person_id,
       NULL AS first_name, NULL AS last_name, NULL AS gender, chunk, director_ids, actor_ids, actor_roles,
       NULL AS movie_ids, NULL AS movie_roles
FROM ({ORACLE["movie_documents"]})
UNION ALL
SELECT doc_type, NULL, NULL, NULL, NULL, director_id, NULL, first_name, last_name, NULL, chunk, NULL, NULL, NULL, movie_ids, NULL
FROM ({ORACLE["director_documents"]})
UNION ALL
SELECT doc_type, NULL, NULL, NULL, NULL, NULL, person_id, first_name, last_name, gender, chunk, NULL, NULL, NULL, movie_ids, movie_roles
FROM ({ORACLE["person_documents"]})"""
