"""Nested movie / director / person documents.

Document shapes (one collection, told apart by ``doc_type``):

* movie:    name, year, rank, movie_id, director_ids, actor_ids, actor_roles
* director: first_name, last_name, director_id, movie_ids
* person:   first_name, last_name, gender, person_id, movie_ids, movie_roles

``actor_ids[i]`` pairs with ``actor_roles[i]`` (and ``movie_ids[i]`` with
``movie_roles[i]``): both arrays are cut from one sorted array of structs.
Lists are in the order of the link's input ordinal and paged by one rule for every
key; ``chunk`` numbers a document's pages from 0 (see :func:`group_to_lists`), and
the lookups read all pages.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

ARRAY_FIELDS = ("director_ids", "actor_ids", "actor_roles", "movie_ids", "movie_roles")


#: Entries of one page of a list.
PAGE = 1_000_000


def group_to_lists(
    df: DataFrame,
    key: str,
    values: Sequence[str],
    order: Sequence[str] = (),
    names: Sequence[str] | None = None,
    page: int = PAGE,
) -> DataFrame:
    """One row per ``(key, chunk)`` with aligned lists of ``values`` in ``order``.

    ``order`` is the input ordinal (the reference keeps file order); the value
    columns break ties. Every key is paged by the same rule: entry number ``i`` of
    a key's order is in page (``chunk``) ``i // page``, so the pages of a key, one
    after the other, are its whole list in order.

    Entry numbers come from counts per (key, range of the first ordinal), summed
    over the earlier ranges, plus the number within the range; no task sorts a hot
    key whole if the first column of the order (without ``order``, the first value) is
    numeric and tells its rows apart. Lines of files get such an ordinal from
    :func:`tessera.sources.text.number_lines`.
    """
    names = list(names or values)
    order = list(order)
    lead = (order or list(values))[0]
    ranged = isinstance(df.schema[lead].dataType, NumericType)
    part = F.coalesce(F.floor(F.col(lead) / F.lit(page)), F.lit(-1)) if ranged else F.lit(0).cast("long")
    df = df.withColumn("_part", part)
    earlier = Window.partitionBy(key).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    counts = df.groupBy(key, "_part").agg(F.count(F.lit(1)).alias("_n"))
    base = counts.select(
        F.col(key).alias("_bk"), F.col("_part").alias("_bp"), F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_base")
    )
    within = Window.partitionBy(key, "_part").orderBy(*order, *values)
    numbered = df.withColumn("_i", F.row_number().over(within))
    same = numbered[key].eqNullSafe(base["_bk"]) & (numbered["_part"] == base["_bp"])
    numbered = numbered.join(base, same).withColumn("_i", F.col("_base") + F.col("_i") - 1)
    packed = F.struct("_i", *[F.col(v).alias(f"_v{i}") for i, v in enumerate(values)])
    chunk = F.floor(F.col("_i") / F.lit(page)).cast("int").alias("chunk")
    lists = numbered.groupBy(key, chunk).agg(F.array_sort(F.collect_list(packed)).alias("_l"))
    return lists.select(
        key, "chunk", *[F.transform("_l", _field(f"_v{i}")).alias(n) for i, n in enumerate(names)]
    )


def _field(name: str):
    return lambda s: s[name]


def strip_brackets(col: Column | str) -> Column:
    """Python's ``str.strip("[]")``."""
    c = F.col(col) if isinstance(col, str) else col
    return F.btrim(c, F.lit("[]"))


def movie_documents(
    movies: DataFrame,
    acts_in: DataFrame,
    directs: DataFrame,
    acts_order: Sequence[str] = (),
    directs_order: Sequence[str] = (),
) -> DataFrame:
    """Every movie with its director ids and aligned actor ids / roles.

    Movies without links keep NULL lists (left joins from the movie side).
    """
    roles = acts_in.withColumn("role", strip_brackets("role"))
    cast = group_to_lists(roles, "mid", ["pid", "role"], acts_order, ["actor_ids", "actor_roles"])
    heads = group_to_lists(directs, "mid", ["did"], directs_order, ["director_ids"])
    lists = heads.join(cast, ["mid", "chunk"], "full").withColumnRenamed("mid", "movie_id")
    return (
        movies.select(
            F.col("id").alias("movie_id"), "name", F.col("year").cast("int").alias("year"), "rank"
        )
        .join(lists, "movie_id", "left")
        .select(
            F.lit("movie").alias("doc_type"),
            "name",
            "year",
            "rank",
            "movie_id",
            F.coalesce("chunk", F.lit(0)).alias("chunk"),
            "director_ids",
            "actor_ids",
            "actor_roles",
        )
    )


def director_documents(
    directors: DataFrame, directs: DataFrame, directs_order: Sequence[str] = ()
) -> DataFrame:
    """The aggregate is the left side, so directors without movies are
    absent and ids without a director row keep NULL names."""
    films = group_to_lists(directs, "did", ["mid"], directs_order, ["movie_ids"])
    return (
        films.withColumnRenamed("did", "director_id")
        .join(
            directors.select(
                F.col("id").alias("director_id"),
                F.col("fname").alias("first_name"),
                F.col("lname").alias("last_name"),
            ),
            "director_id",
            "left",
        )
        .select(
            F.lit("director").alias("doc_type"),
            "first_name",
            "last_name",
            "director_id",
            "chunk",
            "movie_ids",
        )
    )


def person_documents(
    persons: DataFrame, acts_in: DataFrame, acts_order: Sequence[str] = ()
) -> DataFrame:
    """Every person with aligned movie ids / roles (NULL lists when none)."""
    roles = acts_in.withColumn("role", strip_brackets("role"))
    films = group_to_lists(roles, "pid", ["mid", "role"], acts_order, ["movie_ids", "movie_roles"])
    return (
        persons.select(
            F.col("id").alias("person_id"),
            F.col("fname").alias("first_name"),
            F.col("lname").alias("last_name"),
            "gender",
        )
        .join(films.withColumnRenamed("pid", "person_id"), "person_id", "left")
        .select(
            F.lit("person").alias("doc_type"),
            "first_name",
            "last_name",
            "gender",
            "person_id",
            F.coalesce("chunk", F.lit(0)).alias("chunk"),
            "movie_ids",
            "movie_roles",
        )
    )


def build_documents(
    movies: DataFrame,
    persons: DataFrame,
    directors: DataFrame,
    acts_in: DataFrame,
    directs: DataFrame,
    acts_order: Sequence[str] = (),
    directs_order: Sequence[str] = (),
) -> DataFrame:
    """U4: the three document kinds as one collection (missing fields NULL)."""
    return (
        movie_documents(movies, acts_in, directs, acts_order, directs_order)
        .unionByName(director_documents(directors, directs, directs_order), allowMissingColumns=True)
        .unionByName(person_documents(persons, acts_in, acts_order), allowMissingColumns=True)
    )


def find_one(docs: DataFrame, **fields) -> DataFrame:
    """The first document (lowest movie/person/director id) matching all fields,
    with all its pages."""
    cond = F.lit(True)
    for k, v in fields.items():
        cond = cond & (F.col(k) == F.lit(v))
    ids = [c for c in ("movie_id", "director_id", "person_id") if c in docs.columns]
    found = docs.filter(cond)
    first = found.select(*[F.col(c).alias(f"_{c}") for c in ids]).orderBy(*[F.asc_nulls_last(f"_{c}") for c in ids]).limit(1)
    same = F.lit(True)
    for c in ids:
        same = same & found[c].eqNullSafe(first[f"_{c}"])
    return found.join(F.broadcast(first), same, "left_semi")  # one row


def find_related(
    docs: DataFrame, anchor: DataFrame, array_field: str, id_field: str
) -> DataFrame:
    """Documents whose ``id_field`` is in the anchor's ``array_field``
    (an ``$in`` lookup): explode the anchor's array and semi-join on it."""
    wanted = anchor.select(F.explode(array_field).alias("_id"))
    return docs.join(wanted, docs[id_field] == wanted["_id"], "left_semi")
