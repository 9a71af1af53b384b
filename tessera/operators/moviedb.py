"""The constrained movie star schema (K1 + C1-C3) from any source.

``enforce_constraints`` applies the five tables' primary and foreign keys to raw
frames (from text files via :func:`read_movie_files`, or any other source);
the queries of :mod:`tessera.operators.relational` and the documents of
:mod:`tessera.operators.documents` run on its result.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession

from tessera.operators import quality
from tessera.sinks import writers
from tessera.sources import text


class MovieTables(NamedTuple):
    """Loaded tables; ``acts_in`` keeps its input ordinal ``ord`` (list order)."""

    movies: DataFrame
    persons: DataFrame
    directors: DataFrame
    acts_in: DataFrame
    directs: DataFrame


class Rejects(NamedTuple):
    """Rows a constrained load skipped, per constraint."""

    parse: dict[str, DataFrame]
    acts_in_fk: DataFrame
    directs_fk: DataFrame
    acts_in_pk: DataFrame
    directs_pk: DataFrame


def enforce_constraints(
    movies: DataFrame,
    persons: DataFrame,
    directors: DataFrame,
    acts_in: DataFrame,
    directs: DataFrame,
    strict_cast: bool = False,
) -> tuple[MovieTables, Rejects]:
    """Primary keys on every table (the first row by the input ordinal ``ord``
    where a table carries one, else the smallest row), foreign keys from the two
    link tables to their parents. ``ord`` is dropped afterwards except from the
    cast links, whose list order it gives.

    The link tables' FK columns are part of their primary keys, so a duplicate
    pair passes or fails its FK checks together; checking FKs before the PK
    de-duplication gives the same rows and shuffles each link table once.
    ``strict_cast`` fails the load when any cast row breaks a constraint (the
    reference's cast insert aborts), otherwise rejects are returned (C3).
    """

    def order_of(df: DataFrame) -> list[str]:
        return ["ord"] if "ord" in df.columns else []

    def pk(df: DataFrame, keys: list[str]) -> quality.Checked:
        return quality.enforce_primary_key(df, keys, order_by=order_of(df))

    m = pk(movies, ["id"]).kept.drop("ord")
    p = pk(persons, ["id"]).kept.drop("ord")
    d = pk(directors, ["id"]).kept.drop("ord")

    a_fk1 = quality.enforce_foreign_key(acts_in, m, ["mid"], ["id"])
    a_fk2 = quality.enforce_foreign_key(a_fk1.kept, p, ["pid"], ["id"])
    a_pk = pk(a_fk2.kept, ["pid", "mid"])
    r_fk1 = quality.enforce_foreign_key(directs, m, ["mid"], ["id"])
    r_fk2 = quality.enforce_foreign_key(r_fk1.kept, d, ["did"], ["id"])
    r_pk = pk(r_fk2.kept, ["did", "mid"])

    acts_fk_rejects = a_fk1.rejects.unionByName(a_fk2.rejects)
    acts = a_pk.kept
    if strict_cast:
        acts = quality.strict(quality.Checked(acts, acts_fk_rejects.unionByName(a_pk.rejects)), "cast")
    tables = MovieTables(m, p, d, acts, r_pk.kept.drop("ord"))
    rejects = Rejects(
        parse={},
        acts_in_fk=acts_fk_rejects,
        directs_fk=r_fk1.rejects.unionByName(r_fk2.rejects),
        acts_in_pk=a_pk.rejects,
        directs_pk=r_pk.rejects,
    )
    return tables, rejects


def read_link_rows(
    spark: SparkSession, movies: str, persons: str, directors: str, directs: str, cast: str, mode: str = "permissive"
) -> MovieTables:
    """S1-S5 without constraints, for the documents (which keep repeated links): both link
    tables carry a dense line number ``ord``, so the lists of a hot key are not sorted in one task."""

    def kept(path: str, spec: text.LineSpec, dense: bool = False) -> DataFrame:
        rows = text.read_regex_lines(spark, path, spec, mode, dense=dense).kept
        return rows if dense else rows.drop("ord")

    return MovieTables(
        kept(movies, text.MOVIE), kept(persons, text.PERSON), kept(directors, text.DIRECTOR),
        kept(cast, text.CAST, True), kept(directs, text.MOVIE_DIRECTOR, True),
    )


def store_tables(tables: MovieTables, root: str) -> str:
    """K1: write a constrained load once, for every query that reads it (:func:`stored_tables`)."""
    writers.write_tables(tables._asdict(), root)
    return root


def stored_tables(spark: SparkSession, root: str) -> MovieTables:
    """The tables of a load stored by :func:`store_tables`."""
    return MovieTables(*[spark.read.parquet(f"{root.rstrip('/')}/{name}") for name in MovieTables._fields])


def read_movie_files(
    spark: SparkSession,
    movies: str,
    persons: str,
    directors: str,
    directs: str,
    cast: str,
    mode: str = "permissive",
    strict_cast: bool = False,
) -> tuple[MovieTables, Rejects]:
    """S1-S5 + K1: parse the five latin-1 files (header line skipped) and load
    them under the schema's constraints. Role text keeps its brackets here; the
    documents strip them (F6)."""
    specs = {
        "movies": (movies, text.MOVIE),
        "persons": (persons, text.PERSON),
        "directors": (directors, text.DIRECTOR),
        "directs": (directs, text.MOVIE_DIRECTOR),
        "cast": (cast, text.CAST),
    }
    parsed = {k: text.read_regex_lines(spark, path, spec, mode) for k, (path, spec) in specs.items()}

    tables, rejects = enforce_constraints(
        parsed["movies"].kept,
        parsed["persons"].kept,
        parsed["directors"].kept,
        parsed["cast"].kept,
        parsed["directs"].kept,
        strict_cast,
    )
    return tables, rejects._replace(parse={k: v.rejects for k, v in parsed.items()})
