"""Relational analytics over the movie star schema (Q1-Q7 and their parts).

Tables follow the reference's schema:
``movies(id, name, year, rank)``, ``persons(id, fname, lname, gender)``,
``directors(id, fname, lname)``, ``acts_in(pid, mid, role)``,
``directs(did, mid)``.

Ties: wherever the reference orders only by a measure, the entity id is added
as the last sort key so that results are deterministic.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.calendar import is_leap_year


def _limit(df: DataFrame, limit: int | None) -> DataFrame:
    return df.limit(limit) if limit is not None else df


def top_k_per_group(
    df: DataFrame,
    group: str | Sequence[str],
    order: Sequence[Column],
    k: int,
    rank_col: str | None = None,
) -> DataFrame:
    """Keep the first ``k`` rows of every group under ``order``.

    ``row_number() <= k`` is planned with a partial ``WindowGroupLimit`` before
    the shuffle, so each map task ships at most ``k`` rows per group: a group
    holding a third of the data does not travel whole to one task.
    """
    groups = [group] if isinstance(group, str) else list(group)
    w = Window.partitionBy(*groups).orderBy(*order)
    rn = rank_col or "_rn"
    out = df.withColumn(rn, F.row_number().over(w)).filter(F.col(rn) <= k)
    return out if rank_col else out.drop(rn)


def top_movies_per_year(
    movies: DataFrame, start_year: int, end_year: int, k: int
) -> DataFrame:
    """Q7: best ``k`` ranked movies of every year in ``[start_year, end_year]``,
    ordered by year ascending and rank descending. Unranked movies are ignored."""
    candidates = movies.filter(
        F.col("year").between(start_year, end_year) & F.col("rank").isNotNull()
    ).select("id", "name", "year", "rank")
    best = top_k_per_group(candidates, "year", [F.desc("rank"), F.asc("id")], k)
    return best.orderBy(F.asc("year"), F.desc("rank"), F.asc("id"))


def active_in_both_periods(
    persons: DataFrame,
    acts_in: DataFrame,
    movies: DataFrame,
    first: tuple[int, int],
    second: tuple[int, int],
    limit: int | None = None,
) -> DataFrame:
    """Q1: persons with a movie in ``first`` and one in ``second`` (closed ranges,
    so a year on the shared border counts for both).

    The correlated ``EXISTS`` becomes one grouped aggregate of two flags per
    person, so the cast is joined to the movies once, not twice.
    """
    lo, hi = min(first[0], second[0]), max(first[1], second[1])
    years = movies.filter(F.col("year").between(lo, hi)).select(
        F.col("id").alias("mid"), "year"
    )
    flags = (
        acts_in.select("pid", "mid")
        .join(years, "mid")
        .groupBy("pid")
        .agg(
            F.max(F.col("year").between(*first)).alias("_a"),
            F.max(F.col("year").between(*second)).alias("_b"),
        )
        .filter(F.col("_a") & F.col("_b"))
        .select(F.col("pid").alias("id"))
    )
    out = persons.select("id", "fname", "lname", "gender").join(flags, "id", "left_semi")
    return _limit(out.orderBy("id"), limit)


def leap_year_directors(
    directors: DataFrame,
    directs: DataFrame,
    movies: DataFrame,
    limit: int | None = None,
) -> DataFrame:
    """Q2: directors with at least one movie in a leap year (``SELECT DISTINCT``
    over the join becomes a semi join, so no distinct over joined rows)."""
    leap = movies.filter(is_leap_year("year")).select(F.col("id").alias("mid"))
    did = directs.select("did", "mid").join(leap, "mid", "left_semi").select(
        F.col("did").alias("id")
    )
    out = directors.select("id", "fname", "lname").join(did, "id", "left_semi")
    return _limit(out.orderBy("id"), limit)


def better_than_named(movies: DataFrame, name: str, limit: int | None = 10) -> DataFrame:
    """Q3: movies of the same year as the movie called ``name`` with a better rank.

    Both references are scalar subqueries: no row gives NULL (no result), and
    several rows raise ``SCALAR_SUBQUERY_TOO_MANY_ROWS``, as in SQL.
    """
    named = movies.filter(F.col("name") == F.lit(name))
    year = named.select("year").scalar()
    rank = named.select("rank").scalar()
    out = movies.filter((F.col("year") == year) & (F.col("rank") > rank)).select(
        "id", "name", "year", "rank"
    )
    return _limit(out.orderBy(F.desc("rank"), F.asc("id")), limit)


def _top_k_labelled(
    measures: DataFrame,
    labels: DataFrame,
    key: str,
    order: Sequence[Column],
    k: int | None,
    assume_fk: bool,
    columns: Sequence[str],
) -> DataFrame:
    """Attach ``labels`` to ``measures`` on ``key`` and keep the first ``k`` rows.

    With ``assume_fk`` (every key of ``measures`` has a label row, as after a
    foreign-key-checked load) the inner join cannot drop rows, so the top ``k``
    is taken from the measures with a key first (a partial top-k per task, no join) and
    only those ``k`` rows meet the labels, through a broadcast bounded by ``k``.
    Otherwise all measures are joined, then ranked.
    """
    if k is not None and assume_fk:
        top = measures.filter(F.col(key).isNotNull()).orderBy(*order).limit(k)
        out = labels.join(F.broadcast(top), key)
    else:
        out = labels.join(measures, key)
    return _limit(out.select(*columns).orderBy(*order), k)


def top_directors_by_count(
    directors: DataFrame, directs: DataFrame, k: int = 10, assume_fk: bool = False
) -> DataFrame:
    """Q4: the ``k`` directors with the most movies. Counts are aggregated
    (map-side partials) before the names are attached."""
    counts = directs.groupBy(F.col("did").alias("id")).agg(F.count(F.lit(1)).alias("num"))
    return _top_k_labelled(
        counts,
        directors.select("id", "fname", "lname"),
        "id",
        [F.desc("num"), F.asc("id")],
        k,
        assume_fk,
        ["id", "fname", "lname", "num"],
    )


def movies_by_cast_size(
    movies: DataFrame, acts_in: DataFrame, k: int = 10, most: bool = True, assume_fk: bool = False
) -> DataFrame:
    """Q5: the ``k`` movies with the most (or fewest) distinct actors.

    ``count(DISTINCT pid)`` is planned as a de-duplication on ``(mid, pid)``
    followed by a partial count per ``mid``, so a movie with a huge cast is
    pre-counted on the map side.
    """
    sizes = acts_in.groupBy(F.col("mid").alias("id")).agg(
        F.count_distinct("pid").alias("num_actors")
    )
    measure = F.desc("num_actors") if most else F.asc("num_actors")
    return _top_k_labelled(
        sizes,
        movies.select("id", "name", "year"),
        "id",
        [measure, F.asc("id")],
        k,
        assume_fk,
        ["id", "name", "year", "num_actors"],
    )


#: Directors of one movie and range of ids from which a bitmap (4 KB) is smaller than their ids.
BITMAP_FROM = 512


def directors_per_actor(acts_in: DataFrame, directs: DataFrame, bitmap_from: int = BITMAP_FROM) -> DataFrame:
    """A2: ``pid, num_directors``, the distinct directors an actor worked with, without expanding
    a heavy movie into actors x directors rows.

    The directors of a movie are taken in ranges of 32,768 ids. A range with ``bitmap_from``
    directors or more is one bitmap, joined to the movie's actors as one row, and an actor's
    bitmaps are merged by OR before the shuffle. All other pairs are counted as rows; those
    of an actor with bitmaps are turned into bitmaps first, so nobody counts twice. Ids must not
    be negative.
    """
    links = directs.filter("mid is not null and did is not null").select("mid", "did").distinct()
    links = links.withColumn("bucket", F.bitmap_bucket_number("did"))
    sizes = links.groupBy("mid", "bucket").agg(F.count(F.lit(1)).alias("n"))
    heavy = sizes.filter(F.col("n") >= bitmap_from).select("mid", "bucket")
    acts = acts_in.select("pid", "mid").filter("pid is not null and mid is not null")
    maps = links.join(heavy, ["mid", "bucket"], "left_semi").groupBy("mid", "bucket").agg(F.bitmap_construct_agg(F.bitmap_bit_position("did")).alias("bits"))
    merged = acts.join(maps, "mid").groupBy("pid", "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))
    light = acts.join(links.join(heavy, ["mid", "bucket"], "left_anti").select("mid", "did"), "mid").select("pid", "did")
    mapped = merged.select("pid").distinct()
    both = light.join(mapped, "pid", "left_semi")
    both = both.groupBy("pid", F.bitmap_bucket_number("did").alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("did")).alias("bits"))
    dense = merged.unionByName(both).groupBy("pid", "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))
    dense = dense.groupBy("pid").agg(F.sum(F.bitmap_count("bits")).alias("num_directors"))
    plain = light.join(mapped, "pid", "left_anti").groupBy("pid").agg(F.count_distinct("did").alias("num_directors"))
    return plain.unionByName(dense)


def actors_with_many_directors(
    persons: DataFrame,
    acts_in: DataFrame,
    directs: DataFrame,
    threshold: int = 10,
    k: int | None = 10,
    assume_fk: bool = False,
) -> DataFrame:
    """Q6: actors who worked with at least ``threshold`` distinct directors.

    The cast and director links meet on the movie id (AQE splits a movie that
    dominates either side); the distinct count runs on ``(pid, did)`` first.
    """
    pairs = acts_in.select("pid", "mid").join(directs.select("did", "mid"), "mid")
    counts = (
        pairs.groupBy(F.col("pid").alias("id"))
        .agg(F.count_distinct("did").alias("num_directors"))
        .filter(F.col("num_directors") >= threshold)
    )
    return _top_k_labelled(
        counts,
        persons.select("id", "fname", "lname"),
        "id",
        [F.desc("num_directors"), F.asc("id")],
        k,
        assume_fk,
        ["id", "fname", "lname", "num_directors"],
    )
