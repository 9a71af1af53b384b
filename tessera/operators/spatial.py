"""Nearest stations of many points (S12, J12) by nested grids on the unit sphere.

Points and stations are put on the unit sphere, whose enclosing cube is cut into cells of side
``2**-level``; a cell of one level holds eight of the next. Cells of points descend
together with the cells of stations that may hold one of their k nearest: the station cells whose far corners
are nearest and that hold k stations bound the distance (along the chord, which grows with the distance on
the surface, so no pole or date line needs a rule of its own), and a station cell whose near corner is beyond
that bound goes. A cell of points stops where few stations are left; only these are
measured. Points far from every station, as at a pole without any, so meet the near side of the stations only. Points and
stations only ever meet by an equi-join on cells.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions import weather as wx
from tessera.session import stored

#: Level of the finest cells (about 24 m), and of those the search starts from.
FINEST, FIRST = 18, 2
#: A cell of points stops at this many stations for each of the k, or at this many pairs.
STATIONS, PAIRS = 16, 512
#: Stations of one list that points are measured against.
LISTED = 1_000


def on_sphere(df: DataFrame, lat: str, lon: str) -> DataFrame:
    """Adds ``_x, _y, _z`` on the unit sphere."""
    p, q = F.radians(F.col(lat)), F.radians(F.col(lon))
    return df.withColumns({"_x": F.cos(p) * F.cos(q), "_y": F.cos(p) * F.sin(q), "_z": F.sin(p)})


def _numbered(df: DataFrame) -> DataFrame:
    """``_x, _y, _z`` as numbers of the finest cells, from 0 (20 bits each)."""
    return df.withColumns({c: F.floor(F.col(c) * (1 << FINEST)).cast("bigint") + (1 << FINEST) for c in ("_x", "_y", "_z")})


def _cell(level: int):
    """Number of a row's cell of ``level``."""
    x, y, z = (F.shiftright(c, FINEST - level) for c in ("_x", "_y", "_z"))
    return F.shiftleft(x, 40) + F.shiftleft(y, 20) + z


def _cells(df: DataFrame, level: int, name: str, many: str) -> DataFrame:
    """The cells of ``level`` that hold rows of ``df``, the cell around each, and their rows."""
    return df.groupBy(_cell(level - 1).alias(f"_around{name}"), _cell(level).alias(name)).agg(F.count(F.lit(1)).alias(many))


def _apart(level: int):
    """Squares of the least and of the greatest distance of two cells, in sides of their own."""
    axes = [F.abs(F.shiftright("_q", at).bitwiseAND((1 << 20) - 1) - F.shiftright("_c", at).bitwiseAND((1 << 20) - 1)) for at in (0, 20, 40)]
    least = [F.greatest(F.lit(0), d - 1) for d in axes]
    return sum((d * d for d in least), F.lit(0)), sum(((d + 1) * (d + 1) for d in axes), F.lit(0))


def _candidates(places: DataFrame, stations: DataFrame, k: int) -> dict[int, DataFrame]:
    """By level, the cells of points that stop there (``_q``), each with the station cells
    (``_c``, ``_total`` stations in all) that hold its points' k nearest."""
    whole = Window.partitionBy("_q")
    nearer = whole.orderBy("_most").rangeBetween(Window.unboundedPreceding, 0)
    held, out = None, {}
    for level in range(FIRST, FINEST + 1):
        asked, near = _cells(places, level, "_q", "_points"), _cells(stations, level, "_c", "_n")
        if held is None:
            pairs = asked.crossJoin(near).withColumn("_bound", F.lit(None).cast("bigint"))
        else:
            pairs = held.join(asked, "_around_q").join(near, "_around_c")
        least, most = _apart(level)
        pairs = pairs.select("_q", "_points", "_c", "_n", "_bound", least.alias("_least"), most.alias("_most"))
        pairs = pairs.filter("_bound is null or _least <= 4 * _bound")  # what the cell around allows
        pairs = pairs.withColumn("_bound", F.min(F.when(F.sum("_n").over(nearer) >= k, F.col("_most"))).over(whole))
        pairs = pairs.filter("_least <= _bound").withColumn("_total", F.sum("_n").over(whole))
        stops = F.lit(level == FINEST) | (F.col("_total") <= STATIONS * k) | (F.col("_points") * F.col("_total") <= PAIRS)
        pairs = stored(pairs.select("_q", "_c", "_bound", "_total", stops.alias("_stops")), "cells")
        found = {r["_stops"] for r in pairs.select("_stops").distinct().collect()}
        if True in found:
            out[level] = pairs.filter("_stops").select("_q", "_c", "_total")
        if False not in found:
            break
        held = pairs.filter("not _stops").select(F.col("_q").alias("_around_q"), F.col("_c").alias("_around_c"), "_bound")
    return out


def _best(pairs: DataFrame, k: int) -> DataFrame:
    """The k nearest of each list ``_list`` of stations, measured from ``_lat, _lon``."""
    far = F.transform("_list", lambda s: F.struct(wx.haversine_m(F.col("_lat"), F.col("_lon"), s["_slat"], s["_slon"]).alias("distance"), s["_station"].alias("_station")))
    pairs = pairs.withColumn("_near", F.explode(F.slice(F.array_sort(far), 1, k)))
    return pairs.select("_q", "_lat", "_lon", "_near.distance", "_near._station")


def k_nearest(
    points: DataFrame, catalogue: DataFrame, k: int = 1, lat: str = "latitude", lon: str = "longitude", station: str = "station"
) -> DataFrame:
    """``points`` with ``nearest_rank`` (from 1), ``station`` and ``distance`` (metres) of their k nearest stations, ties
    to the smaller station id; fewer rows where there are fewer stations. Rows without a coordinate
    (points or stations) take no part. Points at one place are searched once, and of the stations at one place
    the k first count. Coordinates that are no numbers are farther than any."""
    places = points.filter(F.col(lat).isNotNull() & F.col(lon).isNotNull()).select(F.col(lat).alias("_lat"), F.col(lon).alias("_lon")).distinct()
    places = stored(on_sphere(places, "_lat", "_lon"), "places")
    stations = catalogue.filter(F.col(lat).isNotNull() & F.col(lon).isNotNull())
    stations = stations.select(F.col(station).alias("_station"), F.col(lat).alias("_slat"), F.col(lon).alias("_slon"))
    first = F.row_number().over(Window.partitionBy("_slat", "_slon").orderBy("_station"))
    stations = stored(on_sphere(stations.withColumn("_first", first).filter(F.col("_first") <= k).drop("_first"), "_slat", "_slon"), "stations")
    lost = F.isnan(F.col("_x") + F.col("_y") + F.col("_z"))
    sited = _numbered(stations.filter(~lost))
    entry = F.struct("_station", "_slat", "_slon")
    kinds = {c: stations.schema[c].dataType for c in ("_station", "_slat", "_slon")}

    def few(rows: DataFrame):  # the k first of these stations as one list
        held = [F.struct(*[F.lit(r[c]).cast(t).alias(c) for c, t in kinds.items()]) for r in rows.orderBy("_station").limit(k).collect()]
        return F.array(*held).cast(f"array<struct<{','.join(f'{c}:{t.simpleString()}' for c, t in kinds.items())}>>")

    def beside(rows: DataFrame, held) -> DataFrame:
        return _best(rows.select(F.lit(0).cast("bigint").alias("_q"), "_lat", "_lon", held.alias("_list")), k)

    near = [beside(places.filter(lost), few(stations))]
    if sited.limit(k).count() < k:  # every place takes all of them
        near.append(beside(places.filter(~lost), F.concat(few(sited), few(stations.filter(lost)))))
    else:
        asked = _numbered(places.filter(~lost))
        for level, held in _candidates(asked, sited, k).items():
            lists = held.join(sited.withColumn("_c", _cell(level)), "_c")
            part = F.pmod(F.xxhash64("_station", "_slat", "_slon"), F.ceil(F.col("_total") / LISTED))
            lists = lists.groupBy("_q", part.alias("_part")).agg(F.collect_list(entry).alias("_list"))
            near.append(_best(asked.withColumn("_q", _cell(level)).join(lists, "_q"), k))
    best = Window.partitionBy("_q", "_lat", "_lon").orderBy("distance", "_station")
    ranked = [n.withColumn("nearest_rank", F.row_number().over(best)).filter(F.col("nearest_rank") <= k).drop("_q") for n in near]
    found = reduce(DataFrame.unionByName, ranked)
    same = (points[lat] == found["_lat"]) & (points[lon] == found["_lon"])
    return points.join(found, same).drop("_lat", "_lon").withColumnRenamed("_station", station)
