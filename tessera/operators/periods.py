"""Assignment of points in time to arbitrary periods ``(start, end]`` (J10), overlaps and gaps allowed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DAY = 86_400_000_000


def _micros(col: str) -> Column:
    return F.unix_micros(F.col(col).cast("timestamp"))


def assign_periods(points: DataFrame, periods: DataFrame, at: str, start: str = "start", end: str = "end", base: int = DAY) -> DataFrame:
    """Every pair of a point and a period with ``start < at <= end``, once.

    Time is cut into bins of ``base * 2**level`` microseconds. A period belongs to the first level
    whose bins are as long as it is, where it touches two bins at most; a point belongs to one bin of
    every level that any period uses (some dozens at most; the list reaches the driver). Points and
    periods are joined on (level, bin), then compared, so no pair comes twice and a
    period of a century costs no more rows than one of a day. A period without a length, or with an
    end unknown, has no points. The inputs' column names must differ.
    """
    size = (F.col("_to") - F.col("_from")).cast("double")
    level = F.greatest(F.lit(0), F.ceil(F.log2(size / base))).cast("int")
    cut = periods.withColumns({"_from": _micros(start), "_to": _micros(end)}).filter("_to > _from").withColumn("_level", level)
    levels = sorted(r["_level"] for r in cut.select("_level").distinct().collect())

    def shifted(t: Column, lvl: int) -> Column:
        return F.floor(t / F.lit(base << lvl)).cast("bigint")

    width = F.element_at(F.create_map(*[x for lvl in levels or [0] for x in (F.lit(lvl), F.lit(base << lvl))]), F.col("_level"))
    first, last = (F.floor(F.col(c) / width).cast("bigint") for c in ("_from", "_to"))
    owned = cut.withColumn("_bin", F.explode(F.array_distinct(F.array(first, last))))
    spots = points.withColumn("_at", _micros(at)).filter("_at is not null")
    each = F.array(*[F.struct(F.lit(lvl).alias("l"), shifted(F.col("_at"), lvl).alias("b")) for lvl in levels or [0]])
    spots = spots.withColumn("_spot", F.explode(each))
    same = (F.col("_spot.l") == owned["_level"]) & (F.col("_spot.b") == owned["_bin"]) & (F.col("_at") > F.col("_from")) & (F.col("_at") <= F.col("_to"))
    return spots.join(owned, same).select(*points.columns, *periods.columns)


def period_totals(points: DataFrame, periods: DataFrame, at: str, value: str, key: str, start: str = "start", end: str = "end") -> DataFrame:
    """Per period: ``n`` points and the sum of ``value`` (0 and NULL without points)."""
    sums = assign_periods(points, periods, at, start, end).groupBy(key).agg(F.count(F.lit(1)).alias("n"), F.sum(value).alias(value))
    return periods.join(sums.withColumnRenamed(key, "_key"), F.col(key) == F.col("_key"), "left").drop("_key").withColumn("n", F.coalesce("n", F.lit(0)))
