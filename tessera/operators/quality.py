"""Constraint enforcement and row-level data quality (inventory C1-C10).

Every operator returns DataFrames; nothing is collected except the single
reject count of the strict mode.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class Checked(NamedTuple):
    """Rows that satisfy a constraint and the rows it rejected."""

    kept: DataFrame
    rejects: DataFrame


class ConstraintViolation(ValueError):
    """Raised by strict loads when any row breaks a constraint."""


#: Copies of one rejected row that a single task emits.
COPIES = 10_000


def enforce_primary_key(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str] = (),
) -> Checked:
    """Keep one row per key (C1); a key may not be NULL.

    The kept row is the smallest by ``order_by`` (an input ordinal, so "first
    row wins" as with inserts that skip unique violations), ties broken by the
    remaining columns, so the choice is deterministic. It is a ``min(struct(...))``
    with map-side partials, so a hot key costs one row per map task and the kept rows one
    shuffle. Rejects are all other copies and the rows with a NULL in their key; only
    they need equal rows counted. The copies of one repeated row are emitted in blocks
    of at most :data:`COPIES`, spread over tasks.
    """
    keys = list(keys)
    order_by = [c for c in order_by if c not in keys]
    rest = [c for c in df.columns if c not in keys and c not in order_by]
    counted = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_copies"))
    whole = F.struct(*order_by, *rest) if order_by or rest else F.struct(*keys)
    complete = F.lit(True)
    for k in keys:
        complete = complete & F.col(k).isNotNull()
    first = df.filter(complete).groupBy(*keys).agg(F.min(whole).alias("_first"))
    kept = first.select(*keys, "_first.*") if order_by or rest else first.select(*keys)
    chosen = first.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], "_first")
    cond = [counted[k] == chosen[f"_k{i}"] for i, k in enumerate(keys)]
    left = counted.join(chosen, cond, "left").withColumn(
        "_copies", F.col("_copies") - F.when(F.col("_first").eqNullSafe(whole), 1).otherwise(0)
    )
    blocks = left.filter("_copies > 0").select(
        *df.columns, "_copies",
        F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("_copies") - 1) / COPIES).cast("long"))).alias("_block"),
    )
    many = F.least(F.lit(COPIES).cast("long"), F.col("_copies") - F.col("_block") * COPIES)
    spread = blocks.withColumn("_copies", many).repartition(*df.columns, "_block")
    rejects = spread.select(*df.columns, F.explode(F.sequence(F.lit(1).cast("long"), F.col("_copies"))).alias("_i"))
    return Checked(kept.select(*df.columns), rejects.select(*df.columns))


def enforce_foreign_key(
    child: DataFrame,
    parent: DataFrame,
    child_cols: Sequence[str],
    parent_cols: Sequence[str] | None = None,
) -> Checked:
    """Drop and report child rows whose parent key is absent.

    As in SQL, a child row with a NULL in its foreign key is not checked and is
    kept. One left join of the child with the distinct parent keys marks the
    matches, so the child is read once for both outputs. AQE turns the join into
    a broadcast when the parent keys are small at run time and otherwise splits
    skewed child partitions (a left outer join may split its left side).
    """
    child_cols = list(child_cols)
    parent_cols = list(parent_cols or child_cols)
    keys = (
        parent.select(*[F.col(p).alias(f"_pk{i}") for i, p in enumerate(parent_cols)])
        .distinct()
        .withColumn("_hit", F.lit(True))
    )
    cond = [child[c] == keys[f"_pk{i}"] for i, c in enumerate(child_cols)]
    has_null = F.lit(False)
    for c in child_cols:
        has_null = has_null | F.col(c).isNull()
    marked = child.join(keys, cond, "left")
    kept = marked.filter(has_null | F.col("_hit").isNotNull()).select(*child.columns)
    rejects = marked.filter(~has_null & F.col("_hit").isNull()).select(*child.columns)
    return Checked(kept, rejects)


def strict(checked: Checked, what: str = "constraint") -> DataFrame:
    """Fail the load when anything was rejected (C3); else return the kept rows."""
    bad = checked.rejects.limit(1).count()
    if bad:
        sample = checked.rejects.limit(5).collect()
        raise ConstraintViolation(f"{what} violated, e.g. {sample}")
    return checked.kept


def clean_text(col: Column | str) -> Column:
    """C4: single quote becomes a double quote, empty text becomes NULL."""
    c = F.col(col) if isinstance(col, str) else col
    return F.nullif(F.replace(c, F.lit("'"), F.lit('"')), F.lit(""))


def complete_groups(
    df: DataFrame, keys: Sequence[str], sizes: Sequence[int] = (365, 366)
) -> DataFrame:
    """Keep only groups whose row count is one of ``sizes``.

    Implemented as a grouped count (partial aggregation, skew-safe) joined back
    on the keys, not as a window over the whole group.
    """
    ok = (
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("_n"))
        .filter(F.col("_n").isin(list(sizes)))
        .select(*keys)
    )
    return df.join(ok, list(keys), "left_semi")


def covering(
    df: DataFrame,
    reference: DataFrame,
    ts_col: str,
    start_col: str,
    end_col: str,
) -> DataFrame:
    """Rows of ``df`` whose [start, end] covers ``min..max`` of ``reference``.

    The extent is two scalar subqueries over one global aggregate (Spark merges
    them), evaluated once and compared row by row; no join.
    """
    lo = reference.select(F.min(ts_col)).scalar()
    hi = reference.select(F.max(ts_col)).scalar()
    return df.filter((F.col(start_col) <= lo) & (F.col(end_col) >= hi))


def drop_incomplete(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """Drop rows with a missing value (in ``subset`` when given)."""
    return df.dropna(how="any", subset=list(subset) if subset else None)


def zero_to_null(col: Column | str) -> Column:
    """A zero total means "no data" and becomes NULL."""
    c = F.col(col) if isinstance(col, str) else col
    return F.nullif(c, F.lit(0))


def nan_to_null(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Turn floating NaN into NULL so aggregates skip it as pandas does."""
    targets = columns or [
        f.name for f in df.schema.fields if f.dataType.typeName() in ("double", "float")
    ]
    return df.select(
        *[
            F.when(F.isnan(F.col(c)), F.lit(None)).otherwise(F.col(c)).alias(c)
            if c in targets
            else F.col(c)
            for c in df.columns
        ]
    )
