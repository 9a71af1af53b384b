"""Helpers shared by the registered queries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DIGITS = 6


GUARD = 3


def _round_once(c: Column, digits: int) -> Column:
    scale = F.lit(10.0**digits)
    return F.round(c * scale, 0) / scale


def round_half_away(col: Column | str, digits: int = DIGITS) -> Column:
    """Presentation rounding of a computed double to ``digits`` decimals.

    Two steps: first to ``digits + 3`` decimals, which removes the last-bit
    noise left by summing in a different order (Spark's partial aggregates are
    merged in no fixed order), then to ``digits``. Each step is
    ``round(x * 10^d) / 10^d`` with halves away from zero, the common SQL engine
    definition. A value whose exact decimal expansion ends in 5 at ``digits + 1``
    (frequent for means of decimal data) then prints the same however it was
    summed; the oracles apply the same rule (:func:`two_step_round`)."""
    c = F.col(col) if isinstance(col, str) else col
    return _round_once(_round_once(c, digits + GUARD), digits)


def two_step_round(sql: str) -> str:
    """Rewrite every ``round(expr, d)`` of an oracle query as
    ``round(round(expr, d + 3), d)``, the SQL form of :func:`round_half_away`."""
    out, i, n = [], 0, len(sql)
    while i < n:
        j = sql.find("round(", i)
        if j < 0 or (j > 0 and (sql[j - 1].isalnum() or sql[j - 1] == "_")):
            if j < 0:
                out.append(sql[i:])
                break
            out.append(sql[i : j + 6])
            i = j + 6
            continue
        out.append(sql[i:j])
        depth, k, comma = 0, j + 6, -1
        while k < n:
            ch = sql[k]
            if ch == "(":
                depth += 1
            elif ch == ")":
                if depth == 0:
                    break
                depth -= 1
            elif ch == "," and depth == 0:
                comma = k
            k += 1
        inner = sql[j + 6 : k]
        if comma < 0:
            out.append("round(" + two_step_round(inner) + ")")
        else:
            expr = two_step_round(sql[j + 6 : comma])
            digits = sql[comma + 1 : k].strip()
            if digits.isdigit():
                out.append(f"round(round({expr}, {int(digits) + GUARD}), {digits})")
            else:
                out.append(f"round({expr}, {two_step_round(digits)})")
        i = k + 1
    return "".join(out)


def rounded(df: DataFrame, digits: int = DIGITS) -> DataFrame:
    """Round every floating column so that engines summing in different orders
    agree on the printed value."""
    return df.select(
        *[
            round_half_away(F.col(f.name), digits).alias(f.name)
            if f.dataType.typeName() in ("double", "float")
            else F.col(f.name)
            for f in df.schema.fields
        ]
    )
