"""String / regex helpers with Python's semantics.

Python's ``\\s``, ``\\d`` and ``str.strip()`` are Unicode-aware while Java's
are ASCII-only and Spark's ``trim`` removes spaces only, so patterns carry
``(?U)`` and stripping is done by regex.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The HTML entities decoded when taking text out of markup.
ENTITIES = [
    ("&nbsp;", "\u00a0"),
    ("&lt;", "<"),
    ("&gt;", ">"),
    ("&quot;", '"'),
    ("&#39;", "'"),
    ("&copy;", "©"),
    ("&middot;", "·"),
    ("&amp;", "&"),
]


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def py_strip(col: Column | str) -> Column:
    """``str.strip()``: drop leading and trailing Unicode whitespace."""
    return F.regexp_replace(_c(col), r"(?U)^\s+|\s+$", "")


def strip_chars(col: Column | str, chars: str) -> Column:
    """``str.strip(chars)``."""
    return F.btrim(_c(col), F.lit(chars))


def clean_title(col: Column | str) -> Column:
    """drop ``[...]`` tags, strip whitespace, then strip double quotes."""
    no_tags = F.regexp_replace(_c(col), r"\[.*?\]", "")
    return strip_chars(py_strip(no_tags), '"')


def split_publication(col: Column | str) -> Column:
    """split on ``" - "`` and on NBSP + ``-`` in one pass (the two
    separators cannot overlap); the part after NBSP+``-`` keeps its space."""
    return F.split(_c(col), " - |\u00a0-", -1)


def all_integers(col: Column | str) -> Column:
    """every run of digits."""
    return F.regexp_extract_all(_c(col), F.lit(r"(?U)(\d+)"), 1)


def first_match(arr: Column, predicate) -> Column:
    """F16: first element satisfying ``predicate``, NULL when none does."""
    return F.get(F.filter(arr, predicate), 0)


def strip_tags(col: Column | str) -> Column:
    """Text content of an HTML fragment: tags removed, entities decoded."""
    out = F.regexp_replace(_c(col), r"(?s)<[^>]*>", "")
    for entity, char in ENTITIES:
        out = F.replace(out, F.lit(entity), F.lit(char))
    return out
