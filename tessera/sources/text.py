"""Line-oriented text sources.

* :func:`read_regex_lines` - latin-1 delimited text whose fields are cut by an
  anchored regular expression (titles may contain commas), header skipped.
* :func:`read_edges` / :func:`read_columns` - whitespace separated columns.
* :func:`read_meter_csv` - headerless CSV with the stamp and reading by position.
* :func:`read_header_csv` - CSV with a header and an explicit schema.

All parsing is Column expressions inside the scan stage (no Python per row).
Floating NaN read from text becomes NULL (missing), as in pandas; parquet
tables are read as they are (``quality.nan_to_null`` converts them on request,
at the cost of filter pushdown on those columns).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tessera.operators.quality import Checked, clean_text, nan_to_null

# The reference's line patterns for its five movie-database files.
MOVIE_PATTERN = r"^(\d+),(.*),(\d+),(\d+(?:\.\d+)?)?$"
PERSON_PATTERN = r"^(\d+),(.*),(.*),(.*)?$"
DIRECTOR_PATTERN = r"^(\d+),(.*),(.*)?$"
MOVIE_DIRECTOR_PATTERN = r"^(\d+),(\d+)"
CAST_PATTERN = r"^(\d+),(\d+),(.*)?$"

# Java's \d, \s and friends are ASCII-only unless the pattern is Unicode-aware,
# while Python's are Unicode-aware; (?U) makes both behave alike.
UNICODE = "(?U)"


class LineSpec:
    """Column names and Spark SQL types for the groups of a line pattern."""

    def __init__(self, pattern: str, columns: Sequence[str], types: Sequence[str]):
        if len(columns) != len(types):
            raise ValueError("columns and types differ in length")
        self.pattern = pattern
        self.columns = list(columns)
        self.types = list(types)


MOVIE = LineSpec(MOVIE_PATTERN, ["id", "name", "year", "rank"], ["bigint", "string", "int", "double"])
PERSON = LineSpec(PERSON_PATTERN, ["id", "fname", "lname", "gender"], ["bigint", "string", "string", "string"])
DIRECTOR = LineSpec(DIRECTOR_PATTERN, ["id", "fname", "lname"], ["bigint", "string", "string"])
MOVIE_DIRECTOR = LineSpec(MOVIE_DIRECTOR_PATTERN, ["did", "mid"], ["bigint", "bigint"])
CAST = LineSpec(CAST_PATTERN, ["pid", "mid", "role"], ["bigint", "bigint", "string"])


def read_lines(
    spark: SparkSession,
    path: str | Sequence[str],
    encoding: str = "ISO-8859-1",
    header: bool = True,
) -> DataFrame:
    """Whole lines as column ``value`` with an ``ord`` input ordinal.

    ``read.text`` ignores the encoding, so the CSV reader is used with a field
    separator that never occurs and quoting off, which yields one column per
    line decoded with ``encoding``. ``ord`` orders lines by file then position
    within the split (file path, split start, row id), which follows file order.
    """
    df = (
        spark.read.option("header", str(header).lower())
        .option("encoding", encoding)
        .option("sep", "\u0001")
        .option("quote", "\u0000")
        .option("escape", "\u0000")
        .option("ignoreLeadingWhiteSpace", "false")
        .option("ignoreTrailingWhiteSpace", "false")
        .option("nullValue", "\u0000\u0000")
        .option("inferSchema", "false")
        .schema("value string")
        .csv(path)
    )
    return df.select(
        F.coalesce(F.col("value"), F.lit("")).alias("value"),
        F.struct(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("row"),
        ).alias("ord"),
    )


def number_lines(lines: DataFrame, name: str = "ord") -> DataFrame:
    """Replace the ``ord`` struct of :func:`read_lines` by one dense number per line, from 0,
    in the order of the file paths and of the lines within each file.

    The lines of every input split are counted (one pass that aggregates in the scan), the
    counts summed over the earlier splits, and a line's number is its split's sum plus its place
    in the split. What reaches the driver and is broadcast is one row per split, of which
    the scan's planner holds the list anyway. Both passes read the same splits, so row
    ids agree.
    """
    spark = lines.sparkSession
    split = ["ord.file", "ord.block"]
    counted = lines.groupBy(*split).agg(F.count(F.lit(1)).alias("n"), F.min("ord.row").alias("first")).collect()
    base, rows = 0, []
    for r in sorted(counted, key=lambda r: (r["file"], r["block"])):
        rows.append((r["file"], r["block"], base - r["first"]))
        base += r["n"]
    bases = spark.createDataFrame(rows, "_file string, _block bigint, _base bigint")
    same = (F.col("ord.file") == bases["_file"]) & (F.col("ord.block") == bases["_block"])
    numbered = lines.join(F.broadcast(bases), same)
    others = [c for c in lines.columns if c != "ord"]
    return numbered.select(*others, (F.col("_base") + F.col("ord.row")).alias(name))


def parse_lines(lines: DataFrame, spec: LineSpec, clean: bool = True) -> Checked:
    """Cut ``value`` into the groups of ``spec``; unmatched lines are rejects.

    A group that did not take part in the match (an empty optional group) is
    NULL. With ``clean`` the text fields get C4 (quote swap, empty -> NULL).
    Numbers are cast with ``try_cast`` so a value beyond the type is NULL, not
    an error.
    """
    pattern = UNICODE + spec.pattern
    value = F.col("value")
    fields: list[Column] = []
    castable = F.lit(True)  # a number that does not fit its type rejects the line
    for i, (name, typ) in enumerate(zip(spec.columns, spec.types), start=1):
        raw = F.regexp_extract(value, pattern, i)
        if typ == "string":
            col = clean_text(raw) if clean else F.nullif(raw, F.lit(""))
        else:
            col = F.nullif(raw, F.lit("")).try_cast(typ)
            castable = castable & (col.isNotNull() | (raw == F.lit("")))
        fields.append(col.alias(name))
    matched = F.coalesce(value.rlike(pattern) & castable, F.lit(False))
    kept = lines.filter(matched).select(*fields, "ord")
    rejects = lines.filter(~matched).select("value", "ord")
    return Checked(kept, rejects)


def read_regex_lines(
    spark: SparkSession,
    path: str | Sequence[str],
    spec: LineSpec,
    mode: str = "permissive",
    encoding: str = "ISO-8859-1",
    header: bool = True,
    dense: bool = False,
) -> Checked:
    """Parse a regex-delimited file.

    ``mode='permissive'`` returns unmatched lines as rejects; ``'failfast'``
    makes the scan raise on the first unmatched line (the reference crashes).
    ``dense`` numbers the lines (:func:`number_lines`; the file is counted first).
    """
    lines = read_lines(spark, path, encoding, header)
    if dense:
        lines = number_lines(lines)
    if mode == "failfast":
        matched = F.col("value").rlike(UNICODE + spec.pattern)
        stop = F.raise_error(F.concat(F.lit("line does not match: "), F.col("value")))
        lines = lines.filter(F.when(matched, F.lit(True)).otherwise(stop))
    elif mode != "permissive":
        raise ValueError(f"mode must be 'permissive' or 'failfast', not {mode!r}")
    return parse_lines(lines, spec)


def split_ws(col: Column | str) -> Column:
    """Python ``str.split()``: split on runs of (Unicode) whitespace, no empties (F8)."""
    c = F.col(col) if isinstance(col, str) else col
    return F.filter(F.split(c, r"(?U)\s+"), lambda s: s != F.lit(""))


def read_columns(
    spark: SparkSession, path: str | Sequence[str], names: Sequence[str], types: Sequence[str]
) -> DataFrame:
    """Whitespace separated columns, one row per non-blank line."""
    parts = split_ws("value")
    df = spark.read.text(path).select(parts.alias("_p")).filter(F.size("_p") > 0)
    return nan_to_null(
        df.select(
            *[
                (F.get(F.col("_p"), i) if t == "string" else F.get(F.col("_p"), i).cast(t)).alias(n)
                for i, (n, t) in enumerate(zip(names, types))
            ]
        )
    )


def read_edges(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """``src dst`` integer edge list."""
    return read_columns(spark, path, ["src", "dst"], ["long", "long"])


def read_ranks(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """``vertex rank`` rows."""
    return read_columns(spark, path, ["vertex", "rank"], ["long", "double"])


def read_labels(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """``vertex label`` rows."""
    return read_columns(spark, path, ["vertex", "person"], ["long", "string"])


def read_meter_csv(
    spark: SparkSession,
    path: str | Sequence[str],
    ts_index: int = 3,
    value_index: int = 5,
    ts_format: str = "M/d/yyyy h:mm:ss a",
) -> DataFrame:
    """Headerless CSV; the stamp and the kWh reading are taken by position.

    One-letter month/day/hour fields accept padded and unpadded numbers. An
    empty or non-numeric reading is NULL (``cast('' as double)`` would raise under
    ANSI); a malformed stamp fails the read.
    """
    raw = spark.read.option("header", "false").csv(path)
    return nan_to_null(
        raw.select(
            F.to_timestamp_ntz(F.col(f"_c{ts_index}"), F.lit(ts_format)).alias("ts"),
            F.col(f"_c{value_index}").try_cast("double").alias("kwh"),
        )
    )


def read_header_csv(
    spark: SparkSession, path: str | Sequence[str], schema: StructType | str
) -> DataFrame:
    """CSV with a header line and a declared schema (no inference). A
    floating NaN (e.g. the text ``NaN``) is read as NULL: missing, as pandas
    treats it."""
    return nan_to_null(spark.read.option("header", "true").schema(schema).csv(path))
