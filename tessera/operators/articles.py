"""Result-page extraction, citation-record cleaning and per-year statistics
(S16, F1-F5, C5, A10-A12, J9, P6).
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions import text as tx


def extract_records(
    pages: DataFrame,
    block: str,
    title: str,
    info: str,
    link_text_contains: str,
    link: str = r"(?s)<a\b[^>]*>(.*?)</a>",
    key: str = "page_id",
) -> DataFrame:
    """One record per block of every page.

    ``block``, ``title`` and ``info`` are regexes whose group 1 is the block /
    field markup; fields are reduced to their text. ``cited`` is the text of the
    first link in the block containing ``link_text_contains`` (NULL if none).
    Blocks keep their position within the page (``pos``).
    """
    blocks = pages.select(
        key, F.posexplode(F.regexp_extract_all("html", F.lit(block), 1)).alias("pos", "_b")
    )
    links = F.transform(F.regexp_extract_all("_b", F.lit(link), 1), lambda a: tx.strip_tags(a))
    return blocks.select(
        key,
        "pos",
        tx.strip_tags(F.regexp_extract("_b", title, 1)).alias("title"),
        tx.strip_tags(F.regexp_extract("_b", info, 1)).alias("publication_info"),
        tx.first_match(links, lambda t: F.contains(t, F.lit(link_text_contains))).alias("cited_by"),
    )


#: What holds tags that are no markup.
HIDDEN = r"(?is)<!--.*?-->|<script\b.*?</script\s*>|<style\b.*?</style\s*>"

#: Pages and characters of blocks handed on at once.
PAGES, BLOCK_CHARS = 1_000, 4 << 20


def nested_blocks(pages: DataFrame, tag: str, attributes: str, key: str = "page_id", html: str = "html") -> DataFrame:
    """``key, pos, block`` (inner markup) of every element ``tag`` whose opening tag matches
    the regex ``attributes``, at its own closing tag whatever elements of the same name it holds.

    The page is cut at the tags of that name; one pass over a page's tags with a stack of the open ones
    gives each element's end. Matching elements inside one another are blocks each, with their own ``pos`` (order of the
    opening tags in the page). An element that is never closed ends with
    the page, a closing tag too many closes nothing. Comments, scripts and styles are left out
    first. Rows that repeat a key are pages each. Pages pass one by one: nothing is shuffled or sorted, and a
    task holds a batch of pages at most.
    """
    any_tag = rf"(?is)</?{tag}\b[^>]*>"
    shown = F.regexp_replace(F.col(html), HIDDEN, "")
    cut = pages.select(F.col(key), shown.alias("_shown")).select(
        key, F.regexp_extract_all("_shown", F.lit(any_tag), 0).alias("_tags"), F.split("_shown", any_tag, -1).alias("_text")
    )
    wanted = F.transform("_tags", lambda t: ~F.startswith(t, F.lit("</")) & t.rlike(attributes))
    cut = cut.select(key, "_tags", "_text", wanted.alias("_wanted"))

    def inner(tags: list[str], after: list[str], wanted: list[bool]) -> Iterator[str]:
        """Inner markup of the wanted elements of one page, in the order of their opening tags."""
        ends, opened = [len(tags)] * len(tags), []
        for i, tag in enumerate(tags):
            if not tag.startswith("</"):
                opened.append(i)
            elif opened:  # a closing tag below the page's own level closes nothing
                ends[opened.pop()] = i
        for i, end in enumerate(ends):
            if wanted[i]:
                yield "".join([after[i], *(part for j in range(i + 1, end) for part in (tags[j], after[j]))])

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, PAGES):
                rows, places, blocks, held = [], [], [], 0
                part = batch.slice(at, PAGES)
                for row, page in enumerate(zip(*(part.column(i) for i in (1, 2, 3)))):
                    tags, text, marks = (x.as_py() for x in page)
                    for pos, block in enumerate(inner(tags, text[1:], marks) if tags else ()):
                        rows.append(row)
                        places.append(pos)
                        blocks.append(block)
                        held += len(block)
                        if held > BLOCK_CHARS:
                            yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(rows)), pa.array(places, pa.int32()), pa.array(blocks)], names=[key, "pos", "block"])
                            rows, places, blocks, held = [], [], [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(rows)), pa.array(places, pa.int32()), pa.array(blocks)], names=[key, "pos", "block"])

    return cut.mapInArrow(run, f"`{key}` {cut.schema[key].dataType.simpleString()}, pos int, block string")


def nested_records(
    pages: DataFrame, tag: str, attributes: str, title: str, info: str, link_text_contains: str, link: str = r"(?s)<a\b[^>]*>(.*?)</a>", key: str = "page_id"
) -> DataFrame:
    """S16 over :func:`nested_blocks`: the fields of :func:`extract_records`, for blocks that hold
    elements of their own name and for pages with any number of blocks."""
    blocks = nested_blocks(pages, tag, attributes, key)
    links = F.transform(F.regexp_extract_all("block", F.lit(link), 1), lambda a: tx.strip_tags(a))
    return blocks.select(
        key, "pos", tx.strip_tags(F.regexp_extract("block", title, 1)).alias("title"), tx.strip_tags(F.regexp_extract("block", info, 1)).alias("publication_info"),
        tx.first_match(links, lambda t: F.contains(t, F.lit(link_text_contains))).alias("cited_by"),
    )


def clean_articles(raw: DataFrame, as_of_year: int) -> DataFrame:
    """F1-F5 + C5: clean raw ``(title, publication_info, cited_by)`` records.

    Kept rows have exactly three publication parts (authors, venue+year,
    publisher), a year, and exactly one integer in the citation text; the
    others are dropped (a repeated CSV header row falls out the same way).
    Venue/year: ``^(.*?)\\s+(\\d{4})`` if it matches at the start, else the text
    before the first whitespace and the first four digits.
    """
    parts = tx.split_publication("publication_info")
    vy = F.get("_p", 1)
    prefix = r"(?U)^(.*?)\s+(\d{4})"
    has_prefix = vy.rlike(prefix)
    venue = F.when(has_prefix, F.regexp_extract(vy, prefix, 1)).otherwise(
        F.when(vy.rlike(r"(?U)\s"), F.regexp_extract(vy, r"(?U)(.*?)\s", 1))
    )
    year_text = F.when(has_prefix, F.regexp_extract(vy, prefix, 2)).otherwise(
        F.nullif(F.regexp_extract(vy, r"(?U)(\d{4})", 1), F.lit(""))
    )
    nums = tx.all_integers("cited_by")
    staged = raw.select(
        tx.clean_title("title").alias("title"),
        parts.alias("_p"),
        nums.alias("_n"),
    ).filter(F.size("_p") == 3)
    out = staged.select(
        "title",
        F.get("_p", 0).alias("authors"),
        year_text.try_cast("int").alias("year"),
        venue.alias("venue"),
        F.get("_p", 2).alias("publisher"),
        "_n",
    ).filter(F.col("year").isNotNull() & (F.size("_n") == 1))
    count = F.get("_n", 0).try_cast("int")
    return out.select(
        "title",
        "authors",
        "year",
        "venue",
        "publisher",
        count.alias("citation_count"),
        F.try_divide(count.cast("double"), F.lit(as_of_year) - F.col("year") + 1).alias(
            "avg_citations_per_year"
        ),
    )


def highly_cited(clean: DataFrame, min_citations: int, min_year: int) -> DataFrame:
    """Articles with more than ``min_citations`` citations since ``min_year``."""
    return clean.filter((F.col("citation_count") > min_citations) & (F.col("year") >= min_year))


def _years(clean: DataFrame, years: Sequence[int]) -> DataFrame:
    return clean.sparkSession.createDataFrame([(int(y),) for y in years], "year int")


def articles_per_year(clean: DataFrame, years: Sequence[int]) -> DataFrame:
    """A10: number of articles in each listed year (0 when absent)."""
    counts = clean.groupBy("year").agg(F.count(F.lit(1)).alias("article_count"))
    return (
        _years(clean, years)
        .join(counts, "year", "left")
        .select("year", F.coalesce("article_count", F.lit(0)).alias("article_count"))
    )


def citations_per_year(clean: DataFrame, years: Sequence[int]) -> DataFrame:
    """A11 + J9: total and mean citations per listed year (mean NULL for a year
    without articles)."""
    sums = clean.groupBy("year").agg(
        F.sum("citation_count").alias("total_citations"), F.count(F.lit(1)).alias("article_count")
    )
    return (
        _years(clean, years)
        .join(sums, "year", "left")
        .select(
            "year",
            F.coalesce("total_citations", F.lit(0)).alias("total_citations"),
            F.coalesce("article_count", F.lit(0)).alias("article_count"),
        )
        .withColumn(
            "mean_citations",
            F.try_divide(F.col("total_citations").cast("double"), F.col("article_count")),
        )
    )


def histogram(df: DataFrame, col: str, bins: int = 50) -> DataFrame:
    """Equal-width histogram over ``[min, max]`` with the last bin closed
    (a value equal to the maximum counts in the last bin); every bin is listed.
    Bins are numbered from 1.

    Two passes, as any equal-width histogram needs: the extent (one scalar
    subquery; Spark merges the min and max into a single aggregate, evaluated
    once), then the bin counts, taken over the column reduced to
    ``(value, count)`` so the bin shuffle carries one row per distinct value.
    """
    values = df.filter(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("_c"))
    mn = values.select(F.min(col)).scalar()
    mx = values.select(F.max(col)).scalar()
    lo = F.when(mn == mx, mn - 0.5).otherwise(mn)
    hi = F.when(mn == mx, mx + 0.5).otherwise(mx)
    idx = F.least(F.floor((F.col(col) - lo) * (F.lit(float(bins)) / (hi - lo))), F.lit(bins - 1)) + 1
    counts = values.groupBy(idx.cast("int").alias("bin")).agg(F.sum("_c").alias("count"))
    width = (hi - lo) / F.lit(float(bins))
    spine = df.sparkSession.range(1, bins + 1).select(F.col("id").cast("int").alias("bin"))
    return spine.join(counts, "bin", "left").select(
        "bin",
        (lo + (F.col("bin") - 1) * width).alias("bin_lo"),
        (lo + F.col("bin") * width).alias("bin_hi"),
        F.coalesce("count", F.lit(0)).alias("count"),
    )
