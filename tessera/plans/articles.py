"""Citation records: page extraction, cleaning and per-year statistics.

Stand-ins (rows in the reference's schema, nothing else):

* result pages: ``pages(page_id, url, html)`` as given; a record is the page
  body, its title the ``h1``, its info the ad ``div``, its citation text the
  first navigation link containing ``"th"``
* raw citation records ``(title, publication_info, cited_by)``: one per order,
  text assembled from the order, its customer and the customer's nation
  (authors = customer name, venue = market segment, year = order year,
  publisher = nation; some records take the NBSP separator, a missing part,
  an extra part, no citation text or a second number, as scraped text does)
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators import articles as A
from tessera.plans.common import rounded, two_step_round
from tessera.session import pin_utc
from tessera.sources.tables import read_table

AS_OF_YEAR = 2002
YEARS = list(range(1995, AS_OF_YEAR + 1))
BLOCK = r"(?s)<body>(.*?)(?:</body>|\z)"  # an unclosed body ends with the page
TITLE = r"(?s)<h1>(.*?)</h1>"
INFO = r'(?s)<div class="ad">(.*?)</div>'
LINK = r"(?s)<a\b[^>]*>(.*?)</a>"
NEEDLE = "th"


def raw_articles(spark, root) -> DataFrame:
    o = read_table(spark, root, "orders")
    c = read_table(spark, root, "customer")
    n = read_table(spark, root, "nation")
    j = o.join(c, o.o_custkey == c.c_custkey).join(n, c.c_nationkey == n.n_nationkey, "left")
    status, prio = F.col("o_orderstatus"), F.col("o_orderpriority")
    year = F.year("o_orderdate").cast("string")
    title = F.concat_ws(
        "",
        F.when(status == "F", F.lit("[PDF] ")),
        F.lit('"'),
        F.col("c_name"),
        F.lit(' report"'),
        F.when(prio == "2-HIGH", F.lit(" [CITATION]")),
    )
    venue_year = F.when(status == "O", year).otherwise(F.concat(F.col("c_mktsegment"), F.lit(", "), year))
    sep2 = F.when(status == "P", F.lit("\u00a0- ")).otherwise(F.lit(" - "))
    publisher = F.when(prio != "4-NOT SPECIFIED", F.col("n_name"))
    info = F.concat_ws(
        "",
        F.col("c_name"),
        F.lit(" - "),
        venue_year,
        F.when(publisher.isNotNull(), F.concat(sep2, publisher)),
        F.when(prio == "5-LOW", F.lit(" - extra")),
    )
    cites = F.floor(F.col("o_totalprice") / 1000).cast("long").cast("string")
    cited = F.when(prio == "3-MEDIUM", F.lit(None).cast("string")).otherwise(
        F.concat(
            F.lit("Cited by "),
            cites,
            F.when(prio == "1-URGENT", F.concat(F.lit(" of "), F.col("o_custkey").cast("string"))).otherwise(F.lit("")),
        )
    )
    return j.select(title.alias("title"), info.alias("publication_info"), cited.alias("cited_by"))


def clean(spark, root) -> DataFrame:
    return A.clean_articles(raw_articles(spark, root), AS_OF_YEAR)


def q_page_records(spark, root):
    pin_utc(spark)
    pages = read_table(spark, root, "pages")
    return A.extract_records(pages, BLOCK, TITLE, INFO, NEEDLE, LINK)


def q_clean_articles(spark, root):
    pin_utc(spark)
    return rounded(clean(spark, root))


def q_articles_per_year(spark, root):
    pin_utc(spark)
    return A.articles_per_year(clean(spark, root), YEARS)


def q_citations_per_year(spark, root):
    pin_utc(spark)
    return rounded(A.citations_per_year(clean(spark, root), YEARS))


def q_citation_histogram(spark, root):
    pin_utc(spark)
    return rounded(A.histogram(clean(spark, root), "avg_citations_per_year", 50))


def q_highly_cited_recent(spark, root):
    pin_utc(spark)
    return rounded(A.highly_cited(clean(spark, root), 300, 1999))


def result_pages(spark, root) -> DataFrame:
    """A result page per customer, one block per order; a block holds elements of its own name, and
    comments and scripts name the tag too."""
    o = read_table(spark, root, "orders")
    n = F.col("o_orderkey").cast("string")
    cited = F.when(F.col("o_orderstatus") != "P", F.concat(F.lit('<a href="x">Cited by '), F.floor(F.col("o_totalprice") / 1000).cast("string"), F.lit("</a>")))
    block = F.concat(
        F.lit('<div class="r"><h3>[PDF] Report <b>'), n, F.lit('</b></h3><div class="i"><div>C'), F.col("o_custkey").cast("string"), F.lit("</div> - "),
        F.col("o_orderpriority"), F.lit(' &amp; more</div><!-- <div> --><a href="y">Related</a>'), F.coalesce(cited, F.lit("")), F.lit("</div>"),
    )
    blocks = F.transform(F.array_sort(F.collect_list(F.struct("o_orderkey", block.alias("b")))), lambda x: x["b"])
    html = F.concat(F.lit('<body><div class="page"><script>"</div><div class=\\"r\\">"</script>'), F.array_join(blocks, "<div>ad</div>"), F.lit("</div></body>"))
    return o.groupBy(F.col("o_custkey").alias("page_id")).agg(html.alias("html"))


def q_result_page_records(spark, root):
    """Several blocks per page, each with elements of its own name."""
    pin_utc(spark)
    return A.nested_records(result_pages(spark, root), "div", 'class="r"', r"(?s)<h3>(.*?)</h3>", r'(?s)<div class="i">(.*)</div>', "Cited by")


def q_page_ads(spark, root):
    """S16 on the pages as given: the text of every ``div`` of class ``ad``."""
    pin_utc(spark)
    blocks = A.nested_blocks(read_table(spark, root, "pages"), "div", 'class="ad"')
    return blocks.select("page_id", "pos", A.tx.strip_tags("block").alias("text"))


QUERIES = {
    "result_page_records": q_result_page_records,
    "page_ads": q_page_ads,
    "page_records": q_page_records,
    "clean_articles": q_clean_articles,
    "articles_per_year": q_articles_per_year,
    "citations_per_year": q_citations_per_year,
    "citation_histogram": q_citation_histogram,
    "highly_cited_recent": q_highly_cited_recent,
}

# ---------------------------------------------------------------- DuckDB oracles


def _strip_tags_sql(expr: str) -> str:
    out = f"regexp_replace({expr}, '(?s)<[^>]*>', '', 'g')"
    for entity, char in A.tx.ENTITIES:
        esc = char.replace("'", "''")
        out = f"replace({out}, '{entity}', '{esc}')"
    return out


PAGE_SQL = f"""
WITH parts AS (SELECT page_id, string_split(html, '<body>') AS pt FROM pages),
blocks AS (SELECT page_id, CAST(i AS INTEGER) AS pos, string_split(pt[i + 2], '</body>')[1] AS blk
           FROM parts, range(len(parts.pt) - 1) r(i))
SELECT page_id, pos,
  {_strip_tags_sql(f"regexp_extract(blk, '{TITLE}', 1)")} AS title,
  {_strip_tags_sql(f"""regexp_extract(blk, '{INFO.replace("'", "''")}', 1)""")} AS publication_info,
  list_filter(list_transform(regexp_extract_all(blk, '{LINK}', 1), lambda a: {_strip_tags_sql('a')}),
              lambda t: contains(t, '{NEEDLE}'))[1] AS cited_by
FROM blocks"""

RAW_SQL = """
WITH raw AS (
  SELECT
    concat(CASE WHEN o_orderstatus = 'F' THEN '[PDF] ' ELSE '' END, '"', c_name, ' report"',
           CASE WHEN o_orderpriority = '2-HIGH' THEN ' [CITATION]' ELSE '' END) AS title,
    concat(c_name, ' - ',
           CASE WHEN o_orderstatus = 'O' THEN CAST(year(o_orderdate) AS VARCHAR)
                ELSE concat(c_mktsegment, ', ', CAST(year(o_orderdate) AS VARCHAR)) END,
           CASE WHEN o_orderpriority = '4-NOT SPECIFIED' OR n_name IS NULL THEN ''
                WHEN o_orderstatus = 'P' THEN concat(chr(160), '- ', n_name)
                ELSE concat(' - ', n_name) END,
           CASE WHEN o_orderpriority = '5-LOW' THEN ' - extra' ELSE '' END) AS publication_info,
    CASE WHEN o_orderpriority = '3-MEDIUM' THEN NULL
         ELSE concat('Cited by ', CAST(CAST(floor(o_totalprice / 1000) AS BIGINT) AS VARCHAR),
                     CASE WHEN o_orderpriority = '1-URGENT' THEN concat(' of ', CAST(o_custkey AS VARCHAR)) ELSE '' END)
    END AS cited_by
  FROM orders JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey),
staged AS (
  SELECT regexp_replace(regexp_replace(title, '\\[.*?\\]', '', 'g'), '^\\s+|\\s+$', '', 'g') AS t0,
         string_split_regex(publication_info, ' - |' || chr(160) || '-') AS p,
         regexp_extract_all(coalesce(cited_by, ''), '(\\d+)', 1) AS nums,
         cited_by
  FROM raw),
parsed AS (
  SELECT trim(t0, '"') AS title, p[1] AS authors, p[2] AS vy, p[3] AS publisher, nums, cited_by
  FROM staged WHERE len(p) = 3),
clean AS (
  SELECT title, authors,
    CAST(CASE WHEN regexp_matches(vy, '^(.*?)\\s+(\\d{4})') THEN regexp_extract(vy, '^(.*?)\\s+(\\d{4})', 2)
              ELSE nullif(regexp_extract(vy, '(\\d{4})', 1), '') END AS INTEGER) AS year,
    CASE WHEN regexp_matches(vy, '^(.*?)\\s+(\\d{4})') THEN regexp_extract(vy, '^(.*?)\\s+(\\d{4})', 1)
         WHEN regexp_matches(vy, '\\s') THEN regexp_extract(vy, '(.*?)\\s', 1) END AS venue,
    publisher, CAST(nums[1] AS INTEGER) AS citation_count
  FROM parsed WHERE cited_by IS NOT NULL AND len(nums) = 1),
articles AS (
  SELECT title, authors, year, venue, publisher, citation_count,
         citation_count / (%d - year + 1) AS avg_citations_per_year
  FROM clean WHERE year IS NOT NULL),
years AS (SELECT CAST(range AS INTEGER) AS year FROM range(%d, %d))
""" % (AS_OF_YEAR, YEARS[0], YEARS[-1] + 1)

ORACLE = {
    "result_page_records": """
SELECT o_custkey AS page_id, CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1 AS INTEGER) AS pos,
       concat('[PDF] Report ', o_orderkey) AS title, concat('C', o_custkey, ' - ', o_orderpriority, ' & more') AS publication_info,
       CASE WHEN o_orderstatus <> 'P' THEN concat('Cited by ', CAST(floor(o_totalprice / 1000) AS BIGINT)) END AS cited_by
FROM orders""",
    "page_ads": f"""
WITH RECURSIVE cut AS (
  SELECT page_id, regexp_extract_all(h, '(?is)</?div\\b[^>]*>') AS tags, regexp_split_to_array(h, '(?is)</?div\\b[^>]*>') AS parts
  FROM (SELECT page_id, regexp_replace(html, '(?is)<!--.*?-->|<script\\b.*?</script\\s*>|<style\\b.*?</style\\s*>', '', 'g') AS h FROM pages)),
walk AS (  -- one row per (block, tag): how deep the tag leaves the block
  SELECT page_id, tags, parts, i AS first, i, 1 AS depth, parts[i + 1] AS block
  FROM (SELECT *, unnest(range(1, len(tags) + 1)) AS i FROM cut) WHERE tags[i] NOT LIKE '</%' AND regexp_matches(tags[i], 'class="ad"')
  UNION ALL
  SELECT page_id, tags, parts, first, i + 1, depth + CASE WHEN tags[i + 1] LIKE '</%' THEN -1 ELSE 1 END,
         CASE WHEN depth = 1 AND tags[i + 1] LIKE '</%' THEN block ELSE concat(block, tags[i + 1], parts[i + 2]) END
  FROM walk WHERE depth > 0 AND i < len(tags)),
ends AS (SELECT page_id, first, block FROM walk WHERE depth = 0 OR i = len(tags))
SELECT page_id, CAST(row_number() OVER (PARTITION BY page_id ORDER BY first) - 1 AS INTEGER) AS pos, {_strip_tags_sql("block")} AS text FROM ends""",
    "page_records": PAGE_SQL,
    "clean_articles": RAW_SQL
    + "SELECT title, authors, year, venue, publisher, citation_count,"
    " round(avg_citations_per_year, 6) AS avg_citations_per_year FROM articles",
    "articles_per_year": RAW_SQL
    + "SELECT y.year, count(a.year) AS article_count FROM years y"
    " LEFT JOIN articles a ON a.year = y.year GROUP BY y.year",
    "citations_per_year": RAW_SQL
    + """
SELECT y.year, CAST(coalesce(sum(a.citation_count), 0) AS BIGINT) AS total_citations,
       count(a.year) AS article_count,
       round(CASE WHEN count(a.year) > 0 THEN sum(a.citation_count) / count(a.year) END, 6) AS mean_citations
FROM years y LEFT JOIN articles a ON a.year = y.year GROUP BY y.year""",
    "citation_histogram": RAW_SQL
    + """,
ext AS (SELECT CASE WHEN min(avg_citations_per_year) = max(avg_citations_per_year)
                    THEN min(avg_citations_per_year) - 0.5 ELSE min(avg_citations_per_year) END AS lo,
               CASE WHEN min(avg_citations_per_year) = max(avg_citations_per_year)
                    THEN max(avg_citations_per_year) + 0.5 ELSE max(avg_citations_per_year) END AS hi
        FROM articles),
binned AS (
  SELECT CAST(least(floor((avg_citations_per_year - lo) * (50.0 / (hi - lo))), 49) + 1 AS INTEGER) AS bin,
         count(*) AS cnt
  FROM articles, ext WHERE avg_citations_per_year IS NOT NULL GROUP BY 1),
bins AS (SELECT CAST(range AS INTEGER) AS bin FROM range(1, 51))
SELECT bins.bin, round(lo + (bins.bin - 1) * ((hi - lo) / 50.0), 6) AS bin_lo,
       round(lo + bins.bin * ((hi - lo) / 50.0), 6) AS bin_hi, coalesce(cnt, 0) AS count
FROM bins CROSS JOIN ext LEFT JOIN binned ON binned.bin = bins.bin""",
    "highly_cited_recent": RAW_SQL
    + "SELECT title, authors, year, venue, publisher, citation_count,"
    " round(avg_citations_per_year, 6) AS avg_citations_per_year FROM articles"
    " WHERE citation_count > 300 AND year >= 1999",
}

# Same presentation rounding as the Spark side (see plans.common.round_half_away).
ORACLE = {k: two_step_round(v) for k, v in ORACLE.items()}
