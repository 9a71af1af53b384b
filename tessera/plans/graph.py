"""Registered PageRank queries over graphs taken from the test tables.

* events graph:   ``user_id -> props.k`` per event (repeats kept)
* dangling graph: ``o_custkey -> 10_000_000 + l_suppkey`` per line item
  (suppliers have no out-edge, so every supplier vertex is dangling)
* labels:         ``customer(c_custkey, c_name)`` as ``(vertex, person)``
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators import graph as G
from tessera.plans.common import round_half_away, two_step_round
from tessera.session import pin_utc
from tessera.sources.tables import read_table

ITERATIONS = 10
SUPPLIER_OFFSET = 10_000_000
DIGITS = 9


def events_edges(spark, root) -> DataFrame:
    ev = read_table(spark, root, "events")
    return ev.select(
        F.col("user_id").alias("src"),
        F.get_json_object("props", "$.k").cast("long").alias("dst"),
    ).filter(F.col("dst").isNotNull())


def dangling_edges(spark, root) -> DataFrame:
    o = read_table(spark, root, "orders").select("o_orderkey", "o_custkey")
    li = read_table(spark, root, "lineitem").select("l_orderkey", "l_suppkey")
    return li.join(o, li.l_orderkey == o.o_orderkey).select(
        F.col("o_custkey").alias("src"), (F.col("l_suppkey") + SUPPLIER_OFFSET).alias("dst")
    )


def _rounded(ranks: DataFrame) -> DataFrame:
    return ranks.select("vertex", round_half_away("rank", DIGITS).alias("rank"))


def q_page_rank_events(spark, root):
    pin_utc(spark)
    return _rounded(G.page_rank(events_edges(spark, root), ITERATIONS))


def q_page_rank_dangling(spark, root):
    pin_utc(spark)
    return _rounded(G.page_rank(dangling_edges(spark, root), ITERATIONS))


def q_vertex_rank(spark, root):
    pin_utc(spark)
    return G.rank_of(q_page_rank_events(spark, root), 2)


def q_max_rank_vertex(spark, root):
    pin_utc(spark)
    return G.max_rank(q_page_rank_events(spark, root))


def q_vertex_labels(spark, root):
    pin_utc(spark)
    labels = read_table(spark, root, "customer").select(
        F.col("c_custkey").alias("vertex"), F.col("c_name").alias("person")
    )
    return G.label_ranks(labels, q_page_rank_dangling(spark, root))


def q_dangling_vertices(spark, root):
    pin_utc(spark)
    return G.dangling_vertices(dangling_edges(spark, root))


QUERIES = {
    "dangling_vertices": q_dangling_vertices,
    "page_rank_events": q_page_rank_events,
    "page_rank_dangling": q_page_rank_dangling,
    "vertex_rank": q_vertex_rank,
    "max_rank_vertex": q_max_rank_vertex,
    "vertex_labels": q_vertex_labels,
}


def page_rank_sql(edges_sql: str, iterations: int = ITERATIONS) -> str:
    """PageRank unrolled into one CTE per iteration (independent of the Spark plan:
    the dangling mass is computed from the vertex table, not from added edges)."""
    ctes = [
        f"e AS ({edges_sql})",
        "v AS (SELECT src AS vertex FROM e UNION SELECT dst FROM e)",
        "cnt AS (SELECT CAST(count(*) AS DOUBLE) AS n FROM v)",
        "deg AS (SELECT src, count(*) AS deg FROM e GROUP BY src)",
        "vd AS (SELECT v.vertex, deg.deg FROM v LEFT JOIN deg ON v.vertex = deg.src)",
        "r0 AS (SELECT vertex, CAST(1.0 AS DOUBLE) AS rank FROM v)",
    ]
    for k in range(1, iterations + 1):
        p = f"r{k - 1}"
        ctes.append(
            f"""r{k} AS (
  SELECT vd.vertex, 0.15 + 0.85 * (coalesce(c.s, 0) + dm.m) AS rank
  FROM vd
  LEFT JOIN (SELECT e.dst, sum(p.rank / d.deg) AS s
             FROM e JOIN {p} p ON e.src = p.vertex JOIN vd d ON d.vertex = e.src
             GROUP BY e.dst) c ON c.dst = vd.vertex
  CROSS JOIN (SELECT coalesce(sum(p.rank), 0) / (SELECT n FROM cnt) AS m
              FROM {p} p JOIN vd d ON d.vertex = p.vertex WHERE d.deg IS NULL) dm)"""
        )
    ctes.append(
        f"ranks AS (SELECT vertex, round(rank / (SELECT n FROM cnt), {DIGITS}) AS rank"
        f" FROM r{iterations})"
    )
    return "WITH " + ",\n".join(ctes) + "\n"


EVENTS_EDGES_SQL = (
    "SELECT user_id AS src, CAST(json_extract_string(props, '$.k') AS BIGINT) AS dst "
    "FROM events WHERE json_extract_string(props, '$.k') IS NOT NULL"
)
DANGLING_EDGES_SQL = (
    f"SELECT o_custkey AS src, l_suppkey + {SUPPLIER_OFFSET} AS dst "
    "FROM lineitem JOIN orders ON l_orderkey = o_orderkey"
)

ORACLE = {
    "dangling_vertices": f"WITH e AS ({DANGLING_EDGES_SQL}) "
    "SELECT vertex FROM (SELECT src AS vertex FROM e UNION SELECT dst FROM e) "
    "WHERE vertex NOT IN (SELECT src FROM e)",
    "page_rank_events": page_rank_sql(EVENTS_EDGES_SQL) + "SELECT vertex, rank FROM ranks",
    "page_rank_dangling": page_rank_sql(DANGLING_EDGES_SQL) + "SELECT vertex, rank FROM ranks",
    "vertex_rank": page_rank_sql(EVENTS_EDGES_SQL) + "SELECT vertex, rank FROM ranks WHERE vertex = 2",
    "max_rank_vertex": page_rank_sql(EVENTS_EDGES_SQL)
    + "SELECT vertex, rank FROM ranks WHERE rank = (SELECT max(rank) FROM ranks)",
    "vertex_labels": page_rank_sql(DANGLING_EDGES_SQL)
    + "SELECT c_custkey AS vertex, c_name AS person, r.rank FROM customer"
    " JOIN ranks r ON r.vertex = c_custkey",
}

# Same presentation rounding as the Spark side (see plans.common.round_half_away).
ORACLE = {k: two_step_round(v) for k, v in ORACLE.items()}
