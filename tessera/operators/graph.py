"""PageRank over an edge list, and the rank queries.

Semantics (matching the reference):

* vertices are every id at either end of an edge; repeated edges count;
* every rank starts at 1.0 and ``r' = 0.15 + 0.85 * sum(r_u / deg_u)`` over the
  in-edges, a vertex with no in-edge getting 0.15;
* a dangling vertex (no out-edge) links to every vertex, itself included;
* after ``k`` iterations the ranks are divided by the vertex count.

Plan (per iteration, nothing collected):

* The dangling vertices' links are never materialised: their mass
  ``sum(r_d) / n`` is one global aggregate (a scalar subquery) added to every
  vertex.
* Edges are written once, hash-partitioned by source, with the vertex table
  partitioned the same way, so the rank-to-edge join needs no edge shuffle.
  Only the per-destination sum shuffles (with map-side partial sums).
* Hub split for skew: a source with more than ``hub_degree`` out-edges would
  make one task carry all of its edges. Such hubs are joined through a
  broadcast of their shares instead; there are at most ``|E| / hub_degree``
  of them, and ``hub_degree`` is raised so that this bound stays under
  ``max_broadcast_hubs`` rows - the broadcast size is bounded by construction.
* The vertex table is checkpointed to the cluster's checkpoint folder every
  ``checkpoint_every`` iterations, which cuts the lineage and survives lost
  executors.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.session import checkpoint_dir, checkpoint_keyed

BASE = 0.15
DAMPING = 0.85


def vertices(edges: DataFrame) -> DataFrame:
    """Distinct ids at either end of an edge, as column ``vertex``."""
    ends = edges.select(F.explode(F.array("src", "dst")).alias("vertex"))
    return ends.distinct()


def out_degrees(edges: DataFrame) -> DataFrame:
    """Out-degree per source (repeated edges count)."""
    return edges.groupBy("src").agg(F.count(F.lit(1)).alias("deg"))


def dangling_vertices(edges: DataFrame) -> DataFrame:
    """Vertices without an out-edge (all vertices minus the sources)."""
    sources = edges.select(F.col("src").alias("vertex"))
    return vertices(edges).join(sources, "vertex", "left_anti")


def page_rank(
    edges: DataFrame,
    iterations: int = 10,
    partitions: int | None = None,
    hub_degree: int = 100_000,
    max_broadcast_hubs: int = 100_000,
    checkpoint_every: int = 1,
    edges_per_partition: int = 2_000_000,
) -> DataFrame:
    """G1: ranks ``(vertex, rank)`` after ``iterations`` steps, normalised by n.

    The co-partitioned layout uses ``partitions`` hash partitions, by default one
    per ``edges_per_partition`` edges but at least one per core of the cluster,
    capped by ``spark.sql.shuffle.partitions`` (the iterations run with AQE off,
    so nothing would coalesce a too-wide layout for a small graph).
    """
    spark = edges.sparkSession
    checkpoint_dir(spark)
    e = edges.select(F.col("src").cast("long"), F.col("dst").cast("long"))
    widest = int(spark.conf.get("spark.sql.shuffle.partitions"))
    first = partitions or max(1, min(widest, spark.sparkContext.defaultParallelism))

    deg = out_degrees(e)
    table = checkpoint_keyed(
        vertices(e)
        .join(deg.withColumnRenamed("src", "vertex"), "vertex", "left")
        .withColumn("rank", F.lit(1.0)),
        first,
        "vertex",
    )
    n, n_edges = table.agg(F.count(F.lit(1)), F.coalesce(F.sum("deg"), F.lit(0))).first()
    if n == 0:
        return table.select("vertex", "rank")
    parts = partitions or max(first, min(widest, math.ceil(n_edges / edges_per_partition)))
    if parts != first:  # a large graph: widen the (small) vertex table to the edge layout
        table = checkpoint_keyed(table, parts, "vertex")

    # Hubs: bounded count, broadcast; the rest: co-partitioned with the vertices.
    threshold = max(hub_degree, math.ceil(n_edges / max_broadcast_hubs))
    hubs = table.filter(F.col("deg") > threshold).select(F.col("vertex").alias("hub"))
    has_hubs = hubs.limit(1).count() > 0
    if has_hubs:
        hubs = checkpoint_keyed(hubs, 1)
        tagged = e.join(F.broadcast(hubs), e.src == hubs.hub, "left")
        normal_edges = checkpoint_keyed(
            tagged.filter(F.col("hub").isNull()).select("src", "dst"), parts, "src"
        )
        hub_edges = checkpoint_keyed(tagged.filter(F.col("hub").isNotNull()).select("src", "dst"), parts)
    else:
        normal_edges = checkpoint_keyed(e, parts, "src")

    for step in range(1, iterations + 1):
        share = table.filter(F.col("deg").isNotNull()).select(
            F.col("vertex").alias("src"), (F.col("rank") / F.col("deg")).alias("share")
        )
        contrib = normal_edges.join(share, "src").select("dst", "share")
        if has_hubs:
            hub_share = share.join(F.broadcast(hubs), share.src == hubs.hub, "left_semi")
            contrib = contrib.unionByName(
                hub_edges.join(F.broadcast(hub_share), "src").select("dst", "share")
            )
        incoming = contrib.groupBy(F.col("dst").alias("vertex")).agg(F.sum("share").alias("inflow"))
        dmass = (
            table.filter(F.col("deg").isNull())
            .select(F.coalesce(F.sum("rank"), F.lit(0.0)) / F.lit(float(n)))
            .scalar()
        )
        table = table.join(incoming, "vertex", "left").select(
            "vertex",
            "deg",
            (
                F.lit(BASE) + F.lit(DAMPING) * (F.coalesce(F.col("inflow"), F.lit(0.0)) + dmass)
            ).alias("rank"),
        )
        if checkpoint_every and (step % checkpoint_every == 0 or step == iterations):
            table = checkpoint_keyed(table, parts)

    return table.select("vertex", (F.col("rank") / F.lit(float(n))).alias("rank"))


def rank_of(ranks: DataFrame, vertex: int) -> DataFrame:
    """The rank row of one vertex."""
    return ranks.filter(F.col("vertex") == F.lit(vertex)).select("vertex", "rank")


def max_rank(ranks: DataFrame) -> DataFrame:
    """Every vertex whose rank equals the maximum (ties all returned); the
    maximum is a scalar subquery, as in ``WHERE rank = (SELECT MAX(rank) ...)``."""
    top = ranks.select(F.max("rank")).scalar()
    return ranks.filter(F.col("rank") == top).select("vertex", "rank")


def label_ranks(labels: DataFrame, ranks: DataFrame) -> DataFrame:
    """``(vertex, person, rank)`` for labelled vertices with a rank."""
    return labels.select("vertex", "person").join(ranks.select("vertex", "rank"), "vertex")
