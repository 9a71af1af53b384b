import os

import pytest

from tessera.operators import graph as G
from tessera.sinks import writers
from tessera.sources import text as T

# The published four-vertex example and its ranks.
GOLDEN_EDGES = [(0, 2), (2, 0), (1, 2), (1, 3), (3, 2)]
GOLDEN_RANKS = {0: 0.4605615869850827, 1: 0.0375, 2: 0.44850091301491685, 3: 0.0534375}


def brute_force(edges, k=10):
    """Dense form: dangling vertices get an explicit edge to every vertex."""
    verts = sorted({v for e in edges for v in e})
    srcs = {s for s, _ in edges}
    full = list(edges) + [(d, v) for d in verts if d not in srcs for v in verts]
    deg = {}
    for s, _ in full:
        deg[s] = deg.get(s, 0) + 1
    r = {v: 1.0 for v in verts}
    for _ in range(k):
        inflow = {}
        for s, d in full:
            inflow[d] = inflow.get(d, 0.0) + r[s] / deg[s]
        r = {v: 0.15 + 0.85 * inflow[v] if v in inflow else 0.15 for v in verts}
    return {v: x / len(verts) for v, x in r.items()}


def _ranks(df):
    return {r.vertex: r.rank for r in df.collect()}


def test_golden_graph(spark):
    edges = spark.createDataFrame(GOLDEN_EDGES, "src long, dst long")
    got = _ranks(G.page_rank(edges))
    assert got.keys() == GOLDEN_RANKS.keys()
    for v, x in GOLDEN_RANKS.items():
        assert got[v] == pytest.approx(x, abs=1e-12)


def test_dangling_repeated_edge_self_loop(spark):
    edges = [(0, 1), (0, 1), (1, 2), (2, 2), (2, 0), (3, 4), (1, 5), (6, 0)]
    df = spark.createDataFrame(edges, "src long, dst long")
    got = _ranks(G.page_rank(df))
    want = brute_force(edges)
    for v, x in want.items():
        assert got[v] == pytest.approx(x, abs=1e-12)
    assert sum(got.values()) == pytest.approx(sum(want.values()), abs=1e-12)


def test_hub_path_equals_plain_path(spark):
    edges = [(0, i) for i in range(1, 30)] + [(i, 0) for i in range(1, 10)] + [(5, 7), (7, 8)]
    df = spark.createDataFrame(edges, "src long, dst long")
    plain = _ranks(G.page_rank(df))
    hubbed = _ranks(G.page_rank(df, hub_degree=2, max_broadcast_hubs=1_000_000))
    want = brute_force(edges)
    for v, x in want.items():
        assert plain[v] == pytest.approx(x, abs=1e-12)
        assert hubbed[v] == pytest.approx(x, abs=1e-12)


def test_rank_queries_and_text_round_trip(spark, tmp_dir):
    edges_path = os.path.join(tmp_dir, "edges.txt")
    with open(edges_path, "w") as f:
        f.write("\n".join(f"{a} {b}" for a, b in GOLDEN_EDGES))
    ranks = G.page_rank(T.read_edges(spark, edges_path))
    out = os.path.join(tmp_dir, "ranks")
    writers.write_lines(ranks.orderBy("vertex"), ["vertex", "rank"], out)
    back = T.read_ranks(spark, out)
    assert {r.vertex: r.rank for r in back.collect()} == pytest.approx(GOLDEN_RANKS, abs=1e-12)

    (row,) = G.rank_of(back, 2).collect()
    assert row.vertex == 2 and row.rank == pytest.approx(GOLDEN_RANKS[2], abs=1e-12)
    top = G.max_rank(back).collect()
    assert [(r.vertex) for r in top] == [0]

    labels = spark.createDataFrame(
        [(0, "Adam"), (1, "Lisa"), (2, "Bert"), (3, "Ralph")], "vertex long, person string"
    )
    joined = sorted(tuple(r) for r in G.label_ranks(labels, back).collect())
    assert [(v, p) for v, p, _ in joined] == [(0, "Adam"), (1, "Lisa"), (2, "Bert"), (3, "Ralph")]


def test_wider_layout_for_large_graph(spark):
    edges = [(0, i) for i in range(1, 12)] + [(i, 0) for i in range(1, 8)] + [(3, 5), (5, 9)]
    df = spark.createDataFrame(edges, "src long, dst long")
    previous = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        got = _ranks(G.page_rank(df, edges_per_partition=1))  # 20 edges -> widened to 16
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", previous)
    for v, x in brute_force(edges).items():
        assert got[v] == pytest.approx(x, abs=1e-12)
