"""Exact top-k inner-product search by multi-resolution segment statistics.

For vectors cut into equal segments, the inner product of two segments is at most
``n * mean_q * mean_x + n * dev_q * dev_x`` (the squared distance is at least
``n * ((mean_q - mean_x)**2 + (dev_q - dev_x)**2)``; with both norms known the two
bounds are the same statement). Summed over 1, 4, 16, ... segments this gives ever
tighter upper bounds of the score. Both sides are first turned by one orthogonal matrix (which
keeps inner products), fitted on a bounded sample so that the first segments hold most of the
length. Candidates come in chunks; those whose bound is not above any query's k-th best score so far
are dropped level by level, coarse to fine; survivors get exact integer scores by a matrix product
of the vectors as they were.

The query set is cut into blocks; every task compares one block of candidates with one
block of queries, and keeps k rows per query. Blocks are dealt over a grid of
(candidate block, query block), so no task and no driver holds a table whole.

Results for odd input: vectors that are null or hold null or non-finite components (or such that
are not finite when scaled) take no part, as queries and as candidates; vectors of different
length are never compared; ties go to the smaller id; rows that repeat an id are queries and candidates
each: every query row is answered, and only its own row is not among its candidates. Scores are exact
for any size of the components, and cut off at the ends of 64 bits.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import hash_sample, materialize

CANDIDATE_BLOCK = 8192
#: Candidates compared before the bars are set anew.
CHUNK = 1024
QUERY_BLOCK = 1024
#: Largest sum of products that doubles add exactly.
EXACT = 2.0**53
SLACK = 1e-9


def quantise(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", scale: int = 256) -> DataFrame:
    """``id, v`` (floor(scale * x) of each component, as double) of the valid vectors."""
    v = F.col(vec_col)
    ok = v.isNotNull() & F.col(id_col).isNotNull() & F.forall(
        v, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double") * scale) < F.lit(float("inf")))
    )
    # a double of 2**53 or more is an integer already (and floor gives 64-bit integers)
    def whole(x):
        y = x.cast("double") * scale
        return F.when(F.abs(y) < EXACT, F.floor(y).cast("double")).otherwise(y)

    return vectors.filter(ok).select(F.col(id_col).cast("bigint").alias("id"), F.transform(v, whole).alias("v"))


def levels(dim: int) -> list[int]:
    """Segment counts from coarse to fine."""
    return [s for s in (1, 4, 16) if s < dim and dim % s == 0]


def segment_features(x: np.ndarray, segments: int) -> np.ndarray:
    """Rows whose dot product bounds the inner product of the vectors from above: the
    scaled segment means, and the scaled deviations."""
    parts = x.reshape(len(x), segments, -1)
    n = parts.shape[2]
    mean = parts.mean(axis=2)
    dev = np.sqrt(np.maximum(0, (parts**2).mean(axis=2) - mean**2))
    return np.concatenate([mean, dev], axis=1) * np.sqrt(n)


def exact_scores(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Integer inner products, row by row."""
    if q.size and np.abs(q).max() * np.abs(x).max() * q.shape[1] < EXACT:
        return np.einsum("ij,ij->i", q, x).astype(np.int64)
    return np.array([clipped(sum(int(a) * int(b) for a, b in zip(r, s))) for r, s in zip(q, x)], np.int64)


def clipped(score: int) -> int:
    return max(-(2**63), min(2**63 - 1, score))


def turning(sample: np.ndarray) -> np.ndarray:
    """Orthogonal matrix that moves the sample's length to the first components."""
    scale = np.abs(sample).max(initial=0) or 1.0
    return np.linalg.eigh((sample / scale).T @ (sample / scale))[1][:, ::-1].copy()


def best_of_block(q: np.ndarray, x: np.ndarray, own: np.ndarray, k: int, turn: np.ndarray | None = None, seen: list | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``query, candidate, score``: places in ``q`` and ``x`` of each query's k best, equal scores by place.
    ``own[i]`` is the candidate that query ``i`` is itself (-1: none). ``seen`` gets the shares of (query, candidate)
    pairs left after each level of every chunk but the first."""
    d = q.shape[1]
    if not len(x) or not len(q) or np.abs(q).max(initial=0) * np.abs(x).max(initial=0) * d >= EXACT:
        rows = []
        for i in range(len(q)):
            score = exact_scores(np.broadcast_to(q[i], x.shape), x)
            order = np.argsort(-score.astype(object), kind="stable")
            order = order[order != own[i]][:k]
            rows += [(i, j, score[j]) for j in order]
        return tuple(np.array(c, np.int64) for c in zip(*rows)) if rows else (np.zeros(0, np.int64),) * 3
    qt, xt = (q @ turn, x @ turn) if turn is not None else (q, x)
    steps = [(segment_features(qt, s), segment_features(xt, s)) for s in levels(d)]
    slack = SLACK * (1 + np.linalg.norm(q, axis=1) * np.linalg.norm(x, axis=1).max())[:, None]
    row, at, score = (np.zeros(0, np.int64) for _ in range(3))
    bar = np.full(len(q), -np.inf)
    for start in range(0, len(x), CHUNK):
        cols = np.arange(start, min(start + CHUNK, len(x)))
        if start:
            shares = []
            for fq, fx in steps:
                alive = fq @ fx[cols].T + slack > bar[:, None]
                shares.append(alive.mean() * len(cols) / min(CHUNK, len(x) - start) if len(cols) else 0.0)
                cols = cols[alive.any(axis=0)]
            if seen is not None:
                seen.append(shares)
        exact = q @ x[cols].T
        mine = np.searchsorted(cols, own)
        hit = np.flatnonzero((mine < len(cols)) & (own >= 0))
        hit = hit[cols[mine[hit]] == own[hit]]
        exact[hit, mine[hit]] = -np.inf
        i, j = np.nonzero(exact > bar[:, None])  # an equal score loses to the earlier place
        row, at, score = np.concatenate([row, i]), np.concatenate([at, cols[j]]), np.concatenate([score, exact[i, j].astype(np.int64)])
        order = np.lexsort((at, -score, row))
        row, at, score = row[order], at[order], score[order]
        nth = np.arange(len(row)) - np.searchsorted(row, row)
        row, at, score = row[nth < k], at[nth < k], score[nth < k]
        last = nth[nth < k] == k - 1
        bar[row[last]] = score[last]
    return row, at, score


def search_block(q_id: np.ndarray, q: np.ndarray, x_id: np.ndarray, x: np.ndarray, k: int):
    """Each query's k best of a candidate block, as arrays (query, id, score); ids tell rows apart."""
    order = np.argsort(x_id, kind="stable")
    x_id, x = x_id[order], x[order]
    own = np.searchsorted(x_id, q_id)
    own = np.where((own < len(x_id)) & (x_id[np.minimum(own, len(x_id) - 1)] == q_id), own, -1) if len(x_id) else np.full(len(q_id), -1)
    row, at, score = best_of_block(q, x, own, k)
    return [q_id[row], x_id[at], score]


def _search(q: pd.DataFrame, x: pd.DataFrame, k: int, turns: dict[int, np.ndarray]) -> pd.DataFrame:
    found = []
    if len(q) and len(x):
        q_dim, x_dim = q["v"].map(len).to_numpy(), x["v"].map(len).to_numpy()
        for dim in np.intersect1d(q_dim, x_dim):
            a, b = q[q_dim == dim], x[x_dim == dim].sort_values(["id", "row"], kind="stable")
            stack = lambda c: np.stack(c.to_list()) if dim else np.zeros((len(c), 0))
            place = pd.Series(np.arange(len(b)), b["row"].to_numpy())
            own = place.reindex(a["row"].to_numpy()).fillna(-1).to_numpy(np.int64)
            vectors = stack(b["v"])
            for at in range(0, len(a), 256):
                part = a.iloc[at : at + 256]
                row, spot, score = best_of_block(stack(part["v"]), vectors, own[at : at + 256], k, turns.get(int(dim)))
                found.append((part["row"].to_numpy()[row], part["id"].to_numpy()[row], b["id"].to_numpy()[spot], b["row"].to_numpy()[spot], score))
    cols = [np.concatenate(c) for c in zip(*found)] if found else [np.zeros(0, np.int64)] * 5
    return pd.DataFrame(dict(zip(("query", "query_id", "vec_id", "vec", "score"), cols)))


def top_k(vectors: DataFrame, queries: Column | DataFrame, k: int = 5, sample_rows: int = 4096, sample_dim: int = 1024) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k best candidates among ``vectors`` (``id, v`` as from
    :func:`quantise`) of every row for which the condition ``queries`` holds, or of the rows of a table
    ``queries`` (a row that is among ``vectors`` too is found there, once for every copy). The turning matrices are fitted on at most
    ``sample_rows`` vectors of at most ``sample_dim`` components; longer ones are compared unturned."""
    held = materialize(vectors.select("id", "v").withColumn("row", F.monotonically_increasing_id()), "vectors")
    if isinstance(queries, DataFrame):
        own = held.select(F.col("id").alias("o_id"), F.col("v").alias("o_v"), "row")
        asked = queries.select("id", "v").distinct().join(own, (F.col("id") == F.col("o_id")) & (F.col("v") == F.col("o_v")), "left")
        asked = materialize(asked.select("id", "v", F.coalesce("row", -1 - F.monotonically_increasing_id()).alias("row")), "queries")
    else:
        asked = held.filter(queries)
    sample: dict[int, list] = {}
    for r in hash_sample(held.filter(F.size("v").between(1, sample_dim)).select("id", "row", "v"), sample_rows, "id", "row").collect():
        sample.setdefault(len(r["v"]), []).append(r["v"])
    turns = held.sparkSession.sparkContext.broadcast({d: turning(np.array(v, float)) for d, v in sample.items()})
    n, m = held.count(), asked.count()
    rows, cols = max(1, -(-n // CANDIDATE_BLOCK)), max(1, -(-m // QUERY_BLOCK))
    # every candidate goes to one row of the grid, every query to one column
    x = held.withColumn("r", F.pmod(F.xxhash64("row", F.lit(1)), F.lit(rows))).withColumn(
        "c", F.explode(F.sequence(F.lit(0), F.lit(cols - 1)))
    )
    q = asked.withColumn("c", F.pmod(F.xxhash64("row", F.lit(2)), F.lit(cols))).withColumn(
        "r", F.explode(F.sequence(F.lit(0), F.lit(rows - 1)))
    )
    typed = lambda d: d.select(F.col("r").cast("bigint").alias("r"), F.col("c").cast("bigint").alias("c"), "id", "row", "v")
    found = typed(q).groupBy("r", "c").cogroup(typed(x).groupBy("r", "c")).applyInPandas(
        lambda a, b: _search(a, b, k, turns.value), "query bigint, query_id bigint, vec_id bigint, vec bigint, score bigint"
    )
    rank = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "vec_id", "vec"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k).select(
        "query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"
    )
