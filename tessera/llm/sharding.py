"""Sharding by a minimax contiguous partition.

Documents are ordered by a hash of their text; the atomic groups are the cells of that
hash range (a fixed number, so their sizes fit on the driver at any corpus size), and a
cell holds all documents of each text in it. A binary search finds the smallest capacity
with which a greedy left-to-right filling needs no more than the wanted shards; a cell
that alone exceeds the capacity of the others (one text with a third of all rows) gets a
shard of its own and the rest is levelled without it. Shards are cut there.

Results for odd input: a null text counts as empty (0 bytes); equal texts always share a
shard; repeated rows each get a slot; with fewer cells than shards some shards are
empty; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Cells of the hash range; their sizes are the only thing the driver holds.
CELL_BITS = 18
ROW_BYTES = 16
#: Rows of one cell that a single task numbers, about.
NUMBERED_TOGETHER = 20_000


def greedy(prefix: np.ndarray, capacity: int, shards: int) -> list[int] | None:
    """Ends of the shards when each is filled up to ``capacity`` (a single larger group
    stands alone); None if they are too many. ``prefix[i]`` sums the first i groups."""
    ends, at, n = [], 0, len(prefix) - 1
    while at < n:
        if len(ends) == shards:
            return None
        to = int(np.searchsorted(prefix, prefix[at] + capacity, side="right")) - 1
        at = max(to, at + 1)
        ends.append(at)
    return ends


def smallest_capacity(sizes: np.ndarray, shards: int) -> tuple[int, list[int]]:
    """Least capacity (for groups that fit it) whose greedy filling needs at most
    ``shards`` shards, and the ends of its shards."""
    prefix = np.concatenate([[0], np.cumsum(sizes)])
    lo, hi = 0, int(prefix[-1])
    while lo < hi:
        mid = (lo + hi) // 2
        if greedy(prefix, mid, shards) is None:
            lo = mid + 1
        else:
            hi = mid
    return lo, greedy(prefix, lo, shards) or []


def level(sizes: np.ndarray, shards: int) -> list[int]:
    """Ends of the shards: no shard holds more than :func:`smallest_capacity` allows, and
    within that each cut is the one nearest to an even share of what is left."""
    capacity, ends = smallest_capacity(sizes, shards)
    prefix = np.concatenate([[0], np.cumsum(sizes)])
    light = np.concatenate([[0], np.cumsum(np.where(sizes > capacity, 0, sizes))])
    alone = np.concatenate([[0], np.cumsum(sizes > capacity)])
    cuts, at, n = [], 0, len(sizes)
    while at < n:
        left = shards - len(cuts)
        most = max(int(np.searchsorted(prefix, prefix[at] + capacity, side="right")) - 1, at + 1)
        share = (light[n] - light[at]) / max(1, left - (alone[n] - alone[at]))
        near = int(np.searchsorted(prefix, prefix[at] + share))
        if near - 1 > at and prefix[near] - prefix[at] - share > share - (prefix[near - 1] - prefix[at]):
            near -= 1
        near = min(max(near, at + 1), most)
        while near < most and greedy(prefix[near:], capacity, left - 1) is None:
            near = min(most, near + max(1, (most - near) // 2))
        at = near
        cuts.append(at)
    return cuts


def assign(docs: DataFrame, shards: int = 40, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, size, text_crc32, cell, shard, slot`` of every row."""
    spark = docs.sparkSession
    raw = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        (F.octet_length(raw) + ROW_BYTES).cast("bigint").alias("size"),
        F.crc32(raw).alias("text_crc32"),
        F.xxhash64(raw).alias("h"),
    ).withColumn("cell", F.shiftrightunsigned("h", 64 - CELL_BITS).cast("int"))
    cells = rows.groupBy("cell").agg(F.sum("size").alias("bytes"), F.count("*").alias("n")).toPandas()  # at most 2**CELL_BITS
    cells = cells.sort_values("cell").reset_index(drop=True)
    ends = level(cells["bytes"].to_numpy(np.int64), shards)
    counts = cells["n"].to_numpy(np.int64)
    shard = np.searchsorted(np.array(ends, np.int64), np.arange(len(cells)), side="right")
    before = np.concatenate([[0], np.cumsum(counts)])[:-1]
    first = before - before[np.searchsorted(shard, shard, side="left")] if len(cells) else before
    table = spark.createDataFrame(
        pa.table({
            "c_cell": pa.array(cells["cell"].to_numpy(np.int32)), "shard": pa.array(shard.astype(np.int32)),
            "first": pa.array(first.astype(np.int64)), "salts": pa.array(-(-counts // NUMBERED_TOGETHER)),
        })
    )
    placed = rows.join(F.broadcast(table), F.col("cell") == F.col("c_cell")).withColumn(
        "salt", F.pmod(F.xxhash64("doc_id"), F.col("salts"))
    )
    hot = placed.filter("salts > 1").groupBy("cell", "salt").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("cell").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    base = hot.select(
        F.col("cell").alias("b_cell"), F.col("salt").alias("b_salt"), F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base")
    )
    within = Window.partitionBy("cell", "salt").orderBy("h", "doc_id")
    numbered = placed.withColumn("rn", F.row_number().over(within)).join(
        base, (F.col("cell") == F.col("b_cell")) & (F.col("salt") == F.col("b_salt")), "left"
    )
    slot = F.col("first") + F.coalesce("base", F.lit(0)) + F.col("rn") - 1
    return numbered.select("doc_id", "size", "text_crc32", "cell", "shard", slot.cast("bigint").alias("slot"))
