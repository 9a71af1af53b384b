"""Best-fit packing planned on the length histogram.

1. Every document becomes token pieces of at most ``capacity`` tokens (only longer
   documents are cut); the small piece rows are written to the shared folder.
2. The histogram of piece lengths has at most ``capacity`` rows whatever the corpus
   size. Best-fit decreasing runs over its counts: equal open sequences form one group
   with a count, so placing a million equal pieces is one step.
3. Pieces get a rank within their length and take the planned slot of that rank.
   Ranks of a frequent length are dealt over salted sub-groups whose sizes are summed
   first, so no task ranks a third of the rows.

Results for odd input: a null or empty text is the separator alone (one piece of length
1); repeated rows, also with equal ids, are packed each; an empty table gives no rows;
other columns are not read.
"""

from __future__ import annotations

import zlib
from array import array
from bisect import bisect_left, insort

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm import bpe
from tessera.llm.common import materialize, small_batches

#: Pieces of one length that a single task ranks, about.
RANKED_TOGETHER = 20_000
#: Rows of the plan up to which it is broadcast; a longer one is joined by shuffle.
PLAN_BROADCAST_ROWS = 200_000


def token_pieces(
    docs: DataFrame, tokenizer_path: str, capacity: int = 2048, separator: int = 0,
    id_col: str = "doc_id", text_col: str = "text", cache_bytes: int = bpe.PIECE_CACHE_BYTES,
) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32`` of every document's ids and its
    closing ``separator``, cut every ``capacity`` tokens. ``cache_bytes`` bounds the encoder's cache
    of a worker (less memory, more time)."""
    spec = docs.sparkSession.sparkContext.broadcast(bpe.read_spec(tokenizer_path))
    step = 4 * capacity

    def run(batches):
        encoder = bpe.encoder_of(spec.value, cache_bytes)
        tail = array("I", [separator]).tobytes()
        for batch in batches:
            source, pieces, starts, lengths, crcs = [], [], [], [], []
            for row, text in enumerate(batch.column(1)):
                held, piece = b"", 0
                for ids in encoder.encode(text.as_py()):
                    held += ids
                    while len(held) > step:  # a full piece before the last one
                        source.append(row)
                        pieces.append(piece)
                        lengths.append(capacity)
                        crcs.append(zlib.crc32(held[:step]))
                        piece, held = piece + 1, held[step:]
                held += tail
                for at in range(0, len(held), step):
                    part = held[at : at + step]
                    source.append(row)
                    pieces.append(piece)
                    lengths.append(len(part) // 4)
                    crcs.append(zlib.crc32(part))
                    piece += 1
            starts = [p * capacity for p in pieces]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(source, pa.int64())), pa.array(pieces, pa.int32()), pa.array(starts, pa.int64()),
                 pa.array(lengths, pa.int64()), pa.array(crcs, pa.int64())],
                names=["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).transform(small_batches).mapInArrow(
        run, f"doc_id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint"
    )


def plan_best_fit(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int, int]]:
    """Best-fit decreasing over ``{length: count}``.

    Returns runs ``(length, rank_lo, rank_hi, first_sequence, per_sequence, offset)``:
    the pieces of that length with rank in [lo, hi) fill sequences from
    ``first_sequence`` on, ``per_sequence`` pieces each, from ``offset`` on.
    Open sequences are kept as groups (first id, how many) by free space; a group is
    split at most once per length, so there are at most a few groups per length.
    """
    runs = []
    free: list[int] = []  # free spaces that occur, ascending
    groups: dict[int, list[tuple[int, int]]] = {}
    made = 0

    def put(space: int, first: int, many: int) -> None:
        if many and space:
            if space not in groups:
                groups[space] = []
                insort(free, space)
            groups[space].append((first, many))

    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]
        while left:
            at = bisect_left(free, length)
            if at == len(free):  # nothing fits: open new sequences
                each = capacity // length
                first, many, space = made, -(-left // each), capacity
                made += many
            else:
                space = free[at]
                first, many = groups[space].pop()
                if not groups[space]:
                    del groups[space], free[at]
                each = space // length
            full = min(many, left // each)
            rest = left - full * each if full < many else 0
            if full:
                runs.append((length, rank, rank + full * each, first, each, capacity - space))
                put(space - each * length, first, full)
            if rest:
                runs.append((length, rank + full * each, rank + full * each + rest, first + full, rest, capacity - space))
                put(space - rest * length, first + full, 1)
            put(space, first + full + bool(rest), many - full - bool(rest))
            rank += full * each + rest
            left -= full * each + rest
    return runs


def assign(pieces: DataFrame, capacity: int = 2048) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to a written table of pieces."""
    spark = pieces.sparkSession
    counts = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}  # at most `capacity` rows
    runs = plan_best_fit(counts, capacity)
    salts = spark.createDataFrame(
        [(n, max(1, -(-c // RANKED_TOGETHER))) for n, c in counts.items()] or [], "s_length bigint, salts bigint"
    )
    plan = spark.createDataFrame(
        runs, "p_length bigint, lo bigint, hi bigint, first bigint, per bigint, at bigint"
    )
    salted = (
        pieces.join(F.broadcast(salts), pieces["length"] == salts["s_length"])
        .withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.col("salts")))
        .drop("s_length", "salts")
    )
    before = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    base = (
        salted.groupBy("length", "salt").agg(F.count("*").alias("n"))
        .select(F.col("length").alias("b_length"), F.col("salt").alias("b_salt"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    )
    within = Window.partitionBy("length", "salt").orderBy("doc_id", "piece", "ids_crc32")
    ranked = (
        salted.withColumn("rn", F.row_number().over(within))
        .join(base, (F.col("length") == F.col("b_length")) & (F.col("salt") == F.col("b_salt")))
        .withColumn("rank", F.col("base") + F.col("rn") - 1)
    )
    if len(runs) <= PLAN_BROADCAST_ROWS:
        plan = F.broadcast(plan)
    placed = ranked.join(
        plan, (F.col("length") == F.col("p_length")) & (F.col("rank") >= F.col("lo")) & (F.col("rank") < F.col("hi"))
    )
    nth = F.col("rank") - F.col("lo")
    return placed.select(
        "doc_id", "piece", "start", "length", "ids_crc32",
        (F.col("first") + F.floor(nth / F.col("per"))).cast("bigint").alias("sequence_id"),
        (F.col("at") + (nth % F.col("per")) * F.col("length")).cast("bigint").alias("offset"),
    )


def pack(
    docs: DataFrame, tokenizer_path: str, capacity: int = 2048, id_col: str = "doc_id", text_col: str = "text", cache_bytes: int = bpe.PIECE_CACHE_BYTES
) -> DataFrame:
    """Pack all documents: one row per piece with its sequence and offset."""
    return assign(materialize(token_pieces(docs, tokenizer_path, capacity, 0, id_col, text_col, cache_bytes), "pieces"), capacity)
