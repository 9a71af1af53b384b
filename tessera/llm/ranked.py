"""Ranked lexical search by NRA: no random access, impact-sorted sequential reads.

1. Documents are cut into blocks (rows of one task, bounded in bytes); of each block a row is
   written with its documents' ids and lengths and, per query term, the documents that
   hold it and how often. Counts over all documents (``N``, ``L``, ``df``) are sums over blocks.
2. With these counts every posting has an integer impact. In each block each term's list is
   sorted by impact, and the items are answered one after the other: lists are read from
   the top in ever larger strides. A document read in some lists has a lower bound (the
   impacts read) and an upper one (plus, for every list in which it has not come up, the
   next impact of that list). An item is done when no document that has not come up, and none
   whose score is still open, can reach the k-th best lower bound: then membership, ties
   and scores are final. A document without a term is settled only when that term's list has
   ended, so scores need no second look at any document.
3. A task keeps each item's k best, whose k-th score is the bar for its next blocks, and
   returns them; the best of all tasks are ranked by windows of a few rows a task.

Items are a query set in blocks: items with up to ``ITEM_BLOCK_BYTES`` of text (about) are searched together,
each such block in one pass over the documents. A task holds the postings of one block.

Results for odd input: null or empty texts and texts without a term have no terms and count
in neither ``N`` nor ``L``; items without a term have no rows; documents that repeat an id are
documents each; items that repeat an id are answered each (so ranks come again for that
id); a null doc_id ranks after the others of its score; other columns are not read.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import materialize, release, small_batches

#: Text of the items searched in one pass, about.
ITEM_BLOCK_BYTES = 16 << 20
#: Text and documents of one block, about.
BLOCK_BYTES, BLOCK_DOCS = 4 << 20, 16_384
#: First read of every list; later reads are four times longer each.
STRIDE = 128
#: Sub-groups of tasks among which an item's rows are ranked first.
SALTS = 64
#: ASCII letters (lower-cased) and digits, and all other characters, make terms.
FOLD = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))


def terms_of(raw: bytes | None) -> list[bytes]:
    """All terms of a UTF-8 text, in order."""
    return (raw or b"").translate(FOLD).split()


def _raw(column: pa.Array) -> list[bytes | None]:
    return column.cast(pa.binary()).to_pylist()


class Block:
    """Postings of some documents on the terms of a vocabulary."""

    def __init__(self, vocabulary: dict[bytes, int]):
        self.number = vocabulary
        self.rows: list[pa.Array] = []
        self.lengths: list[int] = []
        self.keys: list[np.ndarray] = []
        self.bytes = self.held = self.terms = 0

    def add(self, doc_id: pa.Array, raw: bytes | None) -> None:
        words = terms_of(raw)
        if not words:
            return
        self.held += 1
        self.terms += len(words)
        self.bytes += len(raw)
        get = self.number.get
        ids = np.fromiter((i for i in map(get, words) if i is not None), np.int64)
        if len(ids):
            self.keys.append(ids << 32 | len(self.lengths))
            self.rows.append(doc_id)
            self.lengths.append(len(words))

    def full(self) -> bool:
        return self.bytes >= BLOCK_BYTES or len(self.lengths) >= BLOCK_DOCS

    def record(self, kind: pa.DataType) -> pa.RecordBatch:
        key, tf = np.unique(np.concatenate(self.keys) if self.keys else np.zeros(0, np.int64), return_counts=True)
        term, df = np.unique(key >> 32, return_counts=True)
        ids = pa.concat_arrays(self.rows) if self.rows else pa.array([], kind)
        cols = [
            pa.array([self.held], pa.int64()), pa.array([self.terms], pa.int64()), pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids),
            pa.array([self.lengths], pa.list_(pa.int64())), pa.array([term.tolist()], pa.list_(pa.int32())), pa.array([df.tolist()], pa.list_(pa.int32())),
            pa.array([(key & 0xFFFFFFFF).astype(np.uint32).tobytes()], pa.binary()), pa.array([tf.astype(np.uint32).tobytes()], pa.binary()),
        ]
        return pa.RecordBatch.from_arrays(cols, names=["held", "n_terms", "ids", "lengths", "terms", "df", "docs", "tf"])


def index(docs: DataFrame, vocabulary: dict[bytes, int], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per block of documents (see :class:`Block`)."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches):
        release()
        block = Block(shared.value)
        kind = None
        for batch in batches:
            kind = batch.schema[0].type
            for i, raw in enumerate(_raw(batch.column(1))):
                block.add(batch.column(0).slice(i, 1), raw)
                if block.full():
                    yield block.record(kind)
                    block = Block(shared.value)
        if block.held:
            yield block.record(kind)

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).transform(small_batches).mapInArrow(
        run, f"held bigint, n_terms bigint, ids array<{kind}>, lengths array<bigint>, terms array<int>, df array<int>, docs binary, tf binary"
    )


def weights(n: int, df: np.ndarray) -> np.ndarray:
    return np.floor(1000 * np.log((2.0 * n + 2) / (2.0 * df + 1))).astype(np.int64)


def shares(tf: np.ndarray, length: np.ndarray, n: int, total: int) -> np.ndarray:
    """What a term's weight is multiplied by, for each posting."""
    m = 25 + 75 * length * n // max(1, total)
    return 1_000_000_000 * tf // (1000 * tf + 8 * m)


def nra(lists: list[tuple[np.ndarray, np.ndarray]], n_docs: int, k: int, bar: int) -> tuple[np.ndarray, np.ndarray]:
    """Documents that can be among the k best (all with the final k-th score included), and their
    scores. ``lists`` are (document, impact), highest impact first; scores below ``bar`` are of no use."""
    lower, depth, read = np.zeros(n_docs, np.int64), STRIDE, 0
    while True:
        for at, impact in lists:
            lower[at[read:depth]] += impact[read:depth]
        next_ = [int(impact[depth]) if depth < len(impact) else 0 for _, impact in lists]
        unseen = sum(next_)  # the most that a document not read yet can score
        known = np.flatnonzero(lower)
        least = max(bar, int(np.partition(lower[known], -k)[-k])) if len(known) >= k else bar
        upper = lower[known] + unseen
        if unseen:
            less = np.zeros(n_docs, np.int64)
            for (at, _), step in zip(lists, next_):
                less[at[:depth]] += step
            upper -= less[known]
        alive = known[upper >= least]
        # of equal score the smaller id wins, so whoever could draw level must be known
        if not unseen or (unseen < least and (upper[upper >= least] == lower[alive]).all()):
            return alive, lower[alive]
        read, depth = depth, 4 * depth


class Best:
    """The k best rows of each item so far: score, then id (null last)."""

    def __init__(self, k: int):
        self.k = k
        self.rows: dict[int, list] = {}
        self.bars: dict[int, int] = {}

    def bar(self, item: int) -> int:
        return self.bars.get(item, 1)

    def add(self, item: int, found: list[tuple[int, object]]) -> None:
        rows = self.rows.get(item, []) + found
        rows = sorted((r for r in rows if r[1] is not None), key=lambda r: (-r[0], r[1])) + sorted((r for r in rows if r[1] is None), key=lambda r: -r[0])
        self.rows[item] = rows = sorted(rows, key=lambda r: -r[0])[: self.k]  # stable: nulls stay last
        if len(rows) == self.k:
            self.bars[item] = rows[-1][0]


def search_block(best: Best, items: list[list[tuple[int, int]]], weight: np.ndarray, n: int, total: int, row: dict) -> None:
    """Answers every item (terms with repeats) on one block of the index."""
    lengths = np.array(row["lengths"].values, np.int64)
    docs, tf = (np.frombuffer(row[c].as_py(), np.uint32).astype(np.int64) for c in ("docs", "tf"))
    terms, df = np.array(row["terms"].values, np.int64), np.array(row["df"].values, np.int64)
    share = shares(tf, lengths[docs], n, total)
    order = np.lexsort((-share, np.repeat(np.arange(len(terms)), df)))
    docs, share = docs[order], share[order]
    cut = np.concatenate([[0], np.cumsum(df)])
    spot = {t: i for i, t in enumerate(terms.tolist())}
    ids = row["ids"].values
    place = np.empty(len(ids), np.int64)  # of each document in the order of ids, nulls last
    place[pc.sort_indices(ids, null_placement="at_end").to_numpy()] = np.arange(len(ids))
    for number, item in enumerate(items):
        lists = []
        for t, repeats in item:
            i = spot.get(t)
            if i is not None and weight[t]:
                part = slice(cut[i], cut[i + 1])
                lists.append((docs[part], share[part] * (int(weight[t]) * repeats)))
        if not lists:
            continue
        at, score = nra(lists, len(lengths), best.k, best.bar(number))
        first = np.lexsort((place[at], -score))[: best.k]
        if len(first):
            best.add(number, [(int(score[j]), ids[int(at[j])].as_py()) for j in first])


def search(blocks: DataFrame, items: list[list[tuple[int, int]]], weight: np.ndarray, n: int, total: int, k: int) -> DataFrame:
    """``item`` (its number), ``doc_id, score``: each task's k best of every item."""
    shared = blocks.sparkSession.sparkContext.broadcast((items, weight))
    kind = blocks.schema["ids"].dataType.elementType.simpleString()

    def run(batches):
        release()
        queries, weight = shared.value
        best, id_kind = Best(k), None
        for batch in batches:
            id_kind = batch.schema.field("ids").type.value_type
            for r in range(batch.num_rows):
                search_block(best, queries, weight, n, total, {c: batch.column(c)[r] for c in batch.schema.names})
        rows = [(i, d, s) for i, found in best.rows.items() for s, d in found]
        for at in range(0, len(rows), 10_000):
            part = list(zip(*rows[at : at + 10_000]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(part[0], pa.int32()), pa.array(part[1], id_kind), pa.array(part[2], pa.int64())], names=["item", "doc_id", "score"]
            )

    return blocks.transform(small_batches).mapInArrow(run, f"item int, doc_id {kind}, score bigint")


def rank(
    docs: DataFrame, items: DataFrame, k: int = 10, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text"
) -> DataFrame:
    """``item_id, rank, doc_id, score``: the k best documents of every item."""
    spark = docs.sparkSession
    asked = items.select(F.col(item_col).alias("item_id"), F.col(item_text_col).alias("text")).filter(F.col("text").isNotNull())
    asked = materialize(asked.withColumn("row", F.monotonically_increasing_id()), "items")
    parts = max(1, -(-(asked.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // ITEM_BLOCK_BYTES))
    out = []
    for part in range(parts):
        mine = asked.filter(F.pmod(F.xxhash64("row"), F.lit(parts)) == part) if parts > 1 else asked
        rows = mine.orderBy("row").collect()  # a block of items, bounded by its share of the bytes
        counted = [Counter(terms_of(r["text"].encode())) for r in rows]
        vocabulary: dict[bytes, int] = {}
        for c in counted:
            for t in c:
                vocabulary.setdefault(t, len(vocabulary))
        blocks = materialize(index(docs, vocabulary, id_col, text_col), "postings", row_group_bytes=16 << 20)
        sums = blocks.agg(F.sum("held").alias("n"), F.sum("n_terms").alias("total")).first()
        n, total = sums["n"] or 0, sums["total"] or 0
        df = np.zeros(len(vocabulary), np.int64)
        each = blocks.select(F.explode(F.arrays_zip("terms", "df")).alias("t")).groupBy("t.terms").agg(F.sum("t.df").alias("df"))
        for t, many in each.toArrow().to_pandas().itertuples(index=False):  # a row per term of the items
            df[t] = many
        queries = [[(vocabulary[t], c) for t, c in counts.items()] for counts in counted]
        found = search(blocks, queries, weights(n, df), n, total, k)
        order = [F.desc("score"), F.asc_nulls_last("doc_id")]
        few = found.withColumn("salt", F.spark_partition_id() % SALTS)
        few = few.withColumn("r", F.row_number().over(Window.partitionBy("item", "salt").orderBy(*order))).filter(F.col("r") <= k)
        few = few.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order))).filter(F.col("rank") <= k)
        kind = asked.schema["item_id"]
        names = spark.createDataFrame([(i, r["item_id"]) for i, r in enumerate(rows)], f"i int, item_id {kind.dataType.simpleString()}")
        out.append(few.join(F.broadcast(names), F.col("item") == F.col("i")).select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score"))
    result = out[0]
    for more in out[1:]:
        result = result.unionByName(more)
    return result
