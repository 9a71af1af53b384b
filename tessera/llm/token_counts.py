"""Token counts of flat, unindexed token files by a separator scan.

A token file is only fixed-width little-endian ids; documents end with a separator id.
Files are cut into blocks that tasks read by byte range, each searched for separators
with one vectorised comparison. What a block cannot know - where its first document
began, how many ended before - is stitched by a prefix scan over one small row per
block (last separator and separator count), so no task reads a file whole.

Results for odd input: an empty file has no documents; two separators in a row are a
document of 0 tokens; ids after the last separator are a document with ``closed``
false; a trailing part of an id (file size not a multiple of the id width) is an error.
Of a corpus written here, null and empty texts are documents of 0 tokens; repeated rows
and null ids give a row each.
"""

from __future__ import annotations

import uuid
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.llm import bpe
from tessera.llm.common import materialize, new_folder, small_batches

BLOCK_BYTES = 8 << 20


def open_store(uri: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a folder or file that all executors share."""
    if "://" not in uri and not uri.startswith("file:"):
        return pafs.LocalFileSystem(), uri
    if uri.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    return pafs.FileSystem.from_uri(uri)


def write_corpus(docs: DataFrame, tokenizer_path: str, separator: int, id_width: int = 2, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """Tokenise whole texts into flat files below the shared folder, one per task; each
    text is followed by ``separator``. Returns the files that the job committed (``path,
    bytes``; a lost task's file is never listed) and their members (``path, doc, doc_id``:
    the id of a file's document by its number from 0)."""
    spark = docs.sparkSession
    folder = new_folder(spark, "tokens")
    store, path = open_store(folder)
    store.create_dir(path, recursive=True)
    spec = spark.sparkContext.broadcast(bpe.read_spec(tokenizer_path))
    kind = {2: "H", 4: "I"}[id_width]

    def run(batches):
        encoder = bpe.encoder_of(spec.value)
        store, path = open_store(folder)
        store.create_dir(path, recursive=True)
        name = f"{uuid.uuid4().hex}.bin"
        tail, size, doc, id_type = array(kind, [separator]).tobytes(), 0, 0, None
        columns = ["path", "bytes", "doc", "doc_id"]
        with store.open_output_stream(f"{path}/{name}") as out:
            for batch in batches:
                ids_of, texts = batch.columns
                for text in texts:
                    for ids in encoder.encode(text.as_py()):
                        part = ids if id_width == 4 else np.frombuffer(ids, np.uint32).astype("<u2").tobytes()
                        out.write(part)
                        size += len(part)
                    out.write(tail)
                    size += id_width
                n, id_type = len(ids_of), ids_of.type
                if n:
                    yield pa.RecordBatch.from_arrays([pa.array([name] * n), pa.nulls(n, pa.int64()), pa.array(range(doc, doc + n), pa.int64()), ids_of], names=columns)
                doc += n
        if doc:
            yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([size], pa.int64()), pa.nulls(1, pa.int64()), pa.nulls(1, id_type)], names=columns)

    chosen = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    id_kind = chosen.schema["doc_id"].dataType.simpleString()
    listed = chosen.transform(small_batches).mapInArrow(run, f"path string, bytes bigint, doc bigint, doc_id {id_kind}")
    written = materialize(listed.withColumn("path", F.concat(F.lit(folder + "/"), "path")), "token-files")
    return written.filter("bytes is not null").select("path", "bytes"), written.filter("doc is not null").select("path", "doc", "doc_id")


def write_token_files(docs: DataFrame, tokenizer_path: str, separator: int, id_width: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The files of :func:`write_corpus` alone (``path, bytes``)."""
    return write_corpus(docs, tokenizer_path, separator, id_width, id_col, text_col)[0]


def count_tokens(files: DataFrame, separator: int, id_width: int = 2, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``path, doc, start, n_tokens, closed`` of every document in the files.

    ``files`` has ``path`` and ``bytes``; ``doc`` numbers a file's documents from 0 and
    ``start`` is the position (in ids) of a document's first token.
    """
    step = max(1, block_bytes // id_width) * id_width
    blocks = files.filter("bytes > 0").select(
        "path", "bytes", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("bytes") - 1) / step).cast("bigint"))).alias("block")
    ).repartition("path", "block")

    def scan(batches):
        for batch in batches:
            for path, size, block in zip(*(c.to_pylist() for c in batch.columns)):
                if size % id_width:
                    raise ValueError(f"{path}: {size} bytes are no whole number of ids")
                store, name = open_store(path)
                with store.open_input_file(name) as f:
                    ids = np.frombuffer(f.read_at(min(step, size - block * step), block * step), f"<u{id_width}")
                ends = np.flatnonzero(ids == separator) + block * (step // id_width)
                last = bool(block * step + step >= size)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([path]), pa.array([block], pa.int64()), pa.array([ends], pa.list_(pa.int64())), pa.array([len(ends)], pa.int64()),
                     pa.array([int(ends[-1]) if len(ends) else None], pa.int64()), pa.array([size // id_width if last else None], pa.int64())],
                    names=["path", "block", "ends", "n", "last_end", "tokens"],
                )

    scanned = materialize(
        blocks.transform(small_batches).mapInArrow(scan, "path string, block bigint, ends array<bigint>, n bigint, last_end bigint, tokens bigint"), "blocks"
    )
    before = Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    carried = scanned.select(
        F.col("path").alias("s_path"), F.col("block").alias("s_block"),
        F.coalesce(F.max("last_end").over(before), F.lit(-1)).alias("carry"),
        F.coalesce(F.sum("n").over(before), F.lit(0)).alias("earlier"),
    )
    joined = scanned.join(carried, (F.col("path") == F.col("s_path")) & (F.col("block") == F.col("s_block")))
    # documents that end in this block: from the end before (or the carry) to their own
    ended = joined.select(
        "path", "earlier", "carry", "ends", F.posexplode("ends").alias("nth", "end"),
    ).select(
        "path", (F.col("earlier") + F.col("nth")).alias("doc"),
        (F.when(F.col("nth") == 0, F.col("carry")).otherwise(F.get("ends", F.col("nth") - 1)) + 1).alias("start"), "end", F.lit(True).alias("closed"),
    )
    open_end = joined.filter("tokens is not null").select(
        "path", (F.col("earlier") + F.col("n")).alias("doc"),
        (F.coalesce("last_end", "carry") + 1).alias("start"), F.col("tokens").alias("end"), F.lit(False).alias("closed"),
    ).filter("start < end")
    return ended.unionByName(open_end).select("path", "doc", "start", (F.col("end") - F.col("start")).alias("n_tokens"), "closed")


def corpus_token_counts(docs: DataFrame, tokenizer_path: str, separator: int, id_width: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write the corpus as token files and count every document's tokens in them:
    ``doc_id, path, doc, start, n_tokens, closed``, one row per row of ``docs``. Ids join the
    scan's rows by (file, number), a key that no two rows share."""
    files, members = write_corpus(docs, tokenizer_path, separator, id_width, id_col, text_col)
    counted = count_tokens(files, separator, id_width)
    return members.join(counted, ["path", "doc"]).select("doc_id", "path", "doc", "start", "n_tokens", "closed")
