"""Helpers shared by the training-data operators: the shared work folder, written
intermediate tables and the size of Arrow batches."""

from __future__ import annotations

import ctypes
import gc
import re
import tempfile
import uuid
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """Folder for intermediate tables that driver and executors all see.

    Read from ``spark.checkpoint.dir`` (or the context's checkpoint folder). Only a
    local session, as in tests, falls back to a scratch folder of this machine; a
    cluster session without the setting is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="tessera-shared-")
        spark.conf.set("spark.checkpoint.dir", base)
    return base.rstrip("/")


def new_folder(spark: SparkSession, label: str) -> str:
    """A fresh folder name below :func:`shared_dir`."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str, row_group_bytes: int | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and read it back (cuts lineage; lost
    executors re-read files instead of recomputing). ``row_group_bytes`` bounds what a reader
    holds at once where single rows are large."""
    path = new_folder(df.sparkSession, label)
    writer = df.write
    if row_group_bytes:
        writer = writer.option("parquet.block.size", row_group_bytes).option("parquet.page.size.row.check.min", 1)
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Bytes of rows in one Arrow batch; the default of 10,000 rows has no useful bound for long texts.
BATCH_BYTES = 1 << 20
#: Rows a Parquet reader decodes at once. The default of 4096 texts are arrays of tens of MB, which an
#: executor's heap grows by and gives back late.
READ_ROWS = 256


def small_batches(df: DataFrame) -> DataFrame:
    """``df`` with Arrow batches of about :data:`BATCH_BYTES` for what maps it, and Parquet read by
    :data:`READ_ROWS` (settings of the session, kept where they are lower already); no batch is cut
    within a row."""
    conf = df.sparkSession.conf
    for key, most in (("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES), ("spark.sql.parquet.columnarReaderBatchSize", READ_ROWS)):
        held = re.fullmatch(r"(\d+)b?", conf.get(key))
        if not held or int(held[1]) > most:
            conf.set(key, str(most))
    return df


#: What a worker process keeps between the tasks of one operator.
_KEPT: dict = {}


def kept(key: str, make: Callable):
    """``make()``, kept in this worker process under ``key``; another key's entry goes."""
    if key not in _KEPT:
        release()
        trim()
        _KEPT[key] = make()
    return _KEPT[key]


def release() -> None:
    """Frees what an earlier operator's tasks kept in this (reused) worker process."""
    if _KEPT:
        _KEPT.clear()
        trim()


def trim() -> None:
    """Gives freed memory back to the system, where the C library can."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    give_back = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if give_back:
        give_back(0)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


#: Ids up to which a set of ids is broadcast (8 bytes each); more are joined by shuffle.
BROADCAST_IDS = 500_000


def small(ids: DataFrame, limit: int = BROADCAST_IDS) -> DataFrame:
    """``ids`` with a broadcast hint if a count proves it small, else as it is."""
    return F.broadcast(ids) if ids.count() <= limit else ids


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names like ``names`` that ``df`` does not have."""
    have, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in have:
            name += "_"
        have.add(name.lower())
        out.append(name)
    return out


def hash_sample(df: DataFrame, rows: int, *keys: str) -> DataFrame:
    """About the first ``rows`` rows by a hash of ``keys`` (never more). A count sets a
    bound on the hash first, so that only about 1.5 times ``rows`` rows are sorted."""
    n, h = df.count(), F.xxhash64(*keys)
    if n > 1.5 * rows:
        df = df.filter(h <= int(-(2**63) + 2**64 * (1.5 * rows / n)))
    return df.orderBy(h, *keys).limit(rows)
