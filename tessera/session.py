"""Session construction and the few session-level settings the operators rely on."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings every tessera session should carry. Timestamps in the inputs are
# naive local stamps, so the session zone is pinned to UTC; AQE re-plans joins
# and partition counts from runtime sizes and splits skewed shuffle partitions.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(
    master: str | None = None,
    shuffle_partitions: int | None = None,
    app_name: str = "tessera",
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or reuse) a session with :data:`DEFAULT_CONF` applied.

    ``master`` is left to ``spark-submit`` when ``None``.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = dict(DEFAULT_CONF)
    if shuffle_partitions is not None:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    return spark


def pin_utc(spark: SparkSession) -> None:
    """Make date/hour extraction independent of the caller's session zone."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by the cluster.

    The folder comes from ``spark.checkpoint.dir`` (or a directory already set on
    the context). Only a local session with neither, as in tests, gets a scratch
    folder; a cluster session without a shared folder is an error.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="tessera-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


#: Rows, shuffled bytes and bytes of files of one task under :func:`small_tasks`.
TASK_ROWS, TASK_BYTES, TASK_FILE_BYTES = 250_000, 4 << 20, 16 << 20


@contextmanager
def small_tasks(spark: SparkSession, rows: int) -> Iterator[None]:
    """Jobs run inside shuffle ``rows`` rows to tasks of bounded size, so a task sorts and joins no more of a
    larger input: more shuffle partitions, adaptive execution merges them to :data:`TASK_BYTES` only, and scans are cut at :data:`TASK_FILE_BYTES`.
    The session's settings are restored; as with :func:`checkpoint_keyed`, run no other jobs beside."""
    parts, size, files = "spark.sql.shuffle.partitions", "spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.files.maxPartitionBytes"
    saved = {k: spark.conf.get(k) for k in (parts, size, files)}
    spark.conf.set(parts, str(max(int(saved[parts]), -(-rows // TASK_ROWS))))
    spark.conf.set(size, str(TASK_BYTES))
    spark.conf.set(files, str(TASK_FILE_BYTES))
    try:
        yield
    finally:
        for k, v in saved.items():
            spark.conf.set(k, v)


def checkpoint_keyed(df: DataFrame, partitions: int, *keys: str) -> DataFrame:
    """Reliable checkpoint that keeps a hash partitioning on ``keys``.

    Under adaptive execution a checkpoint reports an unknown partitioning, so a
    later join on the same keys would shuffle the data again. Planning the
    checkpoint itself with AQE off records ``hashpartitioning(keys, partitions)``
    and later joins on ``keys`` reuse it (no exchange on this side); shuffles
    inside the checkpointed plan use the same ``partitions`` so they line up
    with it. With no ``keys`` the current partitioning of ``df`` is kept.
    The two session settings are restored afterwards; do not run other jobs on
    the same session concurrently with this call.
    """
    spark = df.sparkSession
    checkpoint_dir(spark)
    saved = {
        k: spark.conf.get(k)
        for k in ("spark.sql.adaptive.enabled", "spark.sql.shuffle.partitions")
    }
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    target = df.repartition(partitions, *keys) if keys else df
    try:
        # Writing a reliable checkpoint runs the plan a second time unless the
        # rows are held; keep them for the duration of the checkpoint only.
        target = target.persist()
        return target.checkpoint()
    finally:
        target.unpersist()
        for k, v in saved.items():
            spark.conf.set(k, v)


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once to the shared folder and read back: later jobs read files, and a lost
    executor repeats no upstream work."""
    path = f"{checkpoint_dir(df.sparkSession).rstrip('/')}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
