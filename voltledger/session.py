"""Session builder and the shared folder that written intermediate data goes to."""

from __future__ import annotations

import math
import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

# What one shuffle partition should hold, so that it sorts and aggregates in executor memory.
SHUFFLE_PARTITION_BYTES = 128 * 1024 * 1024


def shuffle_partitions(shuffle_bytes: int) -> int:
    """How many partitions a shuffle of ``shuffle_bytes`` takes."""
    return max(1, math.ceil(shuffle_bytes / SHUFFLE_PARTITION_BYTES))


def build_session(
    app_name: str = "voltledger",
    master: str | None = None,
    shuffle_bytes: int | None = None,
    **conf: object,
) -> SparkSession:
    """A session with a UTC clock, ANSI errors and adaptive execution.

    ``shuffle_bytes`` is the size of the largest shuffle to come; it sets the number of shuffle
    partitions, which adaptive execution joins together where less arrives. Keyword names use
    ``_`` for ``.``: ``spark_sql_files_maxPartitionBytes="512m"``.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.ansi.enabled", "true")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.ui.enabled", "false")
        # Where in Python a column was made is not looked up; that took longer than some queries.
        .config("spark.sql.dataFrameQueryContext.enabled", "false")
    )
    if shuffle_bytes is not None:
        builder = builder.config("spark.sql.shuffle.partitions", shuffle_partitions(shuffle_bytes))
    if master is not None:
        builder = builder.master(master)
    for name, value in conf.items():
        builder = builder.config(name.replace("_", "."), str(value))
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach, from ``spark.checkpoint.dir``.

    A session on a cluster must have the setting. Only one whose driver is its only executor, as
    in a trial, may go without; it then gets a temporary folder.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder is None:
        if not re.fullmatch(r"local(\[[^]]*\])?", context.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="voltledger-"))
        folder = context.getCheckpointDir()
    return folder.rstrip("/")


# The folder of the innermost ``scratch`` block, if any.
_scratch: ContextVar[str | None] = ContextVar("scratch", default=None)


def new_path(spark: SparkSession, label: str) -> str:
    """A path in the shared folder, or in that of a ``scratch`` block, that no other call has been
    given."""
    folder = _scratch.get() or shared_folder(spark)
    return f"{folder}/{label}-{uuid.uuid4().hex}"


@contextmanager
def scratch(spark: SparkSession) -> Iterator[str]:
    """A folder in the shared one that takes whatever is written within the block, by ``written``
    and ``new_path``, and goes at its end, also after an error.

    Results that stand on such data must be used up, or written elsewhere, within the block. It
    holds for the thread that opens it.
    """
    folder = new_path(spark, "scratch")
    token = _scratch.set(folder)
    try:
        yield folder
    finally:
        _scratch.reset(token)
        remove_folder(spark, folder)


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared folder and read back: computed once, and with no lineage."""
    path = new_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder that ``new_path`` named, on whatever file system it is."""
    jvm, context = spark._jvm, spark.sparkContext
    folder = jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(context._jsc.hadoopConfiguration()).delete(folder, True)


@contextmanager
def staged(df: DataFrame, label: str) -> Iterator[DataFrame]:
    """``df`` written to the shared folder and read back, for as long as the block lasts."""
    path = new_path(df.sparkSession, label)
    try:
        df.write.parquet(path)
        yield df.sparkSession.read.schema(df.schema).parquet(path)
    finally:
        remove_folder(df.sparkSession, path)
