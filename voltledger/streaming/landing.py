"""Incremental landing: each raw file is landed once, however often the job is started."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from voltledger.sources.bronze import parse_lines


def land_new_files(
    spark: SparkSession,
    source: str,
    target: str,
    schema: T.StructType,
    checkpoint: str,
    max_files_per_batch: int = 10_000,
    partition_by: Mapping[str, Column] | None = None,
) -> StreamingQuery:
    """Land the JSON-lines files that came into the folder ``source`` since the last start.

    The same rules and table layout as the one-off landing. The stream's checkpoint remembers
    the files done, so a restart neither skips nor repeats a file. The query ends by itself.
    """
    lines = spark.readStream.option("maxFilesPerTrigger", max_files_per_batch).text(source)
    return (
        parse_lines(lines, schema, partition_by)
        .writeStream.format("parquet")
        .partitionBy("landing", *(partition_by or {}))
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start(target)
    )
