"""Landing raw lines once, however often, and under whatever name, a file comes.

A landed folder has ``data``, with a folder per load, and ``manifest``, with a table of the files
that each load took. A load first writes its data and then its manifest, and only loads with a
manifest are read: a load that fails in between is not there, and its files are landed by the next.

A file is known by its content: how many lines it has, and sums over two hashes of every line. They
add up from splits in any order, so a large file is read by many tasks, and no text is shuffled.
Files with the same lines in another order are the same to a landing, which makes a row of each.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voltledger.session import written
from voltledger.sources.bronze import ACCEPTED, REJECTED, parse_lines

MANIFEST = "load string, file string, content string, n_lines long"


def _exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


def read_manifest(spark: SparkSession, target: str) -> DataFrame:
    """``load, file, content, n_lines`` of every file that was landed."""
    if not _exists(spark, f"{target}/manifest"):
        return spark.createDataFrame([], MANIFEST)
    return spark.read.schema(MANIFEST).parquet(f"{target}/manifest")


def file_contents(spark: SparkSession, source: str) -> DataFrame:
    """``file, content, n_lines`` of every file with a line."""
    line = spark.read.text(source).select(F.col("_metadata.file_path").alias("file"), "value")
    first, second = F.xxhash64("value"), F.xxhash64("value", F.lit(1))
    sums = line.groupBy("file").agg(
        F.count("*").alias("n_lines"),
        F.sum(first.cast("decimal(20,0)")).alias("first"),
        F.sum(second.cast("decimal(20,0)")).alias("second"),
    )
    content = F.sha2(F.concat_ws(" ", F.col("n_lines"), F.col("first"), F.col("second")), 256)
    return sums.select("file", content.alias("content"), "n_lines")


def land_new_contents(
    spark: SparkSession,
    source: str,
    target: str,
    schema: T.StructType,
    partition_by: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Land the lines of the files in ``source`` whose content is not landed yet.

    Returns one row: ``load``, ``n_files`` that it took, ``n_known`` that were landed before or are
    copies of one that it took, ``n_records`` and ``n_rejected`` of the load. Of files with the
    same content the one with the first name is taken. One landing at a time.
    """
    found = file_contents(spark, source)
    firsts = found.groupBy("content").agg(F.min_by(F.struct("file", "n_lines"), "file").alias("one"))
    known = read_manifest(spark, target).select("content").distinct()
    load = uuid.uuid4().hex
    fresh = written(
        firsts.join(known, "content", "left_anti").select(
            F.lit(load).alias("load"), "one.file", "content", "one.n_lines"
        ),
        "landing-files",
    )
    n_files, n_all = fresh.count(), found.count()
    data = f"{target}/data/load={load}"
    if n_files:
        lines = spark.read.text(source).select("value", F.col("_metadata.file_path").alias("file"))
        lines = lines.join(fresh.select("file"), "file", "left_semi")
        parsed = parse_lines(lines, schema, partition_by)
        parsed.write.partitionBy("landing", *(partition_by or {})).parquet(data)
        fresh.write.mode("append").parquet(f"{target}/manifest")
        rows = spark.read.schema("landing string").parquet(data)
    else:
        rows = spark.createDataFrame([], "landing string")
    return rows.agg(
        F.lit(load).alias("load"),
        F.lit(n_files).cast("long").alias("n_files"),
        F.lit(n_all - n_files).cast("long").alias("n_known"),
        F.count_if(F.col("landing") == ACCEPTED).alias("n_records"),
        F.count_if(F.col("landing") == REJECTED).alias("n_rejected"),
    )


def read_contents(
    spark: SparkSession, target: str, schema: T.StructType, rejected: bool = False
) -> DataFrame:
    """The typed records, or the rejected lines as ``raw_line``, of all loads in the manifest."""
    extra = [T.StructField(name, T.StringType()) for name in ("raw_line", "load", "landing")]
    if not _exists(spark, f"{target}/data"):
        landed = spark.createDataFrame([], T.StructType([*schema.fields, *extra]))
    else:
        landed = spark.read.schema(T.StructType([*schema.fields, *extra])).parquet(f"{target}/data")
    loads = read_manifest(spark, target).select("load").distinct()
    whole = landed.join(loads, "load", "left_semi")
    if rejected:
        return whole.where(F.col("landing") == REJECTED).select("raw_line")
    return whole.where(F.col("landing") == ACCEPTED).select([f.name for f in schema.fields])
