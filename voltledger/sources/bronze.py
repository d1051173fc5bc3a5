"""Landing of raw JSON as a typed table, with the unreadable lines or files kept aside.

A landed table has two partitions, ``landing=accepted`` and ``landing=rejected``, written in one
pass over the raw text. Both counts come from the file footers of what was written, so they hold
whichever tasks had to be run again.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voltledger.sources.documents import CORRUPT, PERMISSIVE, read_documents, with_corrupt
from voltledger.sources.split_documents import read_split_documents

ACCEPTED, REJECTED = "accepted", "rejected"
RESERVED = ("raw_line", "landing", CORRUPT)
ONE_FLAT_OBJECT = r"^\s*\{[^}]*\}\s*$"


def _is_whole(line: Column) -> Column:
    """A line that starts with a JSON object holds nothing after it.

    ``from_json`` stops at the end of the first object, so this is asked separately. A line with
    one closing brace, at its end, cannot hold more. Any other line, such as one with a nested
    object, is put in brackets and must be an array of one.
    """
    n_values = F.json_array_length(F.concat(F.lit("["), line, F.lit("]")))
    return F.when(line.rlike(ONE_FLAT_OBJECT), F.lit(True)).otherwise(
        F.coalesce(n_values == 1, F.lit(False))
    )


def _checked(schema: T.StructType) -> T.StructType:
    taken = [f.name for f in schema.fields if f.name in RESERVED]
    if taken:
        raise ValueError(f"columns {taken} are added on landing and cannot be in the schema")
    return schema


def parse_lines(
    lines: DataFrame, schema: T.StructType, extra: Mapping[str, Column] | None = None
) -> DataFrame:
    """Typed columns, ``raw_line`` (for rejected lines only) and ``landing`` from a ``value`` column.

    ``extra`` adds columns computed from the typed ones. A line is rejected when it is not one
    JSON object, or has a value of another type. Empty lines, and lines of spaces, are no records.
    """
    record = F.from_json(F.col("value"), with_corrupt(_checked(schema)), PERMISSIVE)
    rejected = ~F.col("is_whole") | F.col("record").isNull() | F.col(f"record.{CORRUPT}").isNotNull()
    fields = [
        F.when(~rejected, F.col("record").getField(field.name)).alias(field.name)
        for field in schema.fields
    ]
    return (
        lines.filter(F.trim(F.col("value")) != "")
        .select("value", record.alias("record"), _is_whole(F.col("value")).alias("is_whole"))
        .select(
            *fields,
            F.when(rejected, F.col("value")).alias("raw_line"),
            F.when(rejected, REJECTED).otherwise(ACCEPTED).alias("landing"),
        )
        .select("*", *[c.alias(name) for name, c in (extra or {}).items()])
    )


def land_json_lines(
    spark: SparkSession,
    source: str,
    target: str,
    schema: T.StructType,
    partition_by: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Write the landed table to ``target`` and return its counts: ``n_records``, ``n_rejected``.

    ``partition_by`` adds columns computed from the record, such as the year of its time, and
    partitions by them after ``landing``, so that later reads can skip whole folders. Each task
    writes a file per partition it meets: right for raw files that each cover a short period.
    """
    parsed = parse_lines(spark.read.text(source), schema, partition_by)
    folders = ["landing", *(partition_by or {})]
    parsed.write.partitionBy(folders).mode("errorifexists").parquet(target)
    return landing_counts(spark, target, schema)


def land_json_documents(
    spark: SparkSession, source: str, target: str, schema: T.StructType, split: bool = False
) -> DataFrame:
    """Land files that are one JSON document each, a list of records or a single one, indented or not.

    A file that is not exactly one such document, or has a fault anywhere, is rejected whole. It
    is then one row, whose ``raw_line`` has the name of the file, not its text. Returns
    ``n_records`` and ``n_rejected_files``. One task reads a file and its text must fit in a row,
    unless ``split`` asks for files to be read by many tasks (``split_documents``).
    """
    if split:
        documents = read_split_documents(spark, source, _checked(schema))
        rejected = F.col("rejected")
        documents.select(
            F.when(rejected, F.col("file")).alias("raw_line"),
            F.when(rejected, REJECTED).otherwise(ACCEPTED).alias("landing"),
            "record.*",
        ).drop(CORRUPT).write.partitionBy("landing").mode("errorifexists").parquet(target)
        counts = landing_counts(spark, target, schema)
        return counts.withColumnRenamed("n_rejected", "n_rejected_files")
    documents = read_documents(spark, source, _checked(schema))
    rejected = F.col("rejected")
    documents.where(rejected | (F.size("records") > 0)).select(
        F.when(rejected, F.col("file")).alias("raw_line"),
        F.when(rejected, REJECTED).otherwise(ACCEPTED).alias("landing"),
        F.inline_outer(F.when(~rejected, F.col("records"))),
    ).drop(CORRUPT).write.partitionBy("landing").mode("errorifexists").parquet(target)
    counts = landing_counts(spark, target, schema)
    return counts.withColumnRenamed("n_rejected", "n_rejected_files")


def _read_landed(spark: SparkSession, target: str, schema: T.StructType) -> DataFrame:
    extra = [T.StructField("raw_line", T.StringType()), T.StructField("landing", T.StringType())]
    return spark.read.schema(T.StructType([*schema.fields, *extra])).parquet(target)


def landing_counts(spark: SparkSession, target: str, schema: T.StructType) -> DataFrame:
    """One row: ``n_records`` accepted and ``n_rejected`` in a landed table."""
    return _read_landed(spark, target, schema).agg(
        F.count_if(F.col("landing") == ACCEPTED).alias("n_records"),
        F.count_if(F.col("landing") == REJECTED).alias("n_rejected"),
    )


def read_accepted(spark: SparkSession, target: str, schema: T.StructType) -> DataFrame:
    """The typed records of a landed table, and the columns it was partitioned by."""
    landed = _read_landed(spark, target, schema)
    return landed.filter(F.col("landing") == ACCEPTED).drop("raw_line", "landing")


def read_rejected(spark: SparkSession, target: str, schema: T.StructType) -> DataFrame:
    """The rejected lines of a landed table, as they came, or the names of files: ``raw_line``."""
    landed = _read_landed(spark, target, schema)
    return landed.filter(F.col("landing") == REJECTED).select("raw_line")
