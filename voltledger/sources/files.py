"""Reading Parquet, JSON and CSV files with the types said in advance."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voltledger.functions import col, require_columns
from voltledger.sources.documents import CORRUPT, read_documents
from voltledger.sources.split_documents import read_split_documents


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    """A Parquet file or folder; the name needs no extension."""
    return spark.read.parquet(path)


def read_json_records(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str,
    lines: bool = False,
    split: bool = False,
) -> DataFrame:
    """Records from JSON, one row each; a record that does not fit the schema is an error.

    ``lines=False`` reads documents (an array of records, or one record), indented or not; a file
    with anything behind its document is an error. One task reads such a file, unless ``split``
    asks for large ones to be read by many, in two passes (``split_documents``). ``lines=True``
    reads one document per line, which Spark splits.
    """
    if lines:
        return spark.read.schema(schema).option("mode", "FAILFAST").json(path)
    if isinstance(schema, str):
        schema = T.DataType.fromDDL(schema)
    message = F.concat(F.lit("not one JSON document of the given schema: "), F.col("file"))
    if split:
        record = F.when(F.col("rejected"), F.raise_error(message)).otherwise(F.col("record"))
        found = read_split_documents(spark, path, schema).select(record.alias("record"))
        return found.select("record.*").drop(CORRUPT)
    records = F.when(F.col("rejected"), F.raise_error(message)).otherwise(F.col("records"))
    return read_documents(spark, path, schema).select(F.inline(records)).drop(CORRUPT)


def flatten_results(df: DataFrame, column: str = "results", keep_empty: bool = False) -> DataFrame:
    """One row per struct in the list ``column``, its fields as columns.

    A row whose list is empty or null gives no row, or one row of nulls with ``keep_empty``.
    """
    require_columns(df, [column])
    inline = F.inline_outer if keep_empty else F.inline
    return df.select(inline(col(column)))


def read_csv(
    spark: SparkSession, path: str, types: Mapping[str, str], separator: str = ","
) -> DataFrame:
    """A CSV file with a header. Columns are found by name; those not in ``types`` stay text.

    Only the header line is read in advance. A value that does not fit its type is an error.
    """
    header = spark.read.csv(path, header=True, sep=separator).columns
    missing = [name for name in types if name not in header]
    if missing:
        raise ValueError(f"missing columns {missing}; the header has {header}")
    schema = T.StructType()
    for name in header:
        schema = schema.add(name, T.DataType.fromDDL(types.get(name, "string")))
    return spark.read.csv(
        path, schema=schema, header=True, sep=separator, enforceSchema=False, mode="FAILFAST"
    )
