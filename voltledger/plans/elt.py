"""From a raw register file to rows of a catalog table."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import types as T

from voltledger.plans.register import SILVER_COLUMNS
from voltledger.sources import append_rows, project, read_parquet


def load_register(
    spark: SparkSession, source: str, table: str, id_column: str | None = None
) -> None:
    """Project the register in ``source`` to its silver columns and append them to ``table``."""
    append_rows(table, project(read_parquet(spark, source), SILVER_COLUMNS), id_column)


def silver_schema(register: T.StructType) -> T.StructType:
    """The silver table's columns, typed as in the register file."""
    return T.StructType(
        [T.StructField(new or old, register[old].dataType) for old, new in SILVER_COLUMNS.items()]
    )
