"""Duplicate keys. Null keys count as equal to each other, so they are duplicates too."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voltledger.functions import col, quoted, require_columns, sum_or_zero

# What one broadcast row takes, beside the text of its key.
BROADCAST_ROW_BYTES = 64
FIXED_SIZE = (T.NumericType, T.BooleanType, T.DatetimeType)


def _repeated_keys(df: DataFrame, key: str) -> DataFrame:
    return (
        df.groupBy(col(key).alias("repeated_key"))
        .agg(F.count(F.lit(1)).alias("n"))
        .filter("n > 1")
        .select("repeated_key")
    )


def _key_bytes(keys: DataFrame) -> int:
    """What the keys take as a broadcast table. Only keys of varying length are read for it."""
    row_bytes = F.lit(BROADCAST_ROW_BYTES)
    if not isinstance(keys.schema[0].dataType, FIXED_SIZE):
        text = F.col("repeated_key").cast("string")
        row_bytes = row_bytes + F.coalesce(F.octet_length(text), F.lit(0))
    return keys.agg(sum_or_zero(row_bytes)).first()[0]


def duplicated_rows(
    df: DataFrame, key: str, broadcast_bytes: int = 0, folder: str | None = None
) -> DataFrame:
    """Rows whose key value occurs more than once.

    Counting the keys shuffles one combined row per key and task, never whole rows. The null-safe
    semi join then shuffles the rows by key, and adaptive execution splits the partition of a hot
    key, which it can do here because the other side has one row per key. No job is run.

    With ``broadcast_bytes`` the repeated keys are counted at once, written to ``folder`` (which
    the caller owns and removes when the result is no longer used) and measured. If they fit they
    are broadcast and the rows are not shuffled at all; if not, the plan is the one above.
    """
    require_columns(df, [key])
    keys = _repeated_keys(df, key)
    if broadcast_bytes > 0:
        if folder is None:
            raise ValueError("broadcast_bytes needs a folder for the repeated keys")
        keys.write.parquet(folder)
        keys = df.sparkSession.read.schema(keys.schema).parquet(folder)
        if _key_bytes(keys) <= broadcast_bytes:
            keys = F.broadcast(keys)
    return df.join(keys, df[quoted(key)].eqNullSafe(keys["repeated_key"]), "left_semi")


def duplicated_sum(df: DataFrame, key: str, column: str) -> DataFrame:
    """One row: the sum of ``column`` over the rows whose key occurs more than once.

    Two levels of aggregation; no row is shuffled, only one count and sum per key and task.
    """
    require_columns(df, [key, column])
    return (
        df.groupBy(col(key).alias("repeated_key"))
        .agg(F.count(F.lit(1)).alias("n"), F.sum(col(column)).alias("total"))
        .filter("n > 1")
        .agg(sum_or_zero(F.col("total")).alias(column))
    )


def duplicate_key_report(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """For each candidate key, the rows whose non-null value occurs more than once: ``key``, ``dup_rows``."""
    require_columns(df, keys)
    reports = [
        df.filter(col(key).isNotNull())
        .groupBy(col(key).alias("candidate"))
        .agg(F.count(F.lit(1)).alias("n"))
        .filter("n > 1")
        .agg(sum_or_zero(F.col("n")).alias("dup_rows"))
        .select(F.lit(key).alias("key"), "dup_rows")
        for key in keys
    ]
    return reduce(DataFrame.unionByName, reports)
