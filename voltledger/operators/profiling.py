"""Whole-frame profiles. Each is one pass with partial aggregation, one row out per task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltledger.functions import all_true, col, differs, names_containing, require_columns


def frame_shape(df: DataFrame) -> DataFrame:
    """One row: ``n_rows`` and ``n_columns``."""
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.lit(len(df.columns)).alias("n_columns"))


def row_count(df: DataFrame) -> DataFrame:
    """One row: ``n_rows``. Reads no column."""
    return df.agg(F.count(F.lit(1)).alias("n_rows"))


def _chosen(df: DataFrame, columns: Sequence[str] | None) -> Sequence[str]:
    """All columns when none are asked for; an empty list is a search that found nothing."""
    if columns is None:
        return df.columns
    if not columns:
        raise ValueError(f"no columns to profile; the frame has {df.columns}")
    require_columns(df, columns)
    return columns


def _nulls(name: str):
    return F.count(F.lit(1)) - F.count(col(name))


def null_count(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row: the number of nulls of every column, under the column's own name."""
    return df.agg(*[_nulls(name).alias(name) for name in _chosen(df, columns)])


def has_null(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row: whether each column holds a null, under the column's own name."""
    return df.agg(*[(_nulls(name) > 0).alias(name) for name in _chosen(df, columns)])


def null_columns(df: DataFrame) -> list[str]:
    """Names of the columns that hold a null. Runs one job, which brings back one row of flags."""
    flags = has_null(df).first()
    return [name for name, flag in zip(df.columns, flags) if flag]


def null_columns_only(df: DataFrame) -> DataFrame:
    """The frame reduced to the columns that hold a null. Runs the job of ``null_columns``."""
    return df.select([col(name) for name in null_columns(df)])


def count_per_column(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row: the number of non-null values of every column (not a row count)."""
    return df.agg(*[F.count(col(name)).alias(name) for name in _chosen(df, columns)])


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Rows per value of ``column``, null being a value: ``column``, ``count``."""
    require_columns(df, [column])
    return df.groupBy(col(column).alias(column)).agg(F.count(F.lit(1)).alias("count"))


def min_max(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row: ``<column>_min`` and ``<column>_max`` of each column."""
    require_columns(df, columns)
    bounds = []
    for name in columns:
        bounds.append(F.min(col(name)).alias(f"{name}_min"))
        bounds.append(F.max(col(name)).alias(f"{name}_max"))
    return df.agg(*bounds)


def count_distinct(df: DataFrame, column: str, approximate: bool = False) -> DataFrame:
    """One row: distinct non-null values of ``column`` as ``n_distinct``; exact unless asked."""
    require_columns(df, [column])
    count = F.approx_count_distinct if approximate else F.count_distinct
    return df.agg(count(col(column)).alias("n_distinct"))


def _require_same_type(df: DataFrame, a: str, b: str) -> None:
    require_columns(df, [a, b])
    types = df.select(col(a), col(b)).schema
    if types[0].dataType != types[1].dataType:
        raise TypeError(
            f"cannot compare {a} ({types[0].dataType.simpleString()}) with "
            f"{b} ({types[1].dataType.simpleString()}); bring both to one type first"
        )


def columns_equal(df: DataFrame, a: str, b: str) -> DataFrame:
    """One row: ``is_equal``, true when the columns agree on every row, null agreeing with null."""
    _require_same_type(df, a, b)
    return df.agg(all_true(col(a).eqNullSafe(col(b))).alias("is_equal"))


def rows_differing(df: DataFrame, a: str, b: str) -> DataFrame:
    """Rows on which two columns of one type differ, null being equal to null only."""
    _require_same_type(df, a, b)
    return df.filter(differs(col(a), col(b)))


def select_matching(df: DataFrame, text: str) -> DataFrame:
    """The columns whose name contains ``text``."""
    return df.select([col(name) for name in names_containing(df, text)])
