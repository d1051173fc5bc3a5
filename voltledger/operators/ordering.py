"""Sorts with nulls first, whichever the direction."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voltledger.functions import col, require_columns, unused


def _order(df: DataFrame, by: str, descending: bool, tie_break: Sequence[str]) -> list[Column]:
    require_columns(df, [by, *tie_break])
    first = F.desc_nulls_first(col(by)) if descending else F.asc_nulls_first(col(by))
    return [first, *[F.asc_nulls_first(col(name)) for name in tie_break]]


def sorted_rows(
    df: DataFrame, by: str, descending: bool = False, tie_break: Sequence[str] = ()
) -> DataFrame:
    """All rows in order of ``by``.

    The sort is range-partitioned, and ranges can cut through a value of ``by`` that holds a large
    part of the rows: by a fine ``tie_break`` (a unique id, say), or without one by a row's place in
    the input, so that equal values also keep the order that they have there.
    """
    order = _order(df, by, descending, tie_break)
    if tie_break:
        return df.orderBy(*order)
    place = unused(df.columns, "place")
    placed = df.withColumn(place, F.monotonically_increasing_id())
    return placed.orderBy(*order, place).drop(place)


def top_rows(
    df: DataFrame, by: str, n: int, descending: bool = False, tie_break: Sequence[str] = ()
) -> DataFrame:
    """The first ``n`` rows in order of ``by``; each task keeps ``n`` rows, nothing is sorted whole."""
    return df.orderBy(*_order(df, by, descending, tie_break)).limit(n)
