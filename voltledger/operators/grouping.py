"""Global and grouped sums. Spark combines on the map side, so a hot key adds one row per task.

With ``exact`` the sums of floating columns are the doubles nearest to the true sums, the same for
any order and partitioning (``operators.exact``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voltledger.functions import (
    col,
    divide_ieee,
    names_containing,
    require_columns,
    round_half_even,
    sum_or_zero,
)
from voltledger.operators.exact import added_up, digit_sums, exact_sums, finished, is_floating


def _require_numeric(df: DataFrame, names: Sequence[str]) -> None:
    require_columns(df, names)
    text = [n for n in names if not isinstance(df.schema[n].dataType, T.NumericType)]
    if text:
        raise TypeError(f"cannot add up non-numeric columns {text}")


def sum_columns(df: DataFrame, columns: Sequence[str], exact: bool = False) -> DataFrame:
    """One row: the sum of each column under its own name, 0 when nothing is there to add."""
    _require_numeric(df, columns)
    if exact:
        return exact_sums(df, {name: col(name) for name in columns})
    return df.agg(*[sum_or_zero(col(name)).alias(name) for name in columns])


def sum_rounded(
    df: DataFrame, columns: Sequence[str], digits: int, exact: bool = False
) -> DataFrame:
    """``sum_columns`` rounded to ``digits`` places; sums of whole numbers stay whole, sums of
    decimals decimal."""
    _require_numeric(df, columns)
    sums = []
    for name in columns:
        total = col(name) if exact else sum_or_zero(col(name))
        kind = df.schema[name].dataType
        if isinstance(kind, T.DecimalType):
            total = F.bround(total, digits)
        elif not isinstance(kind, T.IntegralType):
            total = round_half_even(total, digits)
        sums.append(total.alias(name))
    return sum_columns(df, columns, exact=True).select(*sums) if exact else df.agg(*sums)


def sum_matching(df: DataFrame, text: str, digits: int, exact: bool = False) -> DataFrame:
    """Rounded sums of all columns whose name contains ``text``."""
    names = names_containing(df, text)
    if not names:
        raise ValueError(f"no column name contains {text!r}; the frame has {df.columns}")
    return sum_rounded(df, names, digits, exact)


def _descending(columns: Sequence[str]) -> list[Column]:
    return [F.desc_nulls_first(col(name)) for name in columns]


def group_sums(
    df: DataFrame,
    key: str,
    columns: Sequence[str],
    descending_by: str | None = None,
    exact: bool = False,
) -> DataFrame:
    """Sums of ``columns`` per value of ``key`` (null is a value), largest first when asked.

    Groups with equal sums follow in ascending key order, so the order is the same on every run.
    """
    require_columns(df, [key])
    _require_numeric(df, columns)
    if exact:
        grouped = exact_sums(df, {name: col(name) for name in columns}, [key])
    else:
        grouped = df.groupBy(col(key).alias(key)).agg(
            *[sum_or_zero(col(name)).alias(name) for name in columns]
        )
    if descending_by is None:
        return grouped
    return grouped.orderBy(*_descending([descending_by]), F.asc_nulls_first(col(key)))


def _exact_group_sums(df: DataFrame, key: str, column: str) -> tuple[DataFrame, Column]:
    """Exact sums per ``key``, and the exact whole from the same sums of digits."""
    digits = digit_sums(df, [col(column)], [col(key)])
    grouped = finished(digits, 1, 1).select(F.col("k0").alias(key), F.col("m0").alias(column))
    return grouped, finished(added_up(digits), 1, 0).scalar()


def group_share(
    df: DataFrame, key: str, column: str, share_name: str, digits: int = 2, exact: bool = False
) -> DataFrame:
    """Sum per ``key`` and its share of the whole in percent, largest first.

    The whole is the sum of the group sums, a scalar subquery on the same grouped frame: the
    rows are read and shuffled once. A whole of zero gives NaN shares, as 0/0 does.
    """
    if share_name in (key, column):
        raise ValueError(f"the share cannot be named {share_name}, as a column beside it is")
    if exact and is_floating(df.select(col(column)).schema[0].dataType):
        require_columns(df, [key])
        grouped, whole = _exact_group_sums(df, key, column)
    else:
        grouped = group_sums(df, key, [column])
        whole = grouped.agg(F.sum(col(column))).scalar()
    share = round_half_even(divide_ieee(col(column), col(share_name)) * 100, digits)
    # The whole takes the name of the share first, so that the plan has its subquery once.
    return (
        grouped.withColumn(share_name, whole)
        .withColumn(share_name, share)
        .orderBy(*_descending([column]), F.asc_nulls_first(col(key)))
    )
