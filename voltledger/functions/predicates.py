"""Null-aware comparisons and choices."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def differs(a: Column, b: Column) -> Column:
    """``a`` is not ``b``, with null equal to null and NaN equal to NaN; never null."""
    return ~a.eqNullSafe(b)


def all_true(c: Column) -> Column:
    """Aggregate: the condition holds on every row; true for no rows."""
    return F.coalesce(F.bool_and(c), F.lit(True))


def first_available(levels: Sequence[tuple[str, Column]]) -> tuple[Column, Column]:
    """The first non-null column of ``levels`` and the name of the level it came from."""
    value = F.coalesce(*[c for _, c in levels])
    level = F.coalesce(*[F.when(c.isNotNull(), F.lit(name)) for name, c in levels])
    return value, level
