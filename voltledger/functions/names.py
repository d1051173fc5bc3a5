"""Column names: quoting, checking and matching. Schema only, never a job."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def quoted(name: str) -> str:
    """A column name as Spark reads it literally, dots and backticks included."""
    return "`" + name.replace("`", "``") + "`"


def col(name: str) -> Column:
    """A top-level column by its literal name."""
    return F.col(quoted(name))


def require_columns(df: DataFrame, names: Iterable[str]) -> None:
    """Raise ``ValueError`` naming every requested column that ``df`` lacks."""
    missing = [name for name in names if name not in df.columns]
    if missing:
        raise ValueError(f"missing columns {missing}; the frame has {df.columns}")


def unused(names: Iterable[str], stem: str) -> str:
    """A column name that is not among ``names``."""
    taken = {name.lower() for name in names}
    while stem.lower() in taken:
        stem = f"_{stem}"
    return stem


def names_containing(df: DataFrame, text: str) -> list[str]:
    """Names of the columns whose name contains ``text`` (case matters), in frame order."""
    return [name for name in df.columns if text in name]
