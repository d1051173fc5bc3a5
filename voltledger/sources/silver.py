"""Selection and renaming of columns by a map."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

from voltledger.functions import col, require_columns


def project(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """The columns of ``names`` in its order, renamed source to target; an empty target keeps the name."""
    require_columns(df, names)
    return df.select([col(source).alias(target or source) for source, target in names.items()])
