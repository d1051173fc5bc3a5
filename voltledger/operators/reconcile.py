"""Totals under several conditions side by side, and their distance from published figures."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from voltledger.functions import col, require_columns, sum_or_zero
from voltledger.operators.exact import exact_sums


def reconcile(
    df: DataFrame,
    measures: Mapping[str, tuple[Column, Column | None]],
    differences: Mapping[str, Column],
    exact: bool = False,
) -> DataFrame:
    """One row of sums and of differences between them, from one pass over ``df``.

    ``measures`` maps a name to (what to add up, condition or ``None``); ``differences`` maps a
    name to arithmetic over the measure names and constants. With ``exact`` the sums of floating
    columns do not depend on the order of rows.
    """
    if exact:
        terms = {n: c if on is None else F.when(on, c) for n, (c, on) in measures.items()}
        totals = exact_sums(df, terms)
        return totals.select("*", *[c.alias(name) for name, c in differences.items()])
    totals = df.agg(*[sum_or_zero(c, where).alias(name) for name, (c, where) in measures.items()])
    return totals.select("*", *[c.alias(name) for name, c in differences.items()])


def exclusion_report(df: DataFrame, column: str, values: Sequence[str]) -> DataFrame:
    """One row: how many rows a not-in filter keeps, excludes, and drops because of a null."""
    require_columns(df, [column])
    listed = col(column).isin(list(values))
    return df.agg(
        F.count_if(~listed).alias("n_kept"),
        F.count_if(listed).alias("n_excluded"),
        F.count_if(col(column).isNull()).alias("n_null_dropped"),
    )


def published_totals(spark: SparkSession, totals: Mapping[str, float]) -> DataFrame:
    """Published figures as a frame: ``name``, ``published``."""
    rows = [(name, float(figure)) for name, figure in totals.items()]
    return spark.createDataFrame(rows, "name string, published double")
