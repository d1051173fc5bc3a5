"""Profiles of Parquet files from their footers, without reading a column.

Spark answers counts, and the least and greatest of some types, from the footers of Parquet files
when its newer reader is used with aggregate pushdown. Both are settings of a session, so a session
of its own, on the same context, asks. Everything that footers cannot be trusted with is read from
the columns instead, and only those columns: bounds of floating columns (a footer may leave out NaN,
and gives zero a sign), of texts (which it may cut short), of times and decimals, and counts of
nested columns. Files without the statistics that are needed are read in full.
"""

from __future__ import annotations

from collections.abc import Sequence

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voltledger.functions import col, require_columns

PUSHDOWN = "spark.sql.parquet.aggregatePushdown"
BOUNDED = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.DateType, T.BooleanType)
NESTED = (T.ArrayType, T.MapType, T.StructType)


def footer_reader(spark: SparkSession, path: str) -> DataFrame:
    """The files as a frame whose aggregates Spark takes from the footers where it can."""
    side = spark.newSession()
    for name in ("spark.sql.session.timeZone", "spark.sql.ansi.enabled"):
        side.conf.set(name, spark.conf.get(name))
    side.conf.set("spark.sql.sources.useV1SourceList", "")
    side.conf.set(PUSHDOWN, "true")
    return side.read.parquet(path)


def _counts(schema: T.StructType, columns: Sequence[str], stored: bool) -> dict[str, Column]:
    """The counts that footers have, with that of the rows, or those that they do not have."""
    made = {"n_rows": F.count(F.lit(1))} if stored else {}
    for name in columns:
        if isinstance(schema[name].dataType, NESTED) != stored:
            made[f"{name}_values"] = F.count(col(name))
    return made


def _bounds(schema: T.StructType, columns: Sequence[str], stored: bool) -> dict[str, Column]:
    """The least and greatest values that footers have, or those that they do not have."""
    made = {}
    for name in columns:
        if isinstance(schema[name].dataType, BOUNDED) == stored:
            made[f"{name}_min"], made[f"{name}_max"] = F.min(col(name)), F.max(col(name))
    return made


def _aggregated(df: DataFrame, measures: dict[str, Column]) -> DataFrame:
    return df.agg(*[c.alias(name) for name, c in measures.items()])


def footer_aggregate(
    spark: SparkSession, path: str, columns: Sequence[str] = (), bounds: Sequence[str] = ()
) -> DataFrame:
    """One row of what the footers of ``stored_profile`` give, not run yet."""
    df = footer_reader(spark, path)
    return _aggregated(df, _counts(df.schema, columns, True) | _bounds(df.schema, bounds, True))


def _from_footers(spark, path, columns, bounds) -> dict | None:
    """The measures in the footers, or None if a file lacks one of them."""
    try:
        return footer_aggregate(spark, path, columns, bounds).first().asDict()
    except (PySparkException, Py4JJavaError) as error:
        # What Spark says where a statistic is missing names the setting.
        if PUSHDOWN in str(error):
            return None
        raise


def stored_profile(
    spark: SparkSession,
    path: str,
    columns: Sequence[str] | None = None,
    bounds: Sequence[str] = (),
) -> DataFrame:
    """One row: ``n_rows``; ``<column>_values`` and ``<column>_nulls`` of the columns, all if not
    said; ``<column>_min`` and ``<column>_max`` of those in ``bounds``.

    Runs at once: a job over the footers, and one over the columns if any measure needs them. A
    file whose values are all null has no bounds in its footer; then bounds are read, not counts.
    """
    df = spark.read.parquet(path)
    columns = df.columns if columns is None else list(columns)
    require_columns(df, [*columns, *bounds])
    read = _counts(df.schema, columns, False) | _bounds(df.schema, bounds, False)
    found = _from_footers(spark, path, columns, bounds)
    if found is None and bounds:
        found = _from_footers(spark, path, columns, ())
        read |= _bounds(df.schema, bounds, True)
    if found is None:
        read |= _counts(df.schema, columns, True)
    found = found or {}
    if read:
        found |= _aggregated(df, read).first().asDict()
    # Without a single file, counts from footers add up to null.
    n_rows = found["n_rows"] or 0
    schema, row = T.StructType().add("n_rows", "long"), [n_rows]
    for name in columns:
        values = found[f"{name}_values"] or 0
        schema = schema.add(f"{name}_values", "long").add(f"{name}_nulls", "long")
        row += [values, n_rows - values]
    for name in bounds:
        kind = df.schema[name].dataType
        schema = schema.add(f"{name}_min", kind).add(f"{name}_max", kind)
        row += [found[f"{name}_min"], found[f"{name}_max"]]
    return spark.createDataFrame([tuple(row)], schema)
