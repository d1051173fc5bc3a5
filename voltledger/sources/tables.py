"""Catalog tables: create, insert one row, append many, read in order."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voltledger.functions import col, quoted, require_columns, unused
from voltledger.session import staged
from voltledger.sources.claims import BLOCK, claim_ids

# The row offsets of a batch, one per staged file, are broadcast up to this many files.
BROADCAST_FILES = 100_000


def _name(table: str) -> str:
    """A table name, with its catalog and database if it has them, fit for SQL."""
    return table if "`" in table else ".".join(quoted(part) for part in table.split("."))


def _literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def create_table(
    spark: SparkSession,
    table: str,
    schema: T.StructType,
    location: str | None = None,
    id_column: str | None = None,
    load_column: str | None = None,
) -> None:
    """Create an empty Parquet table; an error if it is there already.

    Ids of ``id_column`` start at 1, and the next one is kept as a property of the table. A
    ``load_column`` is added behind the others; the table is parted by it, which is what several
    writers at once need (``append_claimed``).
    """
    if load_column is not None:
        schema = T.StructType([*schema.fields, T.StructField(load_column, T.StringType())])
    columns = ", ".join(f"{quoted(f.name)} {f.dataType.simpleString()}" for f in schema.fields)
    place = "" if location is None else f" LOCATION {_literal(location)}"
    parted = "" if load_column is None else f" PARTITIONED BY ({quoted(load_column)})"
    spark.sql(f"CREATE TABLE {_name(table)} ({columns}) USING parquet{parted}{place}")
    if id_column is not None:
        require_columns(spark.table(table), [id_column])
        _keep_next_id(spark, table, id_column, 1)


def _property(id_column: str) -> str:
    return f"next_id.{id_column}"


def _next_id(spark: SparkSession, table: str, id_column: str) -> int:
    """The id after the last one given. Only a table that has never had an id from here, and was
    not created with ``id_column``, has its ids read for it."""
    properties = spark.sql(f"SHOW TBLPROPERTIES {_name(table)}").collect()
    known = {row["key"]: row["value"] for row in properties}.get(_property(id_column))
    if known is not None:
        return int(known)
    return spark.table(table).agg(F.coalesce(F.max(col(id_column)), F.lit(0))).first()[0] + 1


def _keep_next_id(spark: SparkSession, table: str, id_column: str, next_id: int) -> None:
    key, value = _literal(_property(id_column)), _literal(str(next_id))
    spark.sql(f"ALTER TABLE {_name(table)} SET TBLPROPERTIES ({key} = {value})")


def insert_row(
    spark: SparkSession, table: str, values: Mapping[str, object], id_column: str | None = None
) -> None:
    """Insert one row of bound values; columns not given are null, ``id_column`` gets the next id."""
    values = dict(values)
    next_id = None
    if id_column is not None:
        next_id = _next_id(spark, table, id_column)
        values[id_column] = next_id
    require_columns(spark.table(table), values)
    if next_id is not None:
        _keep_next_id(spark, table, id_column, next_id + 1)
    names = ", ".join(quoted(name) for name in values)
    marks = ", ".join("?" for _ in values)
    spark.sql(f"INSERT INTO {_name(table)} ({names}) VALUES ({marks})", args=list(values.values()))


def _offsets(rows: DataFrame, file: str, before: str) -> DataFrame:
    """Per file, the rows in the files written before it. Only these, one row per file, are put
    in one order."""
    write_order = [F.regexp_extract(file, r"^part-(\d+)", 1).cast("int"), F.col(file)]
    earlier = Window.orderBy(*write_order).rowsBetween(Window.unboundedPreceding, -1)
    counts = rows.groupBy(F.col("_metadata.file_name").alias(file)).agg(F.count("*").alias("n"))
    return counts.select(file, "n", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias(before))


def append_rows(
    table: str,
    batch: DataFrame,
    id_column: str | None = None,
    order_by: Sequence[str] = (),
    order_ties: Sequence[str] = (),
    broadcast_files: int = BROADCAST_FILES,
) -> None:
    """Append ``batch`` to ``table``; table columns it lacks are filled with nulls.

    With ``id_column`` the rows get consecutive ids after the last one given, in the order of
    ``order_by`` if given; ``order_ties`` are further columns by which a value that holds a large
    part of the rows is split over tasks. The next id is a property of the table, set before the
    rows are written: an append that fails leaves a gap, never an id given twice. Two writers at
    once would give out the same ids: one at a time, and ids from nowhere else.

    Numbering costs a second write: the batch is written to the shared folder first, and removed
    from there at the end. A row's id is the number of rows in the files before its own plus its
    place in its file; both are fixed by what was written, so that a task that runs again gives
    the same ids. The rows before each file are broadcast if there are at most ``broadcast_files``
    files; beyond, the rows are shuffled by file.
    """
    spark = batch.sparkSession
    target = spark.table(table)
    extra = [name for name in batch.columns if name not in target.columns]
    if extra:
        raise ValueError(f"columns {extra} are not in {table}, which has {target.columns}")
    if id_column is None:
        _insert(table, target, batch)
        return
    require_columns(target, [id_column])
    if id_column in batch.columns:
        raise ValueError(f"{id_column} is assigned on append and cannot be in the batch")
    if order_by:
        order = [F.asc_nulls_last(col(name)) for name in (*order_by, *order_ties)]
        batch = batch.orderBy(*order)
    names = [*batch.columns, id_column]
    file, place, before = (unused(names, stem) for stem in ("file_name", "row_index", "rows_before"))
    with staged(batch, "append") as rows:
        offsets = _offsets(rows, file, before)
        n_files, n_rows = offsets.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
        first_id = _next_id(spark, table, id_column)
        _keep_next_id(spark, table, id_column, first_id + n_rows)
        if n_files <= broadcast_files:
            offsets = F.broadcast(offsets)
        placed = rows.select(
            "*",
            F.col("_metadata.file_name").alias(file),
            F.col("_metadata.row_index").alias(place),
        )
        numbered = placed.join(offsets.drop("n"), file).select(
            (F.col(before) + F.col(place) + first_id).alias(id_column),
            *[col(name) for name in batch.columns],
        )
        _insert(table, target, numbered)


def _location(spark: SparkSession, table: str) -> str:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {_name(table)}").collect()
    return next(row["data_type"] for row in rows if row["col_name"] == "Location").rstrip("/")


def append_claimed(
    table: str,
    batch: DataFrame,
    claims: str,
    id_column: str,
    load_column: str,
    size: int = BLOCK,
    broadcast_files: int = BROADCAST_FILES,
) -> str:
    """Append ``batch`` with ids that no other writer has, while others append as well.

    The rows are written to the shared folder and counted; then blocks of ``size`` ids are claimed
    in the folder ``claims`` (``claim_ids``) and given out by a row's place in what was written, so
    that a task that runs again gives the same ids. Ids are unique, not consecutive between
    writers. Each writer writes a folder of its own, which becomes a partition of the table, named
    in ``load_column``, when it is whole: readers see all rows of a load or none, and a writer that
    fails leaves nothing but unused ids. Returns the name of the load.
    """
    spark = batch.sparkSession
    target = spark.table(table)
    require_columns(target, [id_column, load_column])
    own = [name for name in target.columns if name not in (id_column, load_column)]
    extra = [name for name in batch.columns if name not in own]
    if extra:
        raise ValueError(f"columns {extra} are not in {table}, or are set on append")
    names = [*batch.columns, id_column]
    file, place, before = (unused(names, stem) for stem in ("file_name", "row_index", "rows_before"))
    load = uuid.uuid4().hex
    with staged(batch, "append") as rows:
        offsets = _offsets(rows, file, before)
        n_files, n_rows = offsets.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
        if not n_rows:
            return load
        # One number per claimed block.
        firsts = F.array(*[F.lit(first) for first in claim_ids(spark, claims, n_rows, size)])
        if n_files <= broadcast_files:
            offsets = F.broadcast(offsets)
        rank = F.col(before) + F.col(place)
        block = F.floor(rank / size).cast("int")
        given = rows.select(
            "*",
            F.col("_metadata.file_name").alias(file),
            F.col("_metadata.row_index").alias(place),
        ).join(offsets.drop("n"), file)
        given = given.withColumn(id_column, F.get(firsts, block) + rank % size)
        filled = [
            (col(f.name) if f.name in names else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in target.schema.fields
            if f.name != load_column
        ]
        given.select(filled).write.parquet(f"{_location(spark, table)}/{load_column}={load}")
    spark.sql(
        f"ALTER TABLE {_name(table)} ADD PARTITION ({quoted(load_column)} = {_literal(load)})"
    )
    return load


def _insert(table: str, target: DataFrame, rows: DataFrame) -> None:
    filled = [
        (col(f.name) if f.name in rows.columns else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in target.schema.fields
    ]
    rows.select(filled).write.insertInto(table)


def read_ordered(
    spark: SparkSession,
    table: str,
    columns: Sequence[str],
    order_by: str,
    tie_break: Sequence[str] = (),
) -> DataFrame:
    """Chosen columns of a table in ascending order of ``order_by``, nulls last.

    The ranges of the sort can cut through a value that holds a large part of the rows: by a fine
    ``tie_break`` (the id, say), or without one by a row's place in the files of the table, which
    is also the order of equal values.
    """
    source = spark.table(table)
    require_columns(source, [*columns, order_by, *tie_break])
    if tie_break:
        order = [F.asc_nulls_last(col(name)) for name in (order_by, *tie_break)]
        return source.orderBy(*order).select([col(name) for name in columns])
    file, row = (unused(source.columns, stem) for stem in ("file_name", "row_index"))
    placed = source.select(
        *{name: col(name) for name in (*columns, order_by)}.values(),
        F.xxhash64("_metadata.file_path").alias(file),
        F.col("_metadata.row_index").alias(row),
    )
    ordered = placed.orderBy(F.asc_nulls_last(col(order_by)), file, row)
    return ordered.select([col(name) for name in columns])
