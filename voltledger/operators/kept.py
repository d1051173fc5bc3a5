"""Profiles that are kept up to date load by load, without reading earlier rows again.

A state is a folder with a subfolder per load, which holds what the load's rows add: counts per key,
slots per group and day, or sketches of distinct values. All of these merge, so that the profile of
everything is the merged state. A load that is added again under its name replaces what it had, so
a load that failed is simply repeated. States have folders within a load that reads can skip: keys
by bucket, slots by month.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voltledger.functions import col, require_columns
from voltledger.operators.series import DAY_MINUTES

# Folders that keys are dealt into; a state has one number of them.
BUCKETS = 256
# A word of slots has so many bits.
WORD_BITS = 60
# Sketches of 2**12 cells: their standard error, and how many of them decide without a count.
SKETCH_BITS = 12
SKETCH_ERROR = 1.04 / 2 ** (SKETCH_BITS / 2)
CLEAR_ERRORS = 5


def _write_load(rows: DataFrame, state: str, load: str, folders: Sequence[str] = ()) -> None:
    if not load or any(sign in load for sign in "/=%"):
        raise ValueError(f"a load cannot be named {load!r}")
    rows.write.mode("overwrite").partitionBy(*folders).parquet(f"{state}/load={load}")


def _read_state(spark: SparkSession, state: str, schema: T.StructType) -> DataFrame:
    whole = T.StructType([*schema.fields, T.StructField("load", T.StringType())])
    return spark.read.schema(whole).parquet(state)


# Keys that occur more than once.


def _key_schema(kind: T.DataType) -> T.StructType:
    return T.StructType().add("key", kind).add("n", "long").add("bucket", "integer")


def _bucket(key: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def add_key_counts(
    state: str, load: str, rows: DataFrame, key: str, buckets: int = BUCKETS
) -> None:
    """Add how often each value of ``key`` occurs in ``rows``; null is a value.

    One combined row per key and task is shuffled, by bucket and key, and a file per bucket written.
    """
    require_columns(rows, [key])
    counts = rows.groupBy(col(key).alias("key")).agg(F.count(F.lit(1)).alias("n"))
    counts = counts.withColumn("bucket", _bucket(F.col("key"), buckets))
    _write_load(counts.repartition("bucket"), state, load, ["bucket"])


def key_counts(
    spark: SparkSession, state: str, kind: T.DataType, buckets: Sequence[int] | None = None
) -> DataFrame:
    """``key, n`` over all loads, of all buckets or of some, whose files alone are read."""
    counts = _read_state(spark, state, _key_schema(kind))
    if buckets is not None:
        counts = counts.where(F.col("bucket").isin(list(buckets)))
    return counts.groupBy("bucket", "key").agg(F.sum("n").alias("n")).select("key", "n")


def duplicated_in_load(
    state: str, rows: DataFrame, key: str, buckets: int = BUCKETS
) -> DataFrame:
    """Those of ``rows``, a load that was added, whose key occurs more than once in all loads.

    A job finds the buckets that the rows have, at most ``buckets`` numbers; of the state only
    those are read.
    """
    require_columns(rows, [key])
    kind = rows.select(col(key)).schema[0].dataType
    found = rows.select(_bucket(col(key), buckets).alias("bucket")).distinct().collect()
    counts = key_counts(rows.sparkSession, state, kind, sorted(row.bucket for row in found))
    repeated = counts.where("n > 1").select(F.col("key").alias("repeated_key"))
    return rows.join(repeated, col(key).eqNullSafe(F.col("repeated_key")), "left_semi")


def kept_duplicates(spark: SparkSession, state: str, kind: T.DataType) -> DataFrame:
    """One row: ``n_keys`` that occur more than once in all loads, and ``n_rows`` that have them."""
    repeated = key_counts(spark, state, kind).where("n > 1")
    return repeated.agg(
        F.count(F.lit(1)).alias("n_keys"), F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows")
    )


# Grids.


def _slot_schema(kind: T.DataType) -> T.StructType:
    made = T.StructType().add("group", kind).add("day", "date").add("word", "integer")
    return made.add("slots", "long").add("n_rows", "long").add("month", "string")


def add_grid_load(
    state: str, load: str, rows: DataFrame, group: str, time: str, step_minutes: int = 30
) -> None:
    """Add the slots that ``rows`` fill, as bits per group and day, in folders by month.

    Only days of the load get rows. Times that are null, or between two slots, fill none.
    """
    require_columns(rows, [group, time])
    if DAY_MINUTES % step_minutes:
        raise ValueError(f"a day has no whole number of steps of {step_minutes} minutes")
    at = col(time).cast("timestamp_ntz")
    day = at.cast("date")
    seconds = F.timestamp_diff("SECOND", day.cast("timestamp_ntz"), at)
    exact = (seconds % (60 * step_minutes) == 0) & (at == F.date_trunc("second", at))
    slot = F.floor(seconds / (60 * step_minutes)).cast("int")
    placed = rows.where(exact).select(
        col(group).alias("group"), day.alias("day"), slot.alias("slot")
    )
    bit = F.pow(F.lit(2.0), F.col("slot") % WORD_BITS).cast("long")
    words = placed.groupBy(
        "group", "day", F.floor(F.col("slot") / WORD_BITS).cast("int").alias("word")
    ).agg(F.bit_or(bit).alias("slots"), F.count(F.lit(1)).alias("n_rows"))
    month = F.date_format("day", "yyyy-MM").alias("month")
    _write_load(words.select("*", month), state, load, ["month"])


def kept_day_completeness(
    spark: SparkSession,
    state: str,
    kind: T.DataType,
    first_day: date,
    last_day: date,
    step_minutes: int = 30,
) -> DataFrame:
    """Per group and day with a row in the period: ``n_rows``, ``n_slots``, ``n_missing``.

    Reads the months of the period. A slot that several loads fill counts once.
    """
    months = (f"{first_day:%Y-%m}", f"{last_day:%Y-%m}")
    words = _read_state(spark, state, _slot_schema(kind)).where(
        F.col("month").between(*months) & F.col("day").between(F.lit(first_day), F.lit(last_day))
    )
    merged = words.groupBy("group", "day", "word").agg(
        F.bit_or("slots").alias("slots"), F.sum("n_rows").alias("n_rows")
    )
    n_slots = F.sum(F.bit_count("slots")).cast("long")
    return merged.groupBy("group", "day").agg(
        F.sum("n_rows").alias("n_rows"),
        n_slots.alias("n_slots"),
        (F.lit(DAY_MINUTES // step_minutes) - n_slots).alias("n_missing"),
    )


# Distinct values.

SKETCHES = T.StructType().add("column", "string").add("sketch", "binary")


def add_sketches(state: str, load: str, rows: DataFrame, columns: Sequence[str]) -> None:
    """Add a sketch of the distinct values of each column: one row per column."""
    require_columns(rows, columns)
    sketches = rows.agg(
        *[
            F.hll_sketch_agg(F.when(col(name).isNotNull(), F.xxhash64(col(name))), SKETCH_BITS)
            .alias(f"s{n}")
            for n, name in enumerate(columns)
        ]
    )
    each = [
        F.struct(F.lit(name).alias("column"), F.col(f"s{n}").alias("sketch"))
        for n, name in enumerate(columns)
    ]
    _write_load(sketches.select(F.inline(F.array(*each))), state, load)


def kept_distinct(spark: SparkSession, state: str) -> DataFrame:
    """``column, estimate, low, high``: distinct non-null values over all loads, and bounds that
    hold but for a chance of one in a million."""
    merged = _read_state(spark, state, SKETCHES).groupBy("column")
    estimate = F.hll_sketch_estimate(F.hll_union_agg("sketch"))
    found = merged.agg(estimate.alias("estimate"))
    spread = CLEAR_ERRORS * SKETCH_ERROR
    return found.select(
        "column",
        "estimate",
        F.floor(F.col("estimate") / (1 + spread)).alias("low"),
        F.ceil(F.col("estimate") / (1 - spread)).alias("high"),
    )


def at_least_distinct(
    spark: SparkSession, state: str, rows: DataFrame, limits: dict[str, int]
) -> DataFrame:
    """``column, reached, counted``: whether each column has ``limit`` distinct values or more.

    The merged sketches decide where their bounds are clear of the limit; only the other columns
    are counted in ``rows``, all rows of all loads, which are otherwise not read.
    """
    require_columns(rows, list(limits))
    bounds = {row.column: row for row in kept_distinct(spark, state).collect()}
    missing = [name for name in limits if name not in bounds]
    if missing:
        raise ValueError(f"there are no sketches of {missing}")
    near = [n for n, least in limits.items() if bounds[n].low < least <= bounds[n].high]
    counts = {}
    if near:
        exact = [F.count_distinct(col(name)).alias(f"c{n}") for n, name in enumerate(near)]
        counts = dict(zip(near, rows.agg(*exact).first()))
    found = [
        (name, counts.get(name, bounds[name].estimate) >= least, name in counts)
        for name, least in limits.items()
    ]
    return spark.createDataFrame(found, "column string, reached boolean, counted boolean")
