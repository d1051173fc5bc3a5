"""Checks of regular time series: status coverage, periods, and completeness of the time grid.

Slots are counted on the clock of timestamps without a zone, and on the session's clock for those
with one. On a UTC clock every day has all its slots; on a local clock some are missing or come
twice on the two days of the time change.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voltledger.functions import col, quoted, require_columns

DAY_MINUTES = 24 * 60


def _slots_per_day(step_minutes: int) -> int:
    if step_minutes <= 0 or DAY_MINUTES % step_minutes:
        raise ValueError(f"a step of {step_minutes} minutes does not divide a day")
    return DAY_MINUTES // step_minutes


def _days(first_day: date, last_day: date) -> int:
    if last_day < first_day:
        raise ValueError(f"the period ends on {last_day}, before it starts on {first_day}")
    return (last_day - first_day).days + 1


# Columns that are added on the way; a frame cannot have them.
SLOT, DAY, NUMBER, SEEN = "__slot", "__day", "__number", "__seen"


def _require_free(group: str, made: Sequence[str]) -> None:
    if group in made:
        raise ValueError(f"the group column cannot be named {group}, as a column beside it is")


def _filled(
    df: DataFrame, group: str, time: str, first_day: date, last_day: date, step_minutes: int
) -> DataFrame:
    """``group`` and the start of the slot of every row in the period."""
    slot = F.window(col(time).cast("timestamp_ntz"), f"{step_minutes} minutes")["start"]
    rows = df.filter(_in_period(col(time), first_day, last_day))
    return rows.select(col(group).alias(group), slot.alias(SLOT))


def _in_period(time: Column, first_day: date, last_day: date) -> Column:
    after = F.lit(last_day + timedelta(days=1))
    return (time >= F.lit(first_day)) & (time < after)


def status_partition(df: DataFrame, status: str, statuses: Sequence[str]) -> DataFrame:
    """One row: rows in all, rows per listed status, and rows no listed status covers.

    Columns ``n_rows``, ``n_<position>`` from 1 on, ``n_uncovered`` and ``is_covered``. A null
    status, or one not listed, is uncovered.
    """
    require_columns(df, [status])
    counts = [
        F.count_if(col(status) == value).alias(f"n_{i}") for i, value in enumerate(statuses, 1)
    ]
    covered = sum((F.col(f"n_{i}") for i in range(1, len(statuses) + 1)), F.lit(0))
    return (
        df.agg(F.count(F.lit(1)).alias("n_rows"), *counts)
        .withColumn("n_uncovered", F.col("n_rows") - covered)
        .withColumn("is_covered", F.col("n_uncovered") == 0)
    )


def status_period(df: DataFrame, status: str, time: str) -> DataFrame:
    """Per status (null included): first and last time and the number of rows."""
    require_columns(df, [status, time])
    return df.groupBy(col(status).alias(status)).agg(
        F.min(col(time)).alias("first_time"),
        F.max(col(time)).alias("last_time"),
        F.count(F.lit(1)).alias("n_rows"),
    )


def grid_balance(
    df: DataFrame, n_groups: int, first_day: date, last_day: date, step_minutes: int = 30
) -> DataFrame:
    """One row: rows found, rows a full grid has, and their difference, by plain row count."""
    expected = _slots_per_day(step_minutes) * n_groups * _days(first_day, last_day)
    return df.agg(F.count(F.lit(1)).alias("n_rows")).select(
        "n_rows",
        F.lit(expected).cast("long").alias("n_expected"),
        (F.col("n_rows") - expected).alias("n_difference"),
    )


def grid_completeness(
    df: DataFrame,
    group: str,
    time: str,
    first_day: date,
    last_day: date,
    step_minutes: int = 30,
    groups: Sequence[str] | None = None,
) -> DataFrame:
    """Per group: rows in the period, slots filled, slots a full grid has, and slots missing.

    The groups are those with a row in the period, and those named in ``groups``. Slots are
    counted by group and slot together, so that one large group is spread over all tasks.
    """
    require_columns(df, [group, time])
    _require_free(group, ("n_rows", "n_slots", "n_expected", "n_missing"))
    expected = _slots_per_day(step_minutes) * _days(first_day, last_day)
    filled = _filled(df, group, time, first_day, last_day, step_minutes)
    per_slot = filled.groupBy(col(group), SLOT).agg(F.count(F.lit(1)).alias(NUMBER))
    if groups is not None:
        per_slot = per_slot.unionByName(
            _named_groups(df, group, groups).select(
                "*", F.lit(None).cast("timestamp_ntz").alias(SLOT), F.lit(0).alias(NUMBER)
            )
        )
    n_slots = F.count(F.col(SLOT))
    return per_slot.groupBy(col(group)).agg(
        F.sum(NUMBER).alias("n_rows"),
        n_slots.alias("n_slots"),
        F.lit(expected).cast("long").alias("n_expected"),
        (F.lit(expected) - n_slots).alias("n_missing"),
    )


def _named_groups(df: DataFrame, group: str, groups: Sequence[str]) -> DataFrame:
    return df.sparkSession.createDataFrame(
        [(g,) for g in groups], T.StructType([T.StructField(group, df.schema[group].dataType)])
    )


def _calendar(
    df: DataFrame,
    group: str,
    time: str,
    first_day: date,
    last_day: date,
    step_minutes: int,
    groups: Sequence[str] | None,
) -> DataFrame:
    """Per group and day of the period, the numbers of the slots that have a row.

    The groups are those with a row in the period, and those named in ``groups``. Rows are read
    and shuffled once, by group and day, with the slots of a day combined before; the array of a
    day is no longer than its slots.
    """
    filled = _filled(df, group, time, first_day, last_day, step_minutes)
    start = F.lit(first_day).cast("timestamp_ntz")
    minute = F.timestamp_diff("MINUTE", start, F.col(SLOT))
    per_day = (
        filled.filter(F.col(SLOT).isNotNull())
        .select(
            col(group),
            F.floor(minute / DAY_MINUTES).cast("int").alias(DAY),
            (F.pmod(minute, F.lit(DAY_MINUTES)) / step_minutes).cast("int").alias(NUMBER),
        )
        .groupBy(col(group), DAY)
        .agg(F.collect_set(NUMBER).alias(SEEN))
    )
    # The condition always holds. It keeps the array in the plan, so that this is the same shuffle.
    known = per_day.filter(F.size(SEEN) > 0).select(col(group))
    if groups is not None:
        known = known.unionByName(_named_groups(df, group, groups))
    day = F.explode(F.sequence(F.lit(0), F.lit(_days(first_day, last_day) - 1)))
    whole = known.distinct().select(col(group).alias(group), day.alias(DAY))
    same = whole[quoted(group)].eqNullSafe(per_day[quoted(group)])
    same = same & whole[DAY].eqNullSafe(per_day[DAY])  # not ==, which would add a filter below
    nothing = F.array().cast("array<int>")
    return whole.join(per_day, same, "left").select(
        whole[quoted(group)].alias(group), whole[DAY], F.coalesce(SEEN, nothing).alias(SEEN)
    )


def grid_day_completeness(
    df: DataFrame,
    group: str,
    time: str,
    first_day: date,
    last_day: date,
    step_minutes: int = 30,
    groups: Sequence[str] | None = None,
) -> DataFrame:
    """Per group and day of the period: slots filled, slots a full day has, and slots missing.

    The groups are those with a row in the period, and those named in ``groups``; days without a
    row are there too.
    """
    require_columns(df, [group, time])
    _require_free(group, ("day", "n_slots", "n_expected", "n_missing"))
    expected = _slots_per_day(step_minutes)
    calendar = _calendar(df, group, time, first_day, last_day, step_minutes, groups)
    n_slots = F.size(SEEN).cast("long")
    return calendar.select(
        col(group),
        F.date_add(F.lit(first_day), F.col(DAY)).alias("day"),
        n_slots.alias("n_slots"),
        F.lit(expected).cast("long").alias("n_expected"),
        (F.lit(expected) - n_slots).alias("n_missing"),
    )


def missing_slots(
    df: DataFrame,
    group: str,
    time: str,
    first_day: date,
    last_day: date,
    step_minutes: int = 30,
    groups: Sequence[str] | None = None,
) -> DataFrame:
    """Every (group, slot) of the full grid that has no row: ``group``, ``slot``.

    The groups are those with a row in the period, and those named in ``groups``. A day's missing
    slots are what its filled ones leave of a full day; only these are made into rows.
    """
    require_columns(df, [group, time])
    _require_free(group, ("slot",))
    full = F.sequence(F.lit(0), F.lit(_slots_per_day(step_minutes) - 1))
    calendar = _calendar(df, group, time, first_day, last_day, step_minutes, groups)
    missing = calendar.select(
        col(group), DAY, F.explode(F.array_except(full, F.col(SEEN))).alias(NUMBER)
    )
    start = F.lit(first_day).cast("timestamp_ntz")
    after_start = F.make_dt_interval(days=F.col(DAY), mins=F.col(NUMBER) * step_minutes)
    return missing.select(col(group).alias(group), (start + after_start).alias("slot"))
