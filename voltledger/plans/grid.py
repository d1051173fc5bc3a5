"""Checks of the half-hourly grid series, national and by region."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltledger.functions import names_containing
from voltledger.operators import (
    count_distinct,
    count_per_column,
    grid_balance,
    grid_completeness,
    grid_day_completeness,
    min_max,
    missing_slots,
    null_count,
    status_partition,
    status_period,
)

# Texts and sizes of the published series.
COUNTRY = "France"
CONSOLIDATED = "Données consolidées"
DEFINITIVE = "Données définitives"
N_REGIONS = 12
STEP_MINUTES = 30
DEFINITIVE_PERIOD = (date(2013, 1, 1), date(2023, 12, 31))


def rows_outside_country(national: DataFrame) -> DataFrame:
    return national.filter(F.col("perimetre") != COUNTRY)


def stray_values(regional: DataFrame, column: str = "column_30") -> DataFrame:
    """The values of a column that should be empty."""
    return regional.filter(F.col(column).isNotNull()).select(column)


def rate_null_counts(regional: DataFrame) -> DataFrame:
    """Nulls in each of the cover-rate columns; an error if there is none."""
    return null_count(regional, names_containing(regional, "tco"))


def period(regional: DataFrame) -> DataFrame:
    return min_max(regional, ["date_heure"])


def values_with_status(regional: DataFrame, status: str) -> DataFrame:
    """Non-null values of every column on the rows of one status."""
    return count_per_column(regional.filter(F.col("nature") == status))


def status_coverage(regional: DataFrame) -> DataFrame:
    """Whether every row is consolidated or definitive."""
    return status_partition(regional, "nature", [CONSOLIDATED, DEFINITIVE])


def status_periods(regional: DataFrame) -> DataFrame:
    return status_period(regional, "nature", "date_heure")


def region_count(regional: DataFrame) -> DataFrame:
    return count_distinct(regional, "libelle_region")


def _definitive(regional: DataFrame) -> DataFrame:
    return regional.filter(F.col("nature") == DEFINITIVE)


def definitive_balance(
    regional: DataFrame,
    n_regions: int = N_REGIONS,
    days: tuple[date, date] = DEFINITIVE_PERIOD,
    step_minutes: int = STEP_MINUTES,
) -> DataFrame:
    """Definitive rows against the rows a full grid has."""
    return grid_balance(_definitive(regional), n_regions, *days, step_minutes)


def definitive_completeness(
    regional: DataFrame,
    regions: Sequence[str],
    days: tuple[date, date] = DEFINITIVE_PERIOD,
    step_minutes: int = STEP_MINUTES,
) -> DataFrame:
    """The same by region, by filled slots, so that a repeated slot cannot hide a missing one.

    ``regions`` are those expected; one without a row has all its slots missing. Others that have
    rows come too.
    """
    return grid_completeness(
        _definitive(regional), "libelle_region", "date_heure", *days, step_minutes, regions
    )


def definitive_day_completeness(
    regional: DataFrame,
    regions: Sequence[str],
    days: tuple[date, date] = DEFINITIVE_PERIOD,
    step_minutes: int = STEP_MINUTES,
) -> DataFrame:
    """The same by region and day."""
    return grid_day_completeness(
        _definitive(regional), "libelle_region", "date_heure", *days, step_minutes, regions
    )


def definitive_missing_slots(
    regional: DataFrame,
    regions: Sequence[str],
    days: tuple[date, date] = DEFINITIVE_PERIOD,
    step_minutes: int = STEP_MINUTES,
) -> DataFrame:
    """Every missing half hour of every region, expected or found."""
    return missing_slots(
        _definitive(regional), "libelle_region", "date_heure", *days, step_minutes, regions
    )
