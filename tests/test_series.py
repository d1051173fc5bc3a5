"""The grid checks on two regions and three days around a leap day, with planted faults."""

from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tests.frames import rows, sorted_tuples
from voltledger import operators as ops
from voltledger.functions import days_between
from voltledger.plans import grid

DAYS = (date(2024, 2, 28), date(2024, 3, 1))
REGIONS = ["Bretagne", "Normandie"]
START = datetime(2024, 2, 28)
SCHEMA = "date_heure timestamp_ntz, nature string, libelle_region string, column_30 string, tco_gaz double"


def slot(number):
    return START + timedelta(minutes=30 * number)


@pytest.fixture(scope="module")
def series(spark):
    data = [
        (slot(i), grid.DEFINITIVE, region, None, 1.0)
        for region in ("Bretagne", "Normandie")
        for i in range(144)
        if (region, i) not in {("Bretagne", 60), ("Normandie", 0), ("Normandie", 143)}
    ]
    data += [
        (slot(3) + timedelta(minutes=29, seconds=59), grid.DEFINITIVE, "Bretagne", "x", None),
        (slot(5), grid.CONSOLIDATED, "Bretagne", None, None),
        (slot(6), None, "Bretagne", None, 1.0),
        (slot(7), "Données temps réel", "Bretagne", None, 1.0),
        (slot(144), grid.DEFINITIVE, "Bretagne", None, 1.0),
    ]
    return spark.createDataFrame(data, SCHEMA)


def test_status_coverage(series):
    assert rows(grid.status_coverage(series)) == [(290, 1, 287, 2, False)]
    covered = series.filter(F.col("nature").isin(grid.CONSOLIDATED, grid.DEFINITIVE))
    assert rows(grid.status_coverage(covered)) == [(288, 1, 287, 0, True)]


def test_status_periods(series):
    got = {row[0]: row[1:] for row in rows(grid.status_periods(series))}
    assert got[grid.DEFINITIVE] == (slot(0), slot(144), 287)
    assert got[grid.CONSOLIDATED] == (slot(5), slot(5), 1)
    assert got[None] == (slot(6), slot(6), 1)
    assert len(got) == 4


def test_a_repeated_slot_does_not_hide_a_missing_one(series):
    got = sorted_tuples(grid.definitive_completeness(series, REGIONS, DAYS))
    assert got == [("Bretagne", 144, 143, 144, 1), ("Normandie", 142, 142, 144, 2)]


def test_an_expected_region_without_rows_is_missing_whole(series):
    regions = [*REGIONS, "Corse"]
    got = sorted_tuples(grid.definitive_completeness(series, regions, DAYS))
    assert ("Corse", 0, 0, 144, 144) in got and len(got) == 3
    slots = grid.definitive_missing_slots(series, regions, DAYS)
    assert slots.filter("libelle_region = 'Corse'").count() == 144
    days = grid.definitive_day_completeness(series, regions, DAYS)
    got = {tuple(row)[:2]: tuple(row)[2:] for row in days.collect()}
    assert len(got) == 9 and all(n + missing == 48 == expected for n, expected, missing in got.values())
    assert [got["Corse", day][0] for day in sorted(d for r, d in got if r == "Corse")] == [0, 0, 0]
    assert sum(missing for _, _, missing in got.values()) == 144 + 3


@pytest.mark.parametrize("name", ["day", "number", "slot_", "n", "__slo", "SEEN"])
def test_the_group_may_have_any_name(spark, name):
    df = spark.createDataFrame([(START, "a"), (START, None)], f"t timestamp_ntz, `{name}` string")
    day = DAYS[0]
    assert ops.grid_completeness(df, name, "t", day, day, 60).count() == 2
    assert ops.missing_slots(df, name, "t", day, day, 60).columns == [name, "slot"]
    assert ops.missing_slots(df, name, "t", day, day, 60).count() == 46


def test_group_names_that_clash_with_the_result(spark):
    for name, check in (
        ("slot", ops.missing_slots),
        ("n_slots", ops.grid_completeness),
        ("day", ops.grid_day_completeness),
    ):
        df = spark.createDataFrame([(START, "a")], f"t timestamp_ntz, {name} string")
        with pytest.raises(ValueError, match="cannot be named"):
            check(df, name, "t", DAYS[0], DAYS[0], 60)


def test_plain_balance(series):
    assert rows(grid.definitive_balance(series, 2, DAYS)) == [(287, 288, -1)]


def test_missing_slots(series):
    got = sorted_tuples(grid.definitive_missing_slots(series, REGIONS, DAYS))
    assert got == [("Bretagne", slot(60)), ("Normandie", slot(0)), ("Normandie", slot(143))]


def test_named_groups_without_rows_are_missing_whole(series):
    per_group = ops.grid_completeness(
        series, "libelle_region", "date_heure", *DAYS, groups=["Bretagne", "Corse"]
    )
    got = {row[0]: row[1:] for row in rows(per_group)}
    assert got["Corse"] == (0, 0, 144, 144)
    assert set(got) == {"Bretagne", "Normandie", "Corse"}
    slots = ops.missing_slots(series, "libelle_region", "date_heure", *DAYS, groups=["Corse"])
    assert slots.filter("libelle_region = 'Corse'").count() == 144


def test_null_group_is_a_group(spark):
    df = spark.createDataFrame([(START, None), (START, None)], "t timestamp_ntz, g string")
    day = DAYS[0]
    assert rows(ops.grid_completeness(df, "g", "t", day, day, 60)) == [(None, 2, 1, 24, 23)]
    assert ops.missing_slots(df, "g", "t", day, day, 60).count() == 23


def test_zoned_timestamps(spark):
    df = spark.sql("SELECT TIMESTAMP '2024-02-28 05:31:12.5' AS t, 'a' AS g")
    got = ops.missing_slots(df, "g", "t", DAYS[0], DAYS[0], 30)
    assert got.schema["slot"].dataType.simpleString() == "timestamp_ntz"
    assert got.count() == 47
    assert got.filter("slot = TIMESTAMP_NTZ '2024-02-28 05:30:00'").count() == 0
    assert ops.missing_slots(df, "g", "t", DAYS[0], DAYS[0], 24 * 60).count() == 0


def test_days_before_1970(spark):
    df = spark.sql("SELECT TIMESTAMP_NTZ '1960-02-29 23:59:59' AS t, 'a' AS g")
    day = date(1960, 2, 29)
    assert rows(ops.grid_completeness(df, "g", "t", day, day, 30)) == [("a", 1, 1, 48, 47)]
    got = ops.missing_slots(df, "g", "t", day, day, 30)
    assert got.filter("slot = TIMESTAMP_NTZ '1960-02-29 23:30:00'").count() == 0


def test_definitive_grid_of_the_published_series(spark):
    """48 slots, 12 regions, 2013 to 2023 with their leap years."""
    empty = spark.createDataFrame([], SCHEMA)
    assert rows(grid.definitive_balance(empty)) == [(0, 48 * 12 * 4017, -48 * 12 * 4017)]


def test_bad_grids_are_refused(spark):
    empty = spark.createDataFrame([], SCHEMA)
    with pytest.raises(ValueError, match="does not divide"):
        ops.grid_balance(empty, 1, *DAYS, step_minutes=7)
    with pytest.raises(ValueError, match="before it starts"):
        ops.grid_balance(empty, 1, *reversed(DAYS))


def test_calendar_days(spark):
    df = spark.sql("SELECT DATE '2013-01-01' AS a, DATE '2023-12-31' AS b")
    assert rows(df.select(days_between(F.col("a"), F.col("b")))) == [(4017,)]


def test_other_grid_checks(series):
    assert rows(grid.stray_values(series)) == [("x",)]
    assert rows(grid.rate_null_counts(series)) == [(2,)]
    assert rows(grid.period(series)) == [(slot(0), slot(144))]
    assert rows(grid.region_count(series)) == [(2,)]
    assert rows(grid.values_with_status(series, grid.CONSOLIDATED)) == [(1, 1, 1, 0, 0)]


def test_rows_outside_country(spark):
    df = spark.createDataFrame([("France",), ("Corse",), (None,)], "perimetre string")
    assert rows(grid.rows_outside_country(df)) == [("Corse",)]
