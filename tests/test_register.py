"""The register analyses on hand-written rows, with answers worked out by hand."""

import math
from datetime import date

import pytest

from tests.frames import REGISTER_ROWS, REGISTER_SCHEMA, rows, sorted_tuples
from voltledger.plans import register as reg

FIELDS = {
    "codeeicresourceobject": "string",
    "region": "string",
    "filiere": "string",
    "technologie": "string",
    "regime": "string",
    "nbinstallations": "long",
    "puismaxinstallee": "double",
    "puismaxcharge": "double",
    "puismaxraccharge": "double",
    "datemiseenservice": "string",
    "codeiris": "string",
    "codeinseecommune": "string",
    "nominstallation": "string",
}
INSTALLATIONS = [
    ("A", "Bretagne", "Solaire", "Photovoltaïque", "En service", 1, 60.0, 5.0, 1.0, "01/03/2025", "i1", "c1", "a"),
    ("B", "Bretagne", "Eolien", None, "En retrait provisoire", 1, 30.0, 1.0, None, "2025-06-01", None, None, "b"),
    ("C", "Guyane", "Solaire", "Photovoltaïque", "En service", 1, 100.0, 7.0, 2.0, "01/03/2025", "i2", "c2", "c"),
    (None, "Normandie", "Solaire", "Photovoltaïque", "En service", 9, 10.0, None, 3.0, "2020-01-01", None, "c3", "d"),
    ("", "Normandie", "Gaz", "Autre", None, 2, 4.0, 2.0, 4.0, "31/12/2025", None, None, "e"),
    ("D", None, "Gaz", "Autre", "En service", 1, 1000.0, 9.0, 9.0, "01/01/2025", "i3", "c4", "f"),
]


@pytest.fixture(scope="module")
def installations(spark):
    schema = ", ".join(f"{name} {kind}" for name, kind in FIELDS.items())
    return spark.createDataFrame(INSTALLATIONS, schema)


@pytest.fixture(scope="module")
def edge_rows(spark):
    return spark.createDataFrame(REGISTER_ROWS, REGISTER_SCHEMA)


def test_reconciliation(installations):
    got = reg.reconciliation(installations).first().asDict()
    assert got == {
        "power": 1204.0,
        "charge": 24.0,
        "mainland_power": 104.0,
        "mainland_charge": 8.0,
        "mainland_connected_charge": 8.0,
        "mainland_power_text_year": 64.0,
        "mainland_power_date_year": 94.0,
        "power_less_charge": 1180.0,
        "power_less_charge_withdrawn": 1180.0 - 1_101_500,
        "mainland_less_charge": 96.0,
        "mainland_less_charge_withdrawn": 96.0 - 1_101_500,
        "mainland_less_aggregated": 104.0 - 5_648_319.464,
        "mainland_less_text_year": 40.0,
        "mainland_less_both_charges": 88.0,
        "published_power": 161_959.0,
        "mainland_less_published": 104.0 - 161_959_000.0,
    }


def test_reconciliation_with_other_figures(installations):
    got = reg.reconciliation(installations, published={"a": 0.5, "b": 1}, published_unit=2).first()
    assert got["published_power"] == 1.5
    assert got["mainland_less_published"] == got["mainland_power"] - 3


def test_reconciliation_of_nothing(installations):
    got = reg.reconciliation(installations.limit(0)).first()
    assert got["power"] == 0.0 and got["mainland_less_both_charges"] == 0.0


def test_mainland_drops_rows_without_region(installations):
    assert sorted_tuples(reg.mainland(installations).select("nominstallation")) == [
        ("a",),
        ("b",),
        ("d",),
        ("e",),
    ]
    assert rows(reg.region_exclusions(installations)) == [(4, 1, 1)]


def test_three_readings_of_an_aggregate(installations):
    def names(condition):
        return [r[0] for r in sorted_tuples(installations.filter(condition).select("nominstallation"))]

    assert names(reg.has_no_code()) == ["d"]
    assert names(~reg.has_code_text()) == ["e"]
    assert names(reg.covers_several()) == ["d", "e"]


def test_shares(installations):
    # The empty code is a code for the first reading and not for the second.
    assert rows(reg.fuel_share_with_code(installations)) == [
        ("Solaire", 60.0, 63.83),
        ("Eolien", 30.0, 31.91),
        ("Gaz", 4.0, 4.26),
    ]
    assert rows(reg.fuel_share_with_code_text(installations)) == [
        ("Gaz", 1000.0, 84.03),
        ("Solaire", 160.0, 13.45),
        ("Eolien", 30.0, 2.52),
    ]
    names = reg.fuel_share_with_code(installations).columns
    assert names == ["filiere", "puismaxinstallee", "puismaxinstalle_pourcentage"]


def test_groups(installations):
    assert sorted_tuples(reg.installations_by_fuel(installations)) == [
        ("Eolien", 1),
        ("Gaz", 3),
        ("Solaire", 11),
    ]
    assert rows(reg.mainland_power_by_fuel(installations)) == [
        ("Solaire", 70.0),
        ("Eolien", 30.0),
        ("Gaz", 4.0),
    ]
    assert rows(reg.technology_power_without_code(installations)) == [("Photovoltaïque", 10.0, 0.0)]
    assert rows(reg.region_power(installations)) == [("Bretagne", 90.0, 6.0), ("Normandie", 14.0, 2.0)]
    assert rows(reg.region_power_with_code(installations)) == [
        ("Bretagne", 90.0, 6.0),
        ("Normandie", 4.0, 2.0),
    ]
    # The row without a regime goes with the withdrawn one.
    assert rows(reg.region_power_in_service(installations)) == [
        ("Bretagne", 60.0, 5.0),
        ("Normandie", 10.0, 0.0),
    ]


def test_single_totals(installations):
    assert rows(reg.withdrawn_power(installations)) == [(30.0,)]
    assert rows(reg.photovoltaic_totals(installations)) == [(10, 70.0)]
    assert sorted_tuples(reg.rows_by_regime(installations)) == [
        (None, 1),
        ("En retrait provisoire", 1),
        ("En service", 4),
    ]
    assert rows(reg.totals_by_name(installations, "puis")) == [(1204.0, 24.0, 19.0)]


def test_location(installations):
    assert rows(reg.unlocated_power(installations)) == [(44.0,)]
    assert rows(reg.unlocated_power_by_technology(installations)) == [
        (None, 30.0),
        ("Photovoltaïque", 10.0),
        ("Autre", 4.0),
    ]
    assert reg.unlocated_rows(installations).count() == 3
    assert reg.rows_without_commune(installations).count() == 2
    assert reg.rows_without_iris_and_commune(installations).count() == 2
    assert rows(reg.null_iris(installations)) == [(3,)]
    assert rows(reg.null_iris_of_aggregates(installations)) == [(2,)]


def test_lookup(installations):
    assert rows(reg.installations_named(installations, ["c"]).select("region")) == [("Guyane",)]


def test_edge_rows(edge_rows):
    assert rows(reg.repeated_code_power(edge_rows)) == [(259.0,)]
    # 100/2 and 10/0 are over 45, and so is 0/0, which adds nothing; -1/0 is not.
    assert rows(reg.large_average_power(edge_rows)) == [(110.0,)]
    assert rows(reg.power_columns_agree(edge_rows)) == [(False,)]
    assert reg.power_disagreements(edge_rows).count() == 2
    totals = rows(reg.totals_by_name(edge_rows, "puis"))[0]
    assert all(math.isnan(total) for total in totals)


def test_dates(spark):
    schema = (
        "datemiseenservice string, datederaccordement string, datedebutversion string, "
        "datemiseenservice_date date"
    )
    data = [
        ("26/02/2010", "2010-02-26", "2010-02-26", date(2010, 2, 26)),
        ("2010-02-26", None, "2022-09-21", date(1897, 3, 21)),
        (None, "2022-02-01", "2022-02-01", None),
        (None, None, None, date(2030, 1, 1)),
        ("inconnu", None, "n/a", None),
        ("2010", "2010", "2010-01-01", None),
        ("26/02/2010junk", "2010-02", "26/02/2010junk", None),
    ]
    df = spark.createDataFrame(data, schema)
    assert rows(reg.date_disagreements(df)) == [(4, 4, 4, 3, 2, 2)]
    assert reg.rows_versioned_after_start(df).count() == 4
    assert reg.rows_with_connection_date(df).count() == 4
    odd = reg.implausible_start_dates(df, date(1900, 1, 1), date(2026, 1, 1))
    assert sorted_tuples(odd.select("datemiseenservice_date")) == [
        (date(1897, 3, 21),),
        (date(2030, 1, 1),),
    ]


def test_best_location(spark):
    names = list(reg.LOCATION_LEVELS.values())
    data = [[None] * 5 for _ in range(6)]
    for i in range(5):
        for j in range(i, 5):
            data[i][j] = f"{names[j]}-{i}"
    df = spark.createDataFrame(data, ", ".join(f"{name} string" for name in names))
    got = rows(reg.with_best_location(df).select("location_level", "location_code"))
    assert [level for level, _ in got] == [*reg.LOCATION_LEVELS, None]
    assert got[2] == ("epci", "codeepci-2")


def test_repeated_keys(spark):
    df = spark.createDataFrame(
        [("p", "A"), ("p", None), (None, None), ("q", "A")],
        "idpeps string, codeeicresourceobject string",
    )
    assert rows(reg.repeated_key_rows(df)) == [("idpeps", 2), ("codeeicresourceobject", 2)]


def test_measure_list(spark):
    df = spark.createDataFrame([[1.0] * 15], ", ".join(f"{m} double" for m in reg.MEASURES))
    assert rows(reg.measure_totals(df)) == [(1.0,) * 15]
    assert sum(reg.PUBLISHED_POWER.values()) == 161_959


def test_published_totals(spark):
    from voltledger.operators import published_totals

    got = published_totals(spark, reg.PUBLISHED_POWER)
    assert got.count() == 8
    assert rows(got.groupBy().sum("published")) == [(161_959,)]
