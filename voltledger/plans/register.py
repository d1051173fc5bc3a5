"""Analyses of the national register of electricity installations.

A row is one installation, or one sum over small ones. Every function takes the register as a
DataFrame with the published column names and returns a lazy DataFrame.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from voltledger.functions import (
    dates_differ,
    first_available,
    is_unreadable_date,
    parse_date,
    ratio_above,
)
from voltledger.operators import (
    columns_equal,
    duplicate_key_report,
    duplicated_sum,
    exclusion_report,
    group_share,
    group_sums,
    null_count,
    published_totals,
    reconcile,
    rows_differing,
    sum_columns,
    sum_matching,
    sum_rounded,
    value_counts,
)

# Names, texts and figures of the published data.
CODE = "codeeicresourceobject"
POWER = "puismaxinstallee"
CHARGE = "puismaxcharge"
SHARE = "puismaxinstalle_pourcentage"
CANDIDATE_KEYS = ("idpeps", "codeeicresourceobject")
OVERSEAS_REGIONS = ("Martinique", "Guadeloupe", "Guyane", "La Réunion")
WITHDRAWN = "En retrait provisoire"
PHOTOVOLTAIC = "Photovoltaïque"
MEASURES = (
    "puismaxinstallee",
    "puismaxraccharge",
    "puismaxcharge",
    "puismaxrac",
    "puismaxinstalleedischarge",
    "energiestockable",
    "capacitereservoir",
    "hauteurchute",
    "productible",
    "debitmaximal",
    "energieannuelleglissanteinjectee",
    "energieannuelleglissanteproduite",
    "energieannuelleglissantesoutiree",
    "energieannuelleglissantestockee",
    "maxpuis",
)
PUBLISHED_POWER = {
    "charbon": 1810,
    "bioenergies": 2277,
    "fioul": 2623,
    "gaz": 12462,
    "eolien": 25512,
    "hydraulique": 25524,
    "solaire": 28761,
    "nucleaire": 62990,
}
# The published figures look like a unit a thousand times that of the register.
PUBLISHED_UNIT = 1000
WITHDRAWN_POWER = 1_101_500
AGGREGATED_POWER = 5_648_319.464
LARGE_AVERAGE_POWER = 45
SILVER_COLUMNS = {
    "idpeps": "",
    "nominstallation": "nom_installation",
    "codeeicresourceobject": "",
    "codeiris": "code_iris",
    "codeinseecommune": "code_insee_commune",
    "codeepci": "code_epci",
    "codedepartement": "code_departement",
    "coderegion": "code_region",
    "codefiliere": "code_filiere",
    "codecombustible": "code_combustible",
    "codescombustiblessecondaires": "codes_combustibles_secondaires",
    "codetechnologie": "code_technologie",
    "typestockage": "type_stockage",
    "maxpuis": "max_puis",
    "regime": "regime",
    "gestionnaire": "gestionnaire",
    "datemiseenservice_date": "date_mise_en_service",
}
LOCATION_LEVELS = {
    "iris": "codeiris",
    "commune": "codeinseecommune",
    "epci": "codeepci",
    "departement": "codedepartement",
    "region": "coderegion",
}


# Three readings of "this row is a sum over several installations". They do not agree, so each
# analysis says which one it takes.


def has_no_code() -> Column:
    return F.col(CODE).isNull()


def has_code_text() -> Column:
    """Null on a null code, so a filter drops null and empty codes."""
    return F.col(CODE) != ""


def covers_several() -> Column:
    return F.col("nbinstallations") > 1


def on_mainland() -> Column:
    """Null on a null region, so a filter drops those rows; ``region_exclusions`` counts them."""
    return ~F.col("region").isin(list(OVERSEAS_REGIONS))


def mainland(register: DataFrame) -> DataFrame:
    return register.filter(on_mainland())


def region_exclusions(register: DataFrame) -> DataFrame:
    return exclusion_report(register, "region", OVERSEAS_REGIONS)


# Keys.


def repeated_key_rows(register: DataFrame) -> DataFrame:
    return duplicate_key_report(register, CANDIDATE_KEYS)


def repeated_code_power(register: DataFrame) -> DataFrame:
    """Power on rows with a repeated code. Rows without a code share the null code."""
    return duplicated_sum(register, CODE, POWER)


# Totals.


def measure_totals(register: DataFrame) -> DataFrame:
    return sum_columns(register, MEASURES)


def power_totals(register: DataFrame) -> DataFrame:
    return sum_rounded(register, [POWER, "puismaxrac"], 2)


def mainland_power_totals(register: DataFrame) -> DataFrame:
    return sum_rounded(mainland(register), [POWER, "puismaxinstalleedischarge", "puismaxrac"], 2)


def totals_by_name(register: DataFrame, text: str) -> DataFrame:
    """Sums to three places of the columns named ``…text…``, such as ``puis`` or ``energie``."""
    return sum_matching(register, text, 3)


def large_average_power(register: DataFrame, threshold: float = LARGE_AVERAGE_POWER) -> DataFrame:
    """Power on rows without a code whose power per installation is over ``threshold``."""
    large = ratio_above(F.col(POWER), F.col("nbinstallations"), threshold)
    return sum_columns(register.filter(has_no_code()).filter(large), [POWER])


def withdrawn_power(register: DataFrame) -> DataFrame:
    return sum_columns(register.filter(F.col("regime") == WITHDRAWN), [POWER])


def photovoltaic_totals(register: DataFrame) -> DataFrame:
    solar = mainland(register).filter(F.col("technologie") == PHOTOVOLTAIC)
    return sum_columns(solar, ["nbinstallations", POWER])


def rows_by_regime(register: DataFrame) -> DataFrame:
    return value_counts(register, "regime")


def reconciliation(
    register: DataFrame,
    year: int = 2025,
    withdrawn: float = WITHDRAWN_POWER,
    aggregated: float = AGGREGATED_POWER,
    published: Mapping[str, float] = PUBLISHED_POWER,
    published_unit: float = PUBLISHED_UNIT,
) -> DataFrame:
    """One row: national and mainland totals, what is left after each deduction, the published
    total as published, and what the mainland has beyond it.

    ``withdrawn`` and ``aggregated`` are in the unit of the register, of which one unit of the
    published figures has ``published_unit``.
    """
    published_total = float(sum(published.values()))
    power, charge, connected = F.col(POWER), F.col(CHARGE), F.col("puismaxraccharge")
    started = F.col("datemiseenservice")
    totals = {
        "power": (power, None),
        "charge": (charge, None),
        "mainland_power": (power, on_mainland()),
        "mainland_charge": (charge, on_mainland()),
        "mainland_connected_charge": (connected, on_mainland()),
        "mainland_power_text_year": (power, on_mainland() & started.endswith(str(year))),
        "mainland_power_date_year": (power, on_mainland() & (F.year(parse_date(started)) == year)),
    }
    c = F.col
    differences = {
        "power_less_charge": c("power") - c("charge"),
        "power_less_charge_withdrawn": c("power") - c("charge") - withdrawn,
        "mainland_less_charge": c("mainland_power") - c("mainland_charge"),
        "mainland_less_charge_withdrawn": c("mainland_power") - c("mainland_charge") - withdrawn,
        "mainland_less_aggregated": c("mainland_power") - aggregated,
        "mainland_less_text_year": c("mainland_power") - c("mainland_power_text_year"),
        "mainland_less_both_charges": c("mainland_power")
        - c("mainland_charge")
        - c("mainland_connected_charge"),
        "published_power": F.lit(published_total),
        "mainland_less_published": c("mainland_power") - published_total * published_unit,
    }
    return reconcile(register, totals, differences)


def published_by_fuel(
    spark: SparkSession,
    published: Mapping[str, float] = PUBLISHED_POWER,
    published_unit: float = PUBLISHED_UNIT,
) -> DataFrame:
    """The published figures, and the same in the unit of the register: ``name``, ``published``,
    ``power``."""
    totals = published_totals(spark, published)
    return totals.withColumn("power", F.col("published") * published_unit)


# Groups.


def installations_by_fuel(register: DataFrame) -> DataFrame:
    return group_sums(register, "filiere", ["nbinstallations"])


def mainland_power_by_fuel(register: DataFrame) -> DataFrame:
    return group_sums(mainland(register), "filiere", [POWER], descending_by=POWER)


def fuel_share_with_code(register: DataFrame) -> DataFrame:
    """Mainland rows that have a code."""
    return group_share(mainland(register).filter(~has_no_code()), "filiere", POWER, SHARE)


def fuel_share_with_code_text(register: DataFrame) -> DataFrame:
    """All rows with a non-empty code."""
    return group_share(register.filter(has_code_text()), "filiere", POWER, SHARE)


def technology_power_without_code(register: DataFrame) -> DataFrame:
    rows = mainland(register).filter(has_no_code())
    return group_sums(rows, "technologie", [POWER, CHARGE], descending_by=POWER)


def _by_region(rows: DataFrame) -> DataFrame:
    return group_sums(rows, "region", [POWER, CHARGE], descending_by=POWER)


def region_power(register: DataFrame) -> DataFrame:
    return _by_region(mainland(register))


def region_power_with_code(register: DataFrame) -> DataFrame:
    return _by_region(mainland(register).filter(~has_no_code()))


def region_power_in_service(register: DataFrame) -> DataFrame:
    """Without the withdrawn rows, and without those that have no regime."""
    return _by_region(mainland(register).filter(F.col("regime") != WITHDRAWN))


# Location.


def unlocated_rows(register: DataFrame) -> DataFrame:
    return register.filter(F.col("codeiris").isNull())


def unlocated_power(register: DataFrame) -> DataFrame:
    return sum_columns(unlocated_rows(register), [POWER])


def unlocated_power_by_technology(register: DataFrame) -> DataFrame:
    return group_sums(unlocated_rows(register), "technologie", [POWER], descending_by=POWER)


def rows_without_commune(register: DataFrame) -> DataFrame:
    return register.filter(F.col("codeinseecommune").isNull())


def rows_without_iris_and_commune(register: DataFrame) -> DataFrame:
    return register.filter(F.col("codeiris").isNull() & F.col("codeinseecommune").isNull())


def null_iris(register: DataFrame) -> DataFrame:
    return null_count(register, ["codeiris"])


def null_iris_of_aggregates(register: DataFrame) -> DataFrame:
    return null_count(register.filter(covers_several()), ["codeiris"])


def with_best_location(register: DataFrame) -> DataFrame:
    """Adds ``location_code``, the finest code known, and ``location_level``."""
    code, level = first_available([(name, F.col(c)) for name, c in LOCATION_LEVELS.items()])
    return register.withColumn("location_code", code).withColumn("location_level", level)


# Agreement of columns that should say the same.


def power_columns_agree(register: DataFrame) -> DataFrame:
    return columns_equal(register, POWER, "maxpuis")


def power_disagreements(register: DataFrame) -> DataFrame:
    return rows_differing(register, POWER, "maxpuis")


def rows_with_connection_date(register: DataFrame) -> DataFrame:
    return register.filter(F.col("datederaccordement").isNotNull())


def rows_versioned_after_start(register: DataFrame) -> DataFrame:
    """Rows with a version date that is not the start date; a missing start date counts.

    Dates are compared as dates where both can be read, otherwise as the texts they are.
    """
    version = F.col("datedebutversion")
    moved = dates_differ(F.col("datemiseenservice"), version)
    return register.filter(version.isNotNull() & moved)


def date_disagreements(register: DataFrame) -> DataFrame:
    """One row: rows on which each pair of the start, connection and version dates differs, and
    rows on which each of them is a text that is no date."""
    names = ("datemiseenservice", "datederaccordement", "datedebutversion")
    start, connection, version = (F.col(name) for name in names)
    return register.agg(
        F.count_if(dates_differ(start, connection)).alias("start_connection"),
        F.count_if(dates_differ(start, version)).alias("start_version"),
        F.count_if(dates_differ(connection, version)).alias("connection_version"),
        F.count_if(is_unreadable_date(start)).alias("start_unreadable"),
        F.count_if(is_unreadable_date(connection)).alias("connection_unreadable"),
        F.count_if(is_unreadable_date(version)).alias("version_unreadable"),
    )


def implausible_start_dates(register: DataFrame, first: date, last: date) -> DataFrame:
    """Rows whose typed start date lies outside ``first`` … ``last``."""
    day = F.col("datemiseenservice_date")
    return register.filter((day < F.lit(first)) | (day > F.lit(last)))


# Lookup.


def installations_named(register: DataFrame, names: Sequence[str]) -> DataFrame:
    return register.filter(F.col("nominstallation").isin(list(names)))
