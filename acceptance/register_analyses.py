"""Register analyses, with lineitem as the register.

Quantities are whole numbers, so that their sums are exact in any order; nulls, empty texts, zero
counts and negative powers are brought in by rule.
"""

from datetime import date
from functools import lru_cache

from pyspark.sql import functions as F

from acceptance.registry import check, table
from voltledger import sources
from voltledger.plans import register as reg

def _day(name):
    """A date from text that is wholly one of the two spellings, in SQL."""
    return (
        f"CASE WHEN regexp_full_match({name}, '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}') THEN try_cast({name} AS date) "
        f"WHEN regexp_full_match({name}, '[0-9]{{2}}/[0-9]{{2}}/[0-9]{{4}}') "
        f"THEN cast(try_strptime({name}, '%d/%m/%Y') AS date) END"
    )


def _dates_differ(a, b):
    """Texts are compared where either is no date."""
    day_a, day_b = f"{a}_day", f"{b}_day"
    return (
        f"CASE WHEN {day_a} IS NOT NULL AND {day_b} IS NOT NULL THEN {day_a} <> {day_b} "
        f"ELSE {a} IS DISTINCT FROM {b} END"
    )


REGISTER = """
WITH raw AS (
  SELECT CASE WHEN l_returnflag <> 'A' THEN 'P' || l_partkey END AS idpeps,
         'Site ' || l_suppkey AS nominstallation,
         CASE WHEN l_linenumber = 1 THEN NULL WHEN l_linenumber = 2 THEN '' ELSE 'C' || l_orderkey END
           AS codeeicresourceobject,
         CASE WHEN l_linenumber > 2 THEN 'I' || l_partkey END AS codeiris,
         CASE WHEN l_linestatus <> 'F' THEN 'M' || l_suppkey END AS codeinseecommune,
         CASE WHEN l_linenumber > 1 THEN 'E' || l_linenumber END AS codeepci,
         CASE WHEN l_returnflag <> 'R' THEN 'D' || l_linenumber END AS codedepartement,
         CASE WHEN l_linenumber < 7 THEN 'R' || l_linenumber END AS coderegion,
         CASE WHEN l_returnflag = 'A' THEN 'Bretagne'
              WHEN l_returnflag = 'N' AND l_linestatus = 'F' THEN 'Guyane'
              WHEN l_returnflag = 'N' THEN 'Occitanie'
              WHEN l_linenumber = 3 THEN NULL
              WHEN l_linenumber = 4 THEN 'La Réunion' ELSE 'Normandie' END AS region,
         CASE WHEN l_linenumber < 3 THEN 'Solaire' WHEN l_linenumber < 5 THEN 'Eolien'
              WHEN l_linenumber < 7 THEN 'Gaz' END AS filiere,
         CASE WHEN l_linenumber IN (1, 4) THEN 'Photovoltaïque' WHEN l_linenumber IN (2, 5) THEN 'Eolien terrestre' END
           AS technologie,
         CASE WHEN l_linenumber = 5 THEN 'En retrait provisoire' WHEN l_linenumber <> 6 THEN 'En service' END AS regime,
         l_linestatus AS codefiliere, l_returnflag AS codecombustible, l_returnflag || l_linestatus AS codescombustiblessecondaires,
         'T' || l_linenumber AS codetechnologie, 'S' || l_suppkey AS typestockage, 'G' || l_suppkey AS gestionnaire,
         cast(l_linenumber - 1 AS bigint) AS nbinstallations,
         CASE WHEN l_quantity <> 13 THEN l_quantity - 10 END AS puismaxinstallee,
         CASE WHEN l_tax <> 0.08 AND l_quantity <> 13 THEN l_quantity - 10 WHEN l_tax = 0.08 THEN l_quantity END AS maxpuis,
         CASE WHEN l_tax <> 0 THEN round(l_tax * 100) END AS puismaxcharge,
         round(l_discount * 100) AS puismaxraccharge, round(l_extendedprice) AS puismaxrac,
         l_quantity AS puismaxinstalleedischarge, l_quantity + 1 AS energiestockable, l_quantity + 2 AS capacitereservoir,
         l_quantity + 3 AS hauteurchute, l_quantity + 4 AS productible, l_quantity + 5 AS debitmaximal,
         l_quantity + 6 AS energieannuelleglissanteinjectee, l_quantity + 7 AS energieannuelleglissanteproduite,
         l_quantity + 8 AS energieannuelleglissantesoutiree, l_extendedprice AS energieannuelleglissantestockee_brut,
         l_quantity + 9 AS energieannuelleglissantestockee,
         CASE WHEN l_linenumber = 7 AND l_returnflag = 'R' THEN 'inconnu'
              WHEN l_linenumber = 5 AND l_returnflag = 'A' THEN NULL
              WHEN l_linenumber = 6 AND l_returnflag = 'N' THEN strftime(l_shipdate, '%Y-%m')
              WHEN l_linenumber = 4 AND l_returnflag = 'R' THEN strftime(l_shipdate, '%d/%m/%Y') || ' env.'
              WHEN l_linenumber = 3 THEN strftime(l_shipdate, '%Y-%m-%d') ELSE strftime(l_shipdate, '%d/%m/%Y') END
           AS datemiseenservice,
         CASE WHEN l_linenumber = 7 AND l_returnflag = 'R' THEN 'n/a'
              WHEN l_linenumber = 6 AND l_returnflag = 'N' THEN strftime(l_shipdate, '%Y-%m')
              WHEN l_linenumber = 1 AND l_returnflag = 'N' THEN strftime(l_shipdate, '%Y')
              WHEN l_linenumber < 4 THEN strftime(l_shipdate, '%Y-%m-%d')
              WHEN l_linenumber < 7 THEN strftime(l_shipdate + INTERVAL 1 DAY, '%Y-%m-%d') END AS datedebutversion,
         CASE WHEN l_returnflag = 'A' THEN strftime(l_shipdate, '%Y-%m-%d')
              WHEN l_returnflag = 'N' AND l_linenumber = 2 THEN '' END AS datederaccordement,
         cast(l_shipdate AS date) AS datemiseenservice_date
  FROM lineitem),
register AS (SELECT *, """ + ", ".join(
    f"{_day(name)} AS {name}_day"
    for name in ("datemiseenservice", "datedebutversion", "datederaccordement")
) + """ FROM raw),
mainland AS (SELECT * FROM register WHERE region NOT IN ('Martinique', 'Guadeloupe', 'Guyane', 'La Réunion'))
"""


@lru_cache(maxsize=8)
def register(spark, sf_dir):
    line, flag, status = F.col("l_linenumber"), F.col("l_returnflag"), F.col("l_linestatus")
    quantity, tax, day = F.col("l_quantity"), F.col("l_tax"), F.col("l_shipdate")

    def tagged(tag, c):
        return F.concat(F.lit(tag), c.cast("string"))

    part, supplier = F.col("l_partkey"), F.col("l_suppkey")
    power = F.when(quantity != 13, quantity - 10)
    iso = day.cast("date").cast("string")
    year, month = F.left(iso, F.lit(4)), F.left(iso, F.lit(7))
    slashed = F.concat_ws("/", F.substring(iso, 9, 2), F.substring(iso, 6, 2), year)
    next_day = F.date_add(day.cast("date"), 1).cast("string")
    columns = {
        "idpeps": F.when(flag != "A", tagged("P", part)),
        "nominstallation": tagged("Site ", supplier),
        "codeeicresourceobject": F.when(line == 1, None)
        .when(line == 2, "")
        .otherwise(tagged("C", F.col("l_orderkey"))),
        "codeiris": F.when(line > 2, tagged("I", part)),
        "codeinseecommune": F.when(status != "F", tagged("M", supplier)),
        "codeepci": F.when(line > 1, tagged("E", line)),
        "codedepartement": F.when(flag != "R", tagged("D", line)),
        "coderegion": F.when(line < 7, tagged("R", line)),
        "region": F.when(flag == "A", "Bretagne")
        .when((flag == "N") & (status == "F"), "Guyane")
        .when(flag == "N", "Occitanie")
        .when(line == 3, None)
        .when(line == 4, "La Réunion")
        .otherwise("Normandie"),
        "filiere": F.when(line < 3, "Solaire").when(line < 5, "Eolien").when(line < 7, "Gaz"),
        "technologie": F.when(line.isin(1, 4), reg.PHOTOVOLTAIC).when(
            line.isin(2, 5), "Eolien terrestre"
        ),
        "regime": F.when(line == 5, reg.WITHDRAWN).when(line != 6, "En service"),
        "codefiliere": status,
        "codecombustible": flag,
        "codescombustiblessecondaires": F.concat(flag, status),
        "codetechnologie": tagged("T", line),
        "typestockage": tagged("S", supplier),
        "gestionnaire": tagged("G", supplier),
        "nbinstallations": (line - 1).cast("long"),
        "puismaxinstallee": power,
        "maxpuis": F.when(tax == 0.08, quantity).otherwise(power),
        "puismaxcharge": F.when(tax != 0, F.rint(tax * 100)),
        "puismaxraccharge": F.rint(F.col("l_discount") * 100),
        "puismaxrac": F.floor(F.col("l_extendedprice") + 0.5).cast("double"),
        "puismaxinstalleedischarge": quantity,
        "energiestockable": quantity + 1,
        "capacitereservoir": quantity + 2,
        "hauteurchute": quantity + 3,
        "productible": quantity + 4,
        "debitmaximal": quantity + 5,
        "energieannuelleglissanteinjectee": quantity + 6,
        "energieannuelleglissanteproduite": quantity + 7,
        "energieannuelleglissantesoutiree": quantity + 8,
        "energieannuelleglissantestockee": quantity + 9,
        "energieannuelleglissantestockee_brut": F.col("l_extendedprice"),
        "datemiseenservice": F.when((line == 7) & (flag == "R"), "inconnu")
        .when((line == 5) & (flag == "A"), None)
        .when((line == 6) & (flag == "N"), month)
        .when((line == 4) & (flag == "R"), F.concat(slashed, F.lit(" env.")))
        .when(line == 3, iso)
        .otherwise(slashed),
        "datedebutversion": F.when((line == 7) & (flag == "R"), "n/a")
        .when((line == 6) & (flag == "N"), month)
        .when((line == 1) & (flag == "N"), year)
        .when(line < 4, iso)
        .when(line < 7, next_day),
        "datederaccordement": F.when(flag == "A", iso).when((flag == "N") & (line == 2), ""),
        "datemiseenservice_date": day.cast("date"),
    }
    rows = table(spark, sf_dir, "lineitem")
    return rows.select([c.alias(name) for name, c in columns.items()])


# Keys.


@check(
    REGISTER
    + """, p AS (SELECT idpeps, count(*) AS n FROM register WHERE idpeps IS NOT NULL GROUP BY 1),
  c AS (SELECT codeeicresourceobject, count(*) AS n FROM register WHERE codeeicresourceobject IS NOT NULL GROUP BY 1)
SELECT 'idpeps' AS key, cast(coalesce(sum(n), 0) AS bigint) AS dup_rows FROM p WHERE n > 1
UNION ALL SELECT 'codeeicresourceobject', cast(coalesce(sum(n), 0) AS bigint) FROM c WHERE n > 1"""
)
def register_repeated_keys(spark, sf_dir):
    return reg.repeated_key_rows(register(spark, sf_dir))


@check(
    REGISTER
    + """, c AS (SELECT codeeicresourceobject, count(*) AS n, sum(puismaxinstallee) AS power FROM register GROUP BY 1)
SELECT coalesce(sum(power), 0) AS puismaxinstallee FROM c WHERE n > 1"""
)
def register_repeated_code_power(spark, sf_dir):
    return reg.repeated_code_power(register(spark, sf_dir))


# Totals.


@check(
    REGISTER
    + "SELECT "
    + ", ".join(f"coalesce(sum({name}), 0) AS {name}" for name in reg.MEASURES)
    + " FROM register"
)
def register_measure_totals(spark, sf_dir):
    return reg.measure_totals(register(spark, sf_dir))


@check(
    REGISTER
    + """SELECT round_even(sum(puismaxinstallee), 2) AS puismaxinstallee, round_even(sum(puismaxrac), 2) AS puismaxrac
         FROM register"""
)
def register_power_totals(spark, sf_dir):
    return reg.power_totals(register(spark, sf_dir))


@check(
    REGISTER
    + """SELECT round_even(sum(puismaxinstallee), 2) AS puismaxinstallee,
                round_even(sum(puismaxinstalleedischarge), 2) AS puismaxinstalleedischarge,
                round_even(sum(puismaxrac), 2) AS puismaxrac FROM mainland"""
)
def register_mainland_power_totals(spark, sf_dir):
    return reg.mainland_power_totals(register(spark, sf_dir))


@check(
    REGISTER
    + "SELECT "
    + ", ".join(
        f"round_even(sum({name}), 3) AS {name}"
        for name in (
            "puismaxinstallee",
            "maxpuis",
            "puismaxcharge",
            "puismaxraccharge",
            "puismaxrac",
            "puismaxinstalleedischarge",
        )
    )
    + " FROM register"
)
def register_power_by_name(spark, sf_dir):
    return reg.totals_by_name(register(spark, sf_dir), "puis")


@check(
    REGISTER
    + "SELECT "
    + ", ".join(
        f"round_even(sum({name}), 3) AS {name}"
        for name in (
            "energiestockable",
            "energieannuelleglissanteinjectee",
            "energieannuelleglissanteproduite",
            "energieannuelleglissantesoutiree",
            "energieannuelleglissantestockee",
            "energieannuelleglissantestockee_brut",
        )
    )
    + " FROM register"
)
def register_energy_by_name(spark, sf_dir):
    return reg.totals_by_name(register(spark, sf_dir), "energie")


@check(
    REGISTER
    + """SELECT coalesce(sum(puismaxinstallee), 0) AS puismaxinstallee FROM register
         WHERE codeeicresourceobject IS NULL AND puismaxinstallee / cast(nbinstallations AS double) > 45"""
)
def register_large_average_power(spark, sf_dir):
    return reg.large_average_power(register(spark, sf_dir))


@check(
    REGISTER
    + "SELECT coalesce(sum(puismaxinstallee), 0) AS puismaxinstallee FROM register WHERE regime = 'En retrait provisoire'"
)
def register_withdrawn_power(spark, sf_dir):
    return reg.withdrawn_power(register(spark, sf_dir))


@check(
    REGISTER
    + """SELECT cast(sum(nbinstallations) AS bigint) AS nbinstallations, sum(puismaxinstallee) AS puismaxinstallee
         FROM mainland WHERE technologie = 'Photovoltaïque'"""
)
def register_photovoltaic_totals(spark, sf_dir):
    return reg.photovoltaic_totals(register(spark, sf_dir))


@check(REGISTER + "SELECT regime, count(*) AS count FROM register GROUP BY 1")
def register_rows_by_regime(spark, sf_dir):
    return reg.rows_by_regime(register(spark, sf_dir))


@check(
    REGISTER
    + """, t AS (
  SELECT (SELECT sum(puismaxinstallee) FROM register) AS power, (SELECT sum(puismaxcharge) FROM register) AS charge,
         sum(puismaxinstallee) AS mainland_power, sum(puismaxcharge) AS mainland_charge,
         sum(puismaxraccharge) AS mainland_connected_charge,
         coalesce(sum(puismaxinstallee) FILTER (WHERE datemiseenservice LIKE '%2000'), 0) AS mainland_power_text_year,
         coalesce(sum(puismaxinstallee) FILTER (WHERE year(datemiseenservice_day) = 2000), 0) AS mainland_power_date_year
  FROM mainland)
SELECT *, power - charge AS power_less_charge, power - charge - 1101500 AS power_less_charge_withdrawn,
       mainland_power - mainland_charge AS mainland_less_charge,
       mainland_power - mainland_charge - 1101500 AS mainland_less_charge_withdrawn,
       mainland_power - cast('5648319.464' AS double) AS mainland_less_aggregated,
       mainland_power - mainland_power_text_year AS mainland_less_text_year,
       mainland_power - mainland_charge - mainland_connected_charge AS mainland_less_both_charges,
       cast(161959 AS double) AS published_power,
       mainland_power - 161959000.0::double AS mainland_less_published FROM t"""
)
def register_reconciliation(spark, sf_dir):
    return reg.reconciliation(register(spark, sf_dir), year=2000)


@check(
    REGISTER
    + """SELECT count(*) FILTER (WHERE region IN ('Bretagne', 'Occitanie', 'Normandie')) AS n_kept,
                count(*) FILTER (WHERE region IN ('Guyane', 'La Réunion')) AS n_excluded,
                count(*) FILTER (WHERE region IS NULL) AS n_null_dropped FROM register"""
)
def register_region_exclusions(spark, sf_dir):
    return reg.region_exclusions(register(spark, sf_dir))


@check(
    """
    SELECT l_returnflag AS name, cast(count(*) AS double) AS published,
           cast(count(*) AS double) * 1000 AS power FROM lineitem GROUP BY 1
    """
)
def published_totals(spark, sf_dir):
    """Figures that someone has counted elsewhere: here, lines by return flag."""
    counted = table(spark, sf_dir, "lineitem").groupBy("l_returnflag").count().collect()
    return reg.published_by_fuel(spark, {row["l_returnflag"]: row["count"] for row in counted})


# Groups.

GROUPED = """SELECT {key}, {sums} FROM {rows} GROUP BY 1"""
POWER = "coalesce(sum(puismaxinstallee), 0) AS puismaxinstallee"
POWER_AND_CHARGE = POWER + ", coalesce(sum(puismaxcharge), 0) AS puismaxcharge"


@check(
    REGISTER
    + GROUPED.format(
        key="filiere",
        sums="cast(sum(nbinstallations) AS bigint) AS nbinstallations",
        rows="register",
    )
)
def register_installations_by_fuel(spark, sf_dir):
    return reg.installations_by_fuel(register(spark, sf_dir))


@check(REGISTER + GROUPED.format(key="filiere", sums=POWER, rows="mainland"))
def register_mainland_power_by_fuel(spark, sf_dir):
    return reg.mainland_power_by_fuel(register(spark, sf_dir))


FUEL_SHARE = """, g AS (SELECT filiere, sum(puismaxinstallee) AS puismaxinstallee FROM {rows} GROUP BY 1)
SELECT filiere, puismaxinstallee,
       round_even(puismaxinstallee / (SELECT sum(puismaxinstallee) FROM g) * 100, 2) AS puismaxinstalle_pourcentage
FROM g"""


@check(REGISTER + FUEL_SHARE.format(rows="mainland WHERE codeeicresourceobject IS NOT NULL"))
def register_fuel_share_with_code(spark, sf_dir):
    return reg.fuel_share_with_code(register(spark, sf_dir))


@check(REGISTER + FUEL_SHARE.format(rows="register WHERE codeeicresourceobject <> ''"))
def register_fuel_share_with_code_text(spark, sf_dir):
    return reg.fuel_share_with_code_text(register(spark, sf_dir))


@check(
    REGISTER
    + GROUPED.format(
        key="technologie",
        sums=POWER_AND_CHARGE,
        rows="mainland WHERE codeeicresourceobject IS NULL",
    )
)
def register_technology_power(spark, sf_dir):
    return reg.technology_power_without_code(register(spark, sf_dir))


@check(REGISTER + GROUPED.format(key="region", sums=POWER_AND_CHARGE, rows="mainland"))
def register_region_power(spark, sf_dir):
    return reg.region_power(register(spark, sf_dir))


@check(
    REGISTER
    + GROUPED.format(
        key="region",
        sums=POWER_AND_CHARGE,
        rows="mainland WHERE codeeicresourceobject IS NOT NULL",
    )
)
def register_region_power_with_code(spark, sf_dir):
    return reg.region_power_with_code(register(spark, sf_dir))


@check(
    REGISTER
    + GROUPED.format(
        key="region",
        sums=POWER_AND_CHARGE,
        rows="mainland WHERE regime <> 'En retrait provisoire'",
    )
)
def register_region_power_in_service(spark, sf_dir):
    return reg.region_power_in_service(register(spark, sf_dir))


# Location.

KEY = "SELECT nominstallation, idpeps, codeeicresourceobject, nbinstallations, puismaxinstallee FROM register "


def _key(rows):
    return rows.select(
        "nominstallation", "idpeps", "codeeicresourceobject", "nbinstallations", "puismaxinstallee"
    )


@check(REGISTER + KEY + "WHERE codeiris IS NULL")
def register_unlocated_rows(spark, sf_dir):
    return _key(reg.unlocated_rows(register(spark, sf_dir)))


@check(REGISTER + f"SELECT {POWER} FROM register WHERE codeiris IS NULL")
def register_unlocated_power(spark, sf_dir):
    return reg.unlocated_power(register(spark, sf_dir))


@check(
    REGISTER
    + GROUPED.format(key="technologie", sums=POWER, rows="register WHERE codeiris IS NULL")
)
def register_unlocated_power_by_technology(spark, sf_dir):
    return reg.unlocated_power_by_technology(register(spark, sf_dir))


@check(REGISTER + KEY + "WHERE codeinseecommune IS NULL")
def register_rows_without_commune(spark, sf_dir):
    return _key(reg.rows_without_commune(register(spark, sf_dir)))


@check(REGISTER + KEY + "WHERE codeiris IS NULL AND codeinseecommune IS NULL")
def register_rows_without_iris_and_commune(spark, sf_dir):
    return _key(reg.rows_without_iris_and_commune(register(spark, sf_dir)))


@check(REGISTER + "SELECT count(*) FILTER (WHERE codeiris IS NULL) AS codeiris FROM register")
def register_null_iris(spark, sf_dir):
    return reg.null_iris(register(spark, sf_dir))


@check(
    REGISTER
    + "SELECT count(*) FILTER (WHERE codeiris IS NULL) AS codeiris FROM register WHERE nbinstallations > 1"
)
def register_null_iris_of_aggregates(spark, sf_dir):
    return reg.null_iris_of_aggregates(register(spark, sf_dir))


@check(
    REGISTER
    + """SELECT nominstallation, idpeps,
                coalesce(codeiris, codeinseecommune, codeepci, codedepartement, coderegion) AS location_code,
                CASE WHEN codeiris IS NOT NULL THEN 'iris' WHEN codeinseecommune IS NOT NULL THEN 'commune'
                     WHEN codeepci IS NOT NULL THEN 'epci' WHEN codedepartement IS NOT NULL THEN 'departement'
                     WHEN coderegion IS NOT NULL THEN 'region' END AS location_level
         FROM register"""
)
def register_best_location(spark, sf_dir):
    located = reg.with_best_location(register(spark, sf_dir))
    return located.select("nominstallation", "idpeps", "location_code", "location_level")


# Agreement of columns.


@check(
    REGISTER
    + "SELECT bool_and(puismaxinstallee IS NOT DISTINCT FROM maxpuis) AS is_equal FROM register"
)
def register_power_columns_agree(spark, sf_dir):
    return reg.power_columns_agree(register(spark, sf_dir))


@check(
    REGISTER
    + """SELECT nominstallation, puismaxinstallee, maxpuis FROM register
         WHERE puismaxinstallee IS DISTINCT FROM maxpuis"""
)
def register_power_disagreements(spark, sf_dir):
    rows = reg.power_disagreements(register(spark, sf_dir))
    return rows.select("nominstallation", "puismaxinstallee", "maxpuis")


@check(REGISTER + KEY + "WHERE datederaccordement IS NOT NULL")
def register_rows_with_connection_date(spark, sf_dir):
    return _key(reg.rows_with_connection_date(register(spark, sf_dir)))


@check(
    REGISTER
    + KEY
    + "WHERE datedebutversion IS NOT NULL AND "
    + _dates_differ("datemiseenservice", "datedebutversion")
)
def register_rows_versioned_after_start(spark, sf_dir):
    return _key(reg.rows_versioned_after_start(register(spark, sf_dir)))


@check(
    REGISTER
    + "SELECT "
    + ", ".join(
        f"count(*) FILTER (WHERE {_dates_differ(a, b)}) AS {name}"
        for a, b, name in (
            ("datemiseenservice", "datederaccordement", "start_connection"),
            ("datemiseenservice", "datedebutversion", "start_version"),
            ("datederaccordement", "datedebutversion", "connection_version"),
        )
    )
    + "".join(
        f", count(*) FILTER (WHERE {column} IS NOT NULL AND {column}_day IS NULL) AS {name}_unreadable"
        for column, name in (
            ("datemiseenservice", "start"),
            ("datederaccordement", "connection"),
            ("datedebutversion", "version"),
        )
    )
    + " FROM register"
)
def register_date_disagreements(spark, sf_dir):
    return reg.date_disagreements(register(spark, sf_dir))


@check(
    REGISTER
    + KEY
    + "WHERE datemiseenservice_date < '1995-06-01' OR datemiseenservice_date > '2001-06-01'"
)
def register_implausible_start_dates(spark, sf_dir):
    rows = register(spark, sf_dir)
    return _key(reg.implausible_start_dates(rows, date(1995, 6, 1), date(2001, 6, 1)))


@check(REGISTER + KEY + "WHERE nominstallation IN ('Site 17')")
def register_installations_named(spark, sf_dir):
    return _key(reg.installations_named(register(spark, sf_dir), ["Site 17"]))


@check(
    REGISTER
    + "SELECT "
    + ", ".join(f"{old} AS {new or old}" for old, new in reg.SILVER_COLUMNS.items())
    + " FROM register"
)
def register_silver(spark, sf_dir):
    return sources.project(register(spark, sf_dir), reg.SILVER_COLUMNS)
