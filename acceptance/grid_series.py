"""Grid checks, with events as the series, and status columns of orders."""

from datetime import date
from functools import lru_cache

from pyspark.sql import functions as F

from acceptance.registry import check, null_if, table
from voltledger import operators as ops
from voltledger.plans import grid

JANUARY = (date(2024, 1, 1), date(2024, 1, 30))
KINDS = ("click", "error", "purchase", "signup", "view")

SERIES = """
WITH series AS (
  SELECT ts AS date_heure, event_type AS libelle_region,
         CASE WHEN user_id < 10 THEN NULL WHEN user_id < 20 THEN 'Données temps réel'
              WHEN user_id < 60 THEN 'Données consolidées' ELSE 'Données définitives' END AS nature,
         CASE WHEN event_type = 'error' THEN 'Corse' WHEN event_type <> 'view' THEN 'France' END AS perimetre,
         CASE WHEN user_id = 5 THEN value END AS column_30,
         CASE WHEN user_id < 30 THEN value END AS tco_eolien,
         CASE WHEN value > 10 THEN value END AS tco_solaire,
         value AS consommation
  FROM events)
"""


@lru_cache(maxsize=8)
def series(spark, sf_dir):
    user, value, kind = F.col("user_id"), F.col("value"), F.col("event_type")
    nature = (
        F.when(user < 10, None)
        .when(user < 20, "Données temps réel")
        .when(user < 60, grid.CONSOLIDATED)
        .otherwise(grid.DEFINITIVE)
    )
    return table(spark, sf_dir, "events").select(
        F.col("ts").alias("date_heure"),
        kind.alias("libelle_region"),
        nature.alias("nature"),
        F.when(kind == "error", "Corse").when(kind != "view", grid.COUNTRY).alias("perimetre"),
        F.when(user == 5, value).alias("column_30"),
        F.when(user < 30, value).alias("tco_eolien"),
        F.when(value > 10, value).alias("tco_solaire"),
        value.alias("consommation"),
    )


@check(
    SERIES
    + "SELECT date_heure, perimetre, consommation FROM series WHERE perimetre <> 'France'"
)
def grid_rows_outside_country(spark, sf_dir):
    rows = grid.rows_outside_country(series(spark, sf_dir))
    return rows.select("date_heure", "perimetre", "consommation")


@check(SERIES + "SELECT nature, perimetre, column_30, tco_eolien, tco_solaire FROM series")
def grid_columns_with_nulls(spark, sf_dir):
    return ops.null_columns_only(series(spark, sf_dir))


@check(SERIES + "SELECT column_30 FROM series WHERE column_30 IS NOT NULL")
def grid_stray_values(spark, sf_dir):
    return grid.stray_values(series(spark, sf_dir))


@check(
    SERIES
    + """SELECT count(*) FILTER (WHERE tco_eolien IS NULL) AS tco_eolien,
                count(*) FILTER (WHERE tco_solaire IS NULL) AS tco_solaire FROM series"""
)
def grid_rate_null_counts(spark, sf_dir):
    return grid.rate_null_counts(series(spark, sf_dir))


@check(
    SERIES
    + "SELECT min(date_heure) AS date_heure_min, max(date_heure) AS date_heure_max FROM series"
)
def grid_period(spark, sf_dir):
    return grid.period(series(spark, sf_dir))


VALUES = (
    SERIES
    + """SELECT count(date_heure) AS date_heure, count(libelle_region) AS libelle_region, count(nature) AS nature,
                count(perimetre) AS perimetre, count(column_30) AS column_30, count(tco_eolien) AS tco_eolien,
                count(tco_solaire) AS tco_solaire, count(consommation) AS consommation
         FROM series WHERE nature = """
)


@check(VALUES + "'Données consolidées'")
def grid_consolidated_values(spark, sf_dir):
    return grid.values_with_status(series(spark, sf_dir), grid.CONSOLIDATED)


@check(VALUES + "'Données définitives'")
def grid_definitive_values(spark, sf_dir):
    return grid.values_with_status(series(spark, sf_dir), grid.DEFINITIVE)


@check(
    SERIES
    + """, n AS (SELECT count(*) AS n_rows, count(*) FILTER (WHERE nature = 'Données consolidées') AS n_1,
                        count(*) FILTER (WHERE nature = 'Données définitives') AS n_2 FROM series)
         SELECT n_rows, n_1, n_2, n_rows - n_1 - n_2 AS n_uncovered, n_rows = n_1 + n_2 AS is_covered FROM n"""
)
def grid_status_coverage(spark, sf_dir):
    return grid.status_coverage(series(spark, sf_dir))


@check(
    SERIES
    + """SELECT nature, min(date_heure) AS first_time, max(date_heure) AS last_time, count(*) AS n_rows
         FROM series GROUP BY 1"""
)
def grid_status_periods(spark, sf_dir):
    return grid.status_periods(series(spark, sf_dir))


@check(SERIES + "SELECT count(DISTINCT libelle_region) AS n_distinct FROM series")
def grid_region_count(spark, sf_dir):
    return grid.region_count(series(spark, sf_dir))


@check(
    SERIES
    + """SELECT count(*) AS n_rows, cast(48 * 5 * 30 AS bigint) AS n_expected, count(*) - 48 * 5 * 30 AS n_difference
         FROM series WHERE nature = 'Données définitives'"""
)
def grid_definitive_balance(spark, sf_dir):
    return grid.definitive_balance(series(spark, sf_dir), 5, JANUARY)


DEFINITIVE_SLOTS = (
    SERIES
    + """, s AS (SELECT libelle_region, time_bucket(INTERVAL 30 MINUTE, date_heure) AS slot FROM series
                 WHERE nature = 'Données définitives' AND date_heure >= '2024-01-01' AND date_heure < '2024-01-31')
    """
)


@check(
    DEFINITIVE_SLOTS
    + """SELECT libelle_region, count(*) AS n_rows, count(DISTINCT slot) AS n_slots, cast(1440 AS bigint) AS n_expected,
                1440 - count(DISTINCT slot) AS n_missing FROM s GROUP BY 1"""
)
def grid_definitive_completeness(spark, sf_dir):
    return grid.definitive_completeness(series(spark, sf_dir), KINDS, JANUARY)


@check(
    DEFINITIVE_SLOTS
    + """, c AS (SELECT libelle_region, unnest(generate_series(TIMESTAMP '2024-01-01', TIMESTAMP '2024-01-30 23:30:00',
                        INTERVAL 30 MINUTE)) AS slot FROM (SELECT DISTINCT libelle_region FROM s))
         SELECT libelle_region, slot FROM c EXCEPT SELECT libelle_region, slot FROM s"""
)
def grid_missing_slots(spark, sf_dir):
    return grid.definitive_missing_slots(series(spark, sf_dir), KINDS, JANUARY)


EXPECTED = """, e AS (SELECT libelle_region FROM s UNION SELECT 'Corse'),
    c AS (SELECT libelle_region, unnest(generate_series(TIMESTAMP '2024-01-01', TIMESTAMP '2024-01-30 23:30:00',
                 INTERVAL 30 MINUTE)) AS slot FROM e)
    """


@check(
    DEFINITIVE_SLOTS
    + EXPECTED
    + """SELECT e.libelle_region, count(slot) AS n_rows, count(DISTINCT slot) AS n_slots,
                cast(1440 AS bigint) AS n_expected, 1440 - count(DISTINCT slot) AS n_missing
         FROM e LEFT JOIN s USING (libelle_region) GROUP BY 1"""
)
def grid_region_without_rows(spark, sf_dir):
    return grid.definitive_completeness(series(spark, sf_dir), [*KINDS, "Corse"], JANUARY)


@check(
    DEFINITIVE_SLOTS
    + EXPECTED
    + "SELECT libelle_region, slot FROM c EXCEPT SELECT libelle_region, slot FROM s"
)
def grid_missing_slots_without_rows(spark, sf_dir):
    return grid.definitive_missing_slots(series(spark, sf_dir), [*KINDS, "Corse"], JANUARY)


@check(
    DEFINITIVE_SLOTS
    + EXPECTED
    + """, d AS (SELECT DISTINCT libelle_region, slot FROM s)
    SELECT c.libelle_region, cast(c.slot AS date) AS day, count(d.slot) AS n_slots,
           cast(48 AS bigint) AS n_expected, 48 - count(d.slot) AS n_missing
    FROM c LEFT JOIN d ON c.libelle_region = d.libelle_region AND c.slot = d.slot GROUP BY 1, 2"""
)
def grid_day_completeness(spark, sf_dir):
    return grid.definitive_day_completeness(series(spark, sf_dir), [*KINDS, "Corse"], JANUARY)


@check(
    """
    SELECT event_type, count(*) AS n_rows, count(DISTINCT date_trunc('hour', ts)) AS n_slots,
           cast(720 AS bigint) AS n_expected, 720 - count(DISTINCT date_trunc('hour', ts)) AS n_missing
    FROM events WHERE ts >= '2024-01-01' AND ts < '2024-01-31' GROUP BY 1
    """
)
def grid_completeness(spark, sf_dir):
    return ops.grid_completeness(table(spark, sf_dir, "events"), "event_type", "ts", *JANUARY, 60)


@check(
    """
    WITH n AS (SELECT count(*) AS n_rows, count(*) FILTER (WHERE o_orderstatus = 'F') AS n_1,
                      count(*) FILTER (WHERE o_orderstatus = 'O') AS n_2 FROM orders)
    SELECT n_rows, n_1, n_2, n_rows - n_1 - n_2 AS n_uncovered, n_rows = n_1 + n_2 AS is_covered FROM n
    """
)
def status_partition(spark, sf_dir):
    return ops.status_partition(table(spark, sf_dir, "orders"), "o_orderstatus", ["F", "O"])


@check(
    """
    SELECT nullif(o_orderstatus, 'P') AS status, min(o_orderdate) AS first_time, max(o_orderdate) AS last_time,
           count(*) AS n_rows FROM orders GROUP BY 1
    """
)
def status_period(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select(
        null_if("o_orderstatus", "P").alias("status"), "o_orderdate"
    )
    return ops.status_period(rows, "status", "o_orderdate")
