"""Weather analyses, with customers as stations and events as hourly observations."""

from pyspark.sql import functions as F

from acceptance.registry import check, table
from voltledger.plans import weather

STATIONS = """
WITH stations AS (
  SELECT cast(c_custkey AS varchar) AS id,
         CASE WHEN c_acctbal > 5000 THEN c_name ELSE c_mktsegment || '-' || c_nationkey END AS nom,
         CASE WHEN c_nationkey < 10 THEN '' WHEN c_nationkey < 20 THEN '2020-01-01' END AS dateFin
  FROM customer)
"""


def stations(spark, sf_dir):
    nation = F.col("c_nationkey")
    shared_name = F.concat_ws("-", "c_mktsegment", nation.cast("string"))
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("id"),
        F.when(F.col("c_acctbal") > 5000, F.col("c_name")).otherwise(shared_name).alias("nom"),
        F.when(nation < 10, "").when(nation < 20, "2020-01-01").alias("dateFin"),
    )


@check(STATIONS + "SELECT id, nom, dateFin FROM stations WHERE dateFin = ''")
def weather_active_stations(spark, sf_dir):
    return weather.active_stations(stations(spark, sf_dir))


@check(
    STATIONS
    + """SELECT count(*) AS n_stations, count(*) FILTER (WHERE dateFin = '') AS n_active, 3 AS n_columns FROM stations"""
)
def weather_station_shapes(spark, sf_dir):
    return weather.station_shapes(stations(spark, sf_dir))


@check(
    STATIONS
    + """SELECT id, nom, dateFin FROM (SELECT *, count(*) OVER (PARTITION BY nom) AS n FROM stations WHERE dateFin = '')
         WHERE n > 1"""
)
def weather_same_name_stations(spark, sf_dir):
    return weather.same_name_stations(stations(spark, sf_dir))


@check(STATIONS + "SELECT id, nom, dateFin FROM stations WHERE dateFin = '' AND id = '17'")
def weather_station_lookup(spark, sf_dir):
    return weather.station(stations(spark, sf_dir), "17")


def observations(spark, sf_dir):
    return table(spark, sf_dir, "events").select(
        F.date_format("ts", "yyyyMMddHH").cast("int").alias("aaaammjjhh"), "value"
    )


@check(
    """
    SELECT min(cast(strftime(ts, '%Y%m%d%H') AS int)) AS aaaammjjhh_min,
           max(cast(strftime(ts, '%Y%m%d%H') AS int)) AS aaaammjjhh_max FROM events
    """
)
def weather_observation_period(spark, sf_dir):
    return weather.observation_period(observations(spark, sf_dir))


@check("SELECT count(*) AS n_rows, 2 AS n_columns FROM events")
def weather_observation_shape(spark, sf_dir):
    return weather.observation_shape(observations(spark, sf_dir))
