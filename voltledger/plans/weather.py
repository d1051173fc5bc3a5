"""Weather stations and their hourly observations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltledger.operators import duplicated_rows, frame_shape, min_max


def active_stations(stations: DataFrame) -> DataFrame:
    """Stations whose end date is the empty text; a null end date is not one."""
    return stations.filter(F.col("dateFin") == "")


def station_shapes(stations: DataFrame) -> DataFrame:
    """Shape of all stations and of the active ones, from one pass: one row."""
    return stations.agg(
        F.count(F.lit(1)).alias("n_stations"),
        F.count_if(F.col("dateFin") == "").alias("n_active"),
        F.lit(len(stations.columns)).alias("n_columns"),
    )


def same_name_stations(stations: DataFrame) -> DataFrame:
    """Active stations that share their name with another active station."""
    return duplicated_rows(active_stations(stations), "nom")


def station(stations: DataFrame, station_id: str) -> DataFrame:
    return active_stations(stations).filter(F.col("id") == station_id)


def observation_period(observations: DataFrame) -> DataFrame:
    """First and last hour, packed as year, month, day and hour."""
    return min_max(observations, ["aaaammjjhh"])


def observation_shape(observations: DataFrame) -> DataFrame:
    return frame_shape(observations)
