"""The two dictionaries of queries and SQL, and what the queries share."""

from __future__ import annotations

from collections.abc import Callable
from functools import lru_cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def check(sql: str) -> Callable[[Query], Query]:
    """Register a query under its function name, with its SQL."""

    def add(query: Query) -> Query:
        name = query.__name__
        if name in QUERIES:
            raise ValueError(f"query {name} is there already")
        QUERIES[name] = query
        ORACLES[name] = sql
        return query

    return add


@lru_cache(maxsize=64)
def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table, opened once per session; every query on it still reads its rows."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cents(name: str) -> Column:
    """A two-place amount as a whole number of cents, so that its sum is exact in any order."""
    return F.rint(F.col(name) * 100).cast("long")


def null_if(name: str, value: object) -> Column:
    return F.when(F.col(name) != value, F.col(name))
