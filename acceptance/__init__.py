"""Queries over the given tables, each beside the SQL that must give the same rows."""

from acceptance import (  # noqa: F401
    aggregates,
    duplicates,
    exact_sums,
    filters,
    grid_series,
    kept,
    ordering,
    projections,
    register_analyses,
    sources,
    weather_tables,
)
from acceptance.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
