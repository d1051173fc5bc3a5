"""Small frames and result helpers for the tests."""

from __future__ import annotations

import math

# Hand-written register rows: code, nbinstallations, power, maxpuis, region.
REGISTER_ROWS = [
    ("A", 1, 100.0, 100.0, "Bretagne"),  # repeated code, equal powers
    ("A", 1, 50.0, 51.0, "Guyane"),  # repeated code, overseas, unequal powers
    (None, 2, 100.0, None, "Bretagne"),  # aggregated, 50 per installation
    (None, 0, 10.0, 10.0, None),  # 10 / 0, no region
    (None, 0, 0.0, 0.0, "Bretagne"),  # 0 / 0
    (None, 0, -1.0, -1.0, "Bretagne"),  # -1 / 0
    ("", 1, math.nan, math.nan, "Bretagne"),  # empty code, NaN equal to NaN
    ("B", None, None, None, "Bretagne"),  # null equal to null
]
REGISTER_SCHEMA = (
    "codeeicresourceobject string, nbinstallations long, puismaxinstallee double, "
    "maxpuis double, region string"
)


def rows(df) -> list[tuple]:
    return [tuple(row) for row in df.collect()]


def sorted_tuples(df) -> list[tuple]:
    return sorted(rows(df), key=lambda row: [(v is not None, str(v)) for v in row])


def executed_plan(df) -> str:
    """The plan as it ended, after adaptive execution has run the query."""
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def scans(text: str) -> int:
    return text.count("FileScan")
