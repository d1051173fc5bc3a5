"""Column-to-column helpers. All stay inside built-in Spark expressions."""

from voltledger.functions.dates import (
    dates_differ,
    days_between,
    is_unreadable_date,
    parse_date,
)
from voltledger.functions.names import col, names_containing, quoted, require_columns, unused
from voltledger.functions.numeric import divide_ieee, ratio_above, round_half_even, sum_or_zero
from voltledger.functions.predicates import all_true, differs, first_available

__all__ = [
    "all_true",
    "col",
    "dates_differ",
    "days_between",
    "differs",
    "divide_ieee",
    "first_available",
    "is_unreadable_date",
    "names_containing",
    "parse_date",
    "quoted",
    "ratio_above",
    "require_columns",
    "round_half_even",
    "sum_or_zero",
    "unused",
]
