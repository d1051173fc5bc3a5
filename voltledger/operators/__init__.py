"""Operators from DataFrame to DataFrame, each one lazy unless its docstring says otherwise."""

from voltledger.operators.duplicates import duplicate_key_report, duplicated_rows, duplicated_sum
from voltledger.operators.exact import exact_sums
from voltledger.operators.grouping import (
    group_share,
    group_sums,
    sum_columns,
    sum_matching,
    sum_rounded,
)
from voltledger.operators.kept import (
    add_grid_load,
    add_key_counts,
    add_sketches,
    at_least_distinct,
    duplicated_in_load,
    kept_day_completeness,
    kept_distinct,
    kept_duplicates,
    key_counts,
)
from voltledger.operators.ordering import sorted_rows, top_rows
from voltledger.operators.profiling import (
    columns_equal,
    count_distinct,
    count_per_column,
    frame_shape,
    has_null,
    min_max,
    null_columns,
    null_columns_only,
    null_count,
    row_count,
    rows_differing,
    select_matching,
    value_counts,
)
from voltledger.operators.reconcile import exclusion_report, published_totals, reconcile
from voltledger.operators.series import (
    grid_balance,
    grid_completeness,
    grid_day_completeness,
    missing_slots,
    status_partition,
    status_period,
)

__all__ = [
    "add_grid_load",
    "add_key_counts",
    "add_sketches",
    "at_least_distinct",
    "columns_equal",
    "count_distinct",
    "count_per_column",
    "duplicate_key_report",
    "duplicated_in_load",
    "duplicated_rows",
    "duplicated_sum",
    "exact_sums",
    "exclusion_report",
    "frame_shape",
    "grid_balance",
    "grid_completeness",
    "grid_day_completeness",
    "group_share",
    "group_sums",
    "has_null",
    "kept_day_completeness",
    "kept_distinct",
    "kept_duplicates",
    "key_counts",
    "min_max",
    "missing_slots",
    "null_columns",
    "null_columns_only",
    "null_count",
    "published_totals",
    "reconcile",
    "row_count",
    "rows_differing",
    "select_matching",
    "sorted_rows",
    "status_partition",
    "status_period",
    "sum_columns",
    "sum_matching",
    "sum_rounded",
    "top_rows",
    "value_counts",
]
