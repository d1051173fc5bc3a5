"""Readers, the landing of raw files, projections and catalog tables."""

from voltledger.sources.bronze import (
    land_json_documents,
    land_json_lines,
    read_accepted,
    read_rejected,
)
from voltledger.sources.files import flatten_results, read_csv, read_json_records, read_parquet
from voltledger.sources.footers import stored_profile
from voltledger.sources.manifest import land_new_contents, read_contents, read_manifest
from voltledger.sources.silver import project
from voltledger.sources.tables import (
    append_claimed,
    append_rows,
    create_table,
    insert_row,
    read_ordered,
)

__all__ = [
    "append_claimed",
    "append_rows",
    "create_table",
    "flatten_results",
    "insert_row",
    "land_json_documents",
    "land_json_lines",
    "land_new_contents",
    "project",
    "read_accepted",
    "read_contents",
    "read_csv",
    "read_json_records",
    "read_manifest",
    "read_ordered",
    "read_parquet",
    "read_rejected",
    "stored_profile",
]
