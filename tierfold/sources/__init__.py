"""Readers: document collections, layer tables, Parquet and JSON at any URI."""

from tierfold.sources.documents import (
    CORRUPT_COLUMN,
    scan_by_date_range,
    scan_by_ids,
    scan_collection,
    scan_json,
)
from tierfold.sources.tables import (
    Layout,
    OpenMerge,
    SchemaMismatch,
    ensure_appendable,
    has_data,
    joined_schema,
    read_layout,
    scan_layer,
    scan_parquet,
    table_or_none,
    write_layout,
)

__all__ = [
    "CORRUPT_COLUMN",
    "Layout",
    "OpenMerge",
    "SchemaMismatch",
    "ensure_appendable",
    "has_data",
    "joined_schema",
    "read_layout",
    "scan_by_date_range",
    "scan_by_ids",
    "scan_collection",
    "scan_json",
    "scan_layer",
    "scan_parquet",
    "table_or_none",
    "write_layout",
]
