"""Writers: partitioned layer tables, marts, and the stale-file report."""

from tierfold.sinks.files import (
    append_json,
    append_partitioned,
    create_partitioned,
    overwrite_partitions,
)
from tierfold.sinks.marts import FileMart, JdbcMart, Mart, mart_from_config
from tierfold.sinks.retention import delete_stale, stale_files

__all__ = [
    "FileMart",
    "JdbcMart",
    "Mart",
    "append_json",
    "append_partitioned",
    "create_partitioned",
    "delete_stale",
    "mart_from_config",
    "overwrite_partitions",
    "stale_files",
]
