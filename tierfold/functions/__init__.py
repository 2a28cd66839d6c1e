"""Column functions of the clean step, and their SQL names."""

from tierfold.functions.columns import (
    dob_to_date,
    identifier_concat,
    int_array_to_string,
    timestamp_repair,
)
from tierfold.functions.sql import register_sql_functions

__all__ = [
    "dob_to_date",
    "identifier_concat",
    "int_array_to_string",
    "register_sql_functions",
    "timestamp_repair",
]
