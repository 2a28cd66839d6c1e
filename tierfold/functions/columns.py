"""Built-in expressions only: every function stays inside whole-stage code generation
or at least inside the JVM, and Catalyst can prune nested fields through it."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# Separators, how a null part is shown, and the fraction used for repairs.
PART_SEPARATOR = "_"
ITEM_SEPARATOR = ","
NULL_PART = "null"
REPAIR_MICROS = 136_000


def identifier_concat(column: Column, element: StructType) -> Column:
    """Join an array of identifier structs into one string.

    Each item gives ``system_type_value``; items for which the system or the type is
    absent give the value alone; items without a value are left out. A null text inside a
    present part shows as ``null`` and an empty text as nothing. Null and empty arrays
    give an empty string.

    A part is absent when ``element`` has no such field, or the item's struct for it is
    null. The text sits in the first field of ``system`` and ``value``; for ``type`` it
    is the first field of its second field.
    """
    parts = {
        "system": ("system", 0),
        "type": ("type", 1, 0),
        "value": ("value", 0),
    }

    def part(item: Column, name: str) -> tuple[Column, Column] | None:
        """(is present, text) for one part, None if the schema lacks it."""
        root, *positions = parts[name]
        if root not in element.names:
            return None
        holder, kind = item.getField(root), element[root].dataType
        for position in positions[:-1]:
            holder = holder.getField(kind[position].name)
            kind = kind[position].dataType
        text = holder.getField(kind[positions[-1]].name)
        return holder.isNotNull(), F.coalesce(text, F.lit(NULL_PART))

    def render(item: Column) -> Column:
        value = part(item, "value")
        if value is None:
            return F.lit(None).cast("string")
        has_value, value_text = value
        shown = F.when(has_value, value_text)
        system, kind = part(item, "system"), part(item, "type")
        if system is None or kind is None:
            return shown
        full = F.concat_ws(PART_SEPARATOR, system[1], kind[1], value_text)
        return F.when(system[0] & kind[0] & has_value, full).otherwise(shown)

    joined = F.array_join(F.transform(column, render), ITEM_SEPARATOR)
    return F.coalesce(joined, F.lit(""))


def dob_to_date(column: Column) -> Column:
    """Calendar date of a timestamp in the session time zone; null stays null."""
    return column.cast("date")


def int_array_to_string(column: Column) -> Column:
    """Comma-joined array of integers; null and empty arrays give an empty string."""
    joined = F.array_join(column.cast("array<string>"), ITEM_SEPARATOR)
    return F.coalesce(joined, F.lit(""))


def timestamp_repair(column: Column) -> Column:
    """Replace the fraction by .136 unless it has exactly three significant digits.

    Works on the seconds field, not on an epoch, so neither the session time zone nor the
    kind of timestamp (with or without zone) matters.
    """
    micros = (F.extract(F.lit("SECOND"), column) * 1_000_000).cast("bigint") % 1_000_000
    three_digits = (micros % 1_000 == 0) & (micros % 10_000 != 0)
    shift = (REPAIR_MICROS - micros).cast("decimal(18,6)") / F.lit(1_000_000)
    return F.when(three_digits, column).otherwise(
        column + F.make_dt_interval(secs=shift.cast("decimal(18,6)"))
    )
