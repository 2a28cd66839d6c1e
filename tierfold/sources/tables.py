"""Layer tables and plain Parquet."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    DataType,
    DateType,
    FractionalType,
    IntegralType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
    TimestampType,
)

from tierfold.operators.columns import PARTITION_COLUMN
from tierfold.session import settings_during
from tierfold.staging import children, path_exists, read_note, write_note

# Names, in a table's folder, the dates of a merge whose commit has begun.
PENDING = "_pending_merge"
# The columns of a raw table and the number of its last ingest, beside its files.
LAYOUT = "_layout"

LISTING_KEY = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
ABSENT = (
    "PATH_NOT_FOUND",
    "UNABLE_TO_INFER_SCHEMA",
    "DELTA_MISSING_DELTA_TABLE",
    "DELTA_PATH_DOES_NOT_EXIST",
    "DELTA_TABLE_NOT_FOUND",
)


class OpenMerge(RuntimeError):
    """A table some of whose dates have not been replaced yet."""


def scan_layer(
    spark: SparkSession,
    path: str,
    table_format: str = "parquet",
    schema: StructType | None = None,
) -> DataFrame:
    """A raw or clean table with the columns of all its files.

    Files written before a column was added lack it, so Parquet footers are merged (a
    distributed job). With ``schema`` no footer is read for that. Folders are listed by a
    few tasks per core, not by one task each.

    Raises ``OpenMerge`` while a merge into the table is half in place; ``finish_merge`` ends
    that, and the jobs call it before they read.
    """
    if path_exists(spark, f"{path.rstrip('/')}/{PENDING}"):
        raise OpenMerge(f"{path}: a merge has begun to replace dates; finish_merge completes it")
    lists = min(int(spark.conf.get(LISTING_KEY)), 4 * spark.sparkContext.defaultParallelism)
    reader = spark.read.format(table_format)
    if schema is not None:
        reader = reader.schema(schema)
    elif table_format in ("parquet", "orc"):
        reader = reader.option("mergeSchema", True)
    with settings_during(spark, {LISTING_KEY: str(lists)}):
        table = reader.load(path)
    # With nothing but null dates the folder names do not show the type.
    if PARTITION_COLUMN in table.columns:
        if not isinstance(table.schema[PARTITION_COLUMN].dataType, DateType):
            table = table.withColumn(PARTITION_COLUMN, F.col(PARTITION_COLUMN).cast("date"))
    return table


def table_or_none(
    spark: SparkSession,
    path: str,
    table_format: str = "parquet",
    schema: StructType | None = None,
    since: date | None = None,
) -> DataFrame | None:
    """The table at ``path``, or None when there is none yet.

    With ``schema`` no footer is read for the columns. ``since`` keeps partition dates from
    that day on, so that older folders are not read; rows without a date stay out too.
    """
    try:
        table = scan_layer(spark, path, table_format, schema)
        return table if since is None else table.where(F.col(PARTITION_COLUMN) >= F.lit(since))
    except AnalysisException as error:
        if error.getCondition() in ABSENT:
            return None
        raise


@dataclass(frozen=True)
class Layout:
    """What a raw table's writer keeps beside its files: all columns, and the last ingest."""

    schema: StructType
    batch: int


def read_layout(spark: SparkSession, path: str) -> Layout | None:
    note = read_note(spark, f"{path}/{LAYOUT}")
    return note and Layout(StructType.fromJson(note["schema"]), note["batch"])


def write_layout(spark: SparkSession, path: str, layout: Layout) -> None:
    note = {"schema": layout.schema.jsonValue(), "batch": layout.batch}
    write_note(spark, f"{path}/{LAYOUT}", note)


def has_data(spark: SparkSession, path: str, table_format: str = "parquet") -> bool:
    """Whether the table's folder holds anything that a scan would look at."""
    if table_format != "delta":
        return any(not name.startswith(("_", ".")) for name in children(spark, path))
    try:
        spark.read.format(table_format).load(path)
    except AnalysisException as error:
        if error.getCondition() in ABSENT:
            return False
        raise
    return True


class SchemaMismatch(TypeError):
    """Rows whose types the table they are meant for cannot take."""


def ensure_appendable(table: DataFrame, rows: DataFrame) -> None:
    """Raise if a column of ``rows`` has another type than in ``table``.

    Columns and nested fields may be new or missing. Files of different types in one
    table could be written, but no longer be read together.
    """
    joined_schema(table.schema, rows.schema)


def joined_schema(table: StructType, rows: StructType) -> StructType:
    """The columns of both; raises as ``ensure_appendable`` does."""
    clashes = _clashes(table, rows, "")
    if clashes:
        raise SchemaMismatch("; ".join(clashes))
    return with_fields(table, rows)


def with_fields(old: DataType, new: DataType) -> DataType:
    """``old`` with the fields, nested ones too, that only ``new`` has."""
    if isinstance(old, StructType) and isinstance(new, StructType):
        theirs = {f.name.lower(): f.dataType for f in new.fields}
        ours = {f.name.lower() for f in old.fields}
        kept = [
            StructField(f.name, with_fields(f.dataType, theirs.get(f.name.lower(), f.dataType)))
            for f in old.fields
        ]
        added = [StructField(f.name, f.dataType) for f in new.fields if f.name.lower() not in ours]
        return StructType(kept + added)
    if isinstance(old, ArrayType) and isinstance(new, ArrayType):
        return ArrayType(with_fields(old.elementType, new.elementType))
    return old


def reconciled(table: DataType, found: DataType) -> DataType:
    """Types to read documents of inferred types ``found`` with, so that ``table`` can take them.

    Where JSON cannot tell, the table's type counts: a text may be a time, a whole number may
    belong to a column of fractions, and any plain value to one of texts. Values that do not fit
    make their document a broken one when it is read. Other differences stay, and are refused
    when the rows are to be appended.
    """
    if isinstance(table, StructType) and isinstance(found, StructType):
        known = {f.name.lower(): f.dataType for f in table.fields}
        return StructType(
            [
                StructField(f.name, reconciled(known.get(f.name.lower(), f.dataType), f.dataType))
                for f in found.fields
            ]
        )
    if isinstance(table, ArrayType) and isinstance(found, ArrayType):
        return ArrayType(reconciled(table.elementType, found.elementType))
    nested = (StructType, ArrayType)
    fits = (
        isinstance(table, StringType) and not isinstance(found, nested)
        or isinstance(table, DateType | TimestampType | TimestampNTZType)
        and isinstance(found, StringType)
        or isinstance(table, FractionalType) and isinstance(found, IntegralType)
    )
    return table if fits else found


def _clashes(old: DataType, new: DataType, where: str) -> list[str]:
    if isinstance(old, StructType) and isinstance(new, StructType):
        known = {f.name.lower(): f.dataType for f in old.fields}
        return [
            clash
            for f in new.fields
            if f.name.lower() in known
            for clash in _clashes(known[f.name.lower()], f.dataType, f"{where}.{f.name}")
        ]
    if isinstance(old, ArrayType) and isinstance(new, ArrayType):
        return _clashes(old.elementType, new.elementType, f"{where}[]")
    if old.simpleString() == new.simpleString():
        return []
    return [f"{where.lstrip('.')} is {old.simpleString()}, not {new.simpleString()}"]


def scan_parquet(spark: SparkSession, *uris: str) -> DataFrame:
    """Parquet at any URI Hadoop knows, such as ``s3a://bucket/key``."""
    return spark.read.parquet(*uris)
