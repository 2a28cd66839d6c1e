"""Document collections and JSON files."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tierfold.sources.tables import reconciled, with_fields

# Parse mode, corrupt-record column and date patterns of the sources.
PARSE_MODE = "PERMISSIVE"
CORRUPT_COLUMN = "_corrupt_record"
DATE_FORMAT = "yyyy-MM-dd"
TIMESTAMP_FORMAT = "yyyy-MM-dd'T'HH:mm:ss[.SSS][XXX]"

# Fields of the document collections that JSON cannot tell from text.
DOCUMENT_TYPES = {
    "patient": "dateCreated TIMESTAMP, lastUpdated TIMESTAMP, birthDate STRUCT<value: TIMESTAMP>",
    "user": "dateCreated TIMESTAMP, lastUpdated TIMESTAMP, lastLoginTimeStamp TIMESTAMP,"
    " dob TIMESTAMP",
}

FILE_FORMATS = ("json", "parquet", "orc", "avro")


def scan_collection(
    spark: SparkSession,
    collection: str,
    source_format: str = "json",
    root: str | None = None,
    schema: StructType | None = None,
    options: dict[str, str] | None = None,
    known: StructType | None = None,
) -> DataFrame:
    """All documents of a collection.

    File formats read ``root/collection``; any other format is taken as a connector that
    understands a ``collection`` option. Pass ``schema`` for large JSON collections:
    inferring it costs one more full read. Where it is inferred from JSON, the types of
    ``DOCUMENT_TYPES`` replace what was found for those fields. With ``known``, the columns of
    a table the documents are meant for, fields that are absent or always null have its types,
    and so have others where JSON cannot tell (``reconciled``).

    A JSON line that does not parse, or does not fit the types, keeps its text in
    ``CORRUPT_COLUMN``, which JSON documents always have.
    """
    if schema is None and source_format == "json" and root is not None:
        path = f"{root.rstrip('/')}/{collection}"
        infer = spark.read.option("columnNameOfCorruptRecord", CORRUPT_COLUMN)
        if known is not None:
            infer = infer.option("dropFieldIfAllNull", True)
        found = infer.options(**(options or {})).json(path).schema
        schema = _with_types(found, StructType.fromDDL(DOCUMENT_TYPES.get(collection, "")))
        if known is not None:
            schema = with_fields(reconciled(known, schema), known)
    if schema is not None and source_format == "json":
        schema = _with_corrupt(schema)
    reader = (
        spark.read.format(source_format)
        .option("mode", PARSE_MODE)
        .option("columnNameOfCorruptRecord", CORRUPT_COLUMN)
        .options(**(options or {}))
    )
    if schema is not None:
        reader = reader.schema(schema)
    if source_format not in FILE_FORMATS:
        return reader.option("collection", collection).load()
    if root is None:
        raise ValueError(f"a root folder is needed to read {source_format} documents")
    return reader.load(f"{root.rstrip('/')}/{collection}")


def _with_types(found: StructType, declared: StructType) -> StructType:
    kinds = {f.name: f for f in declared.fields}
    return StructType([kinds.get(f.name, f) for f in found.fields])


def _with_corrupt(schema: StructType) -> StructType:
    if CORRUPT_COLUMN in schema.names:
        return schema
    return StructType([*schema.fields, StructField(CORRUPT_COLUMN, StringType())])


def scan_json(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """JSON lines; a line that does not parse gives nulls and its text in CORRUPT_COLUMN."""
    return (
        spark.read.schema(_with_corrupt(schema))
        .option("mode", PARSE_MODE)
        .option("columnNameOfCorruptRecord", CORRUPT_COLUMN)
        .option("dateFormat", DATE_FORMAT)
        .option("timestampFormat", TIMESTAMP_FORMAT)
        .json(path)
    )


def scan_by_ids(
    documents: DataFrame, ids: Sequence[object] | DataFrame, key: str = "_id"
) -> DataFrame:
    """Documents whose key is listed.

    A Python list becomes an IN predicate and reaches the scan. Ids held in a one-column
    DataFrame are joined instead; they are made distinct first, which Spark does partly
    before the shuffle, so an id repeated very often costs one row per task.
    """
    if not isinstance(ids, DataFrame):
        return documents.where(F.col(key).isin(list(ids)))
    wanted = ids.toDF(key).distinct()
    return documents.join(wanted, key, "left_semi")


def scan_by_date_range(
    documents: DataFrame,
    low: datetime,
    high: datetime,
    column: str = "lastUpdated",
    key: str = "_id",
) -> DataFrame:
    """Non-anonymous documents strictly between two instants, ordered by key.

    The row number breaks ties, so that copies of one key can be spread over several of
    the ranges that the sort hands to its tasks.
    """
    kind = documents.schema[column].dataType
    # As text, so that a value without zone is not moved between the zones of driver and session.
    first, last = (F.lit(end.isoformat(sep=" ")).cast(kind) for end in (low, high))
    inside = (F.col(column) > first) & (F.col(column) < last)
    known = F.col("isAnonymous.value") == F.lit(False)
    return documents.where(inside & known).orderBy(key, F.monotonically_increasing_id())
