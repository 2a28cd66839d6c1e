"""The jobs: compositions of sources, operators and sinks.

Every job but ``patient_mart_direct`` gates on non-empty input; all raise on failure. Missing
tables write nothing. Row counts come from the writes themselves.
"""

from __future__ import annotations

import logging
from collections.abc import Callable
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tierfold.config import LakeConfig
from tierfold.operators.clean import CLEANERS, patient_rows
from tierfold.operators.columns import (
    PARTITION_COLUMN,
    copy_column,
    latest_per_key,
    with_raw_partition,
)
from tierfold.operators.marts import (
    activity_counts,
    join_renamed,
    rename_primary,
    rename_secondary,
)
from tierfold.operators.merge import MARK, MergeStats, finish_merge, merge_into, merged_up_to
from tierfold.sinks.files import append_json, append_partitioned, create_partitioned
from tierfold.sinks.marts import FileMart, Mart
from tierfold.sinks.retention import delete_stale, stale_files, vacuum_delta
from tierfold.sources import (
    CORRUPT_COLUMN,
    Layout,
    has_data,
    joined_schema,
    read_layout,
    scan_collection,
    scan_parquet,
    table_or_none,
    write_layout,
)
from tierfold.staging import children, path_exists, staged, write_note

log = logging.getLogger(__name__)

BATCH_COLUMN = "ingestBatch"  # number of the ingest a raw row came with, from 1


def preview(df: DataFrame, rows: int = 20) -> DataFrame:
    """Print schema and first rows; for interactive use, each call is one more job."""
    df.printSchema()
    df.show(rows, truncate=False)
    return df


def _documents(
    spark: SparkSession,
    config: LakeConfig,
    collection: str,
    schema: StructType | None,
    layout: Layout | None = None,
) -> DataFrame:
    """The documents to ingest, with the types of the raw table of that ``layout``, if any."""
    own = (PARTITION_COLUMN, BATCH_COLUMN)
    known = layout and StructType([f for f in layout.schema.fields if f.name not in own])
    return scan_collection(
        spark,
        collection,
        config.source_format,
        config.source_root,
        schema,
        config.source_options,
        known,
    )


def _layout_of(spark: SparkSession, config: LakeConfig, path: str) -> Layout | None:
    """Columns and last ingest of a raw table; None if there is no table yet.

    They are kept beside its files. Only for a table without that note the footers are read,
    and the ingest numbers.
    """
    layout = read_layout(spark, path) if config.table_format != "delta" else None
    if layout is not None:
        return layout
    table = table_or_none(spark, path, config.table_format)
    if table is None:
        return None
    last = 0
    if BATCH_COLUMN in table.columns:
        last = table.agg(F.max(BATCH_COLUMN)).first()[0] or 0
    return Layout(table.schema, last)


def _append_raw(
    spark: SparkSession, config: LakeConfig, rows: DataFrame, path: str, layout: Layout | None
) -> int:
    """Append rows under the number of a new ingest, if the table can take their types.

    The note with all columns is written first: columns of an append that then fails are
    merely null, and its number is not used again.
    """
    batch = layout.batch + 1 if layout else 1
    numbered = rows.withColumn(BATCH_COLUMN, F.lit(batch).cast("long"))
    schema = joined_schema(layout.schema, numbered.schema) if layout else numbered.schema
    if config.table_format != "delta":
        write_layout(spark, path, Layout(schema, batch))
    return append_partitioned(
        numbered, path, config.table_format, partitions=config.write_partitions
    )


def raw_ingest(
    spark: SparkSession, config: LakeConfig, collection: str, schema: StructType | None = None
) -> int:
    """Append all documents of a collection to its raw table; returns the rows added.

    Rows get the number of the ingest (``BATCH_COLUMN``). Types inferred from JSON follow the
    table's where JSON cannot tell. Documents that cannot be read, or do not fit the types, go
    to the quarantine folder with their text; they are counted while the others are written,
    and the source is read again only if there are any.
    """
    path = config.raw_path(collection)
    layout = _layout_of(spark, config, path)
    documents = _documents(spark, config, collection, schema, layout)
    checked = CORRUPT_COLUMN in documents.columns
    observed, rows = Observation(), 0
    if _whole(documents).first() is not None:  # of all columns: JSON is not read for none
        if checked:
            counted = documents.observe(observed, F.count(CORRUPT_COLUMN).alias("broken"))
        whole = _whole(counted if checked else documents)
        rows = _append_raw(spark, config, with_raw_partition(whole), path, layout)
        log.info("%s: %d rows appended", path, rows)
    else:
        log.warning("%s: no documents", collection)
    if checked and (rows == 0 or observed.get["broken"]):
        broken = _quarantine(spark, config, collection, documents, layout)
        log.warning("%s: %d documents quarantined", collection, broken)
    return rows


def _whole(documents: DataFrame) -> DataFrame:
    if CORRUPT_COLUMN not in documents.columns:
        return documents
    return documents.where(F.col(CORRUPT_COLUMN).isNull()).drop(CORRUPT_COLUMN)


def _quarantine(
    spark: SparkSession,
    config: LakeConfig,
    collection: str,
    documents: DataFrame,
    layout: Layout | None,
) -> int:
    """Keep the broken documents: text, what of it could be read (as JSON), file and ingest."""
    readable = F.struct(*(F.col(c) for c in documents.columns if c != CORRUPT_COLUMN))
    rows = documents.where(F.col(CORRUPT_COLUMN).isNotNull()).select(
        F.col(CORRUPT_COLUMN).alias("document"),
        F.to_json(readable).alias("readable"),
        F.col("_metadata.file_path").alias("file"),
        F.lit(layout.batch + 1 if layout else 1).cast("long").alias(BATCH_COLUMN),
    )
    if rows.first() is None:
        return 0
    observed = Observation()
    counted = rows.observe(observed, F.count(F.lit(1)).alias("rows"))
    counted.write.mode("append").parquet(config.quarantine_path(collection))
    return observed.get["rows"]


def _raw_rows(
    spark: SparkSession,
    config: LakeConfig,
    collection: str,
    schema: StructType | None = None,
    since: date | None = None,
    batches: tuple[int, int] | None = None,
) -> DataFrame | None:
    """The raw table, read by its noted columns; ``batches`` are first (exclusive) and last."""
    path = config.raw_path(collection)
    if schema is None and config.table_format != "delta":
        layout = read_layout(spark, path)
        schema = layout and layout.schema
        if schema is not None and not has_data(spark, path, config.table_format):
            return None
    raw = table_or_none(spark, path, config.table_format, schema, since)
    if raw is None or batches is None:
        return raw
    return raw.where((F.col(BATCH_COLUMN) > batches[0]) & (F.col(BATCH_COLUMN) <= batches[1]))


def _cleaned(
    spark: SparkSession,
    config: LakeConfig,
    collection: str,
    raw_schema: StructType | None = None,
    since: date | None = None,
    latest: bool = False,
    batches: tuple[int, int] | None = None,
) -> DataFrame | None:
    """Clean rows from the raw table; None for an unknown collection or a missing table."""
    clean = CLEANERS.get(collection)
    if clean is None:
        log.error("%s: no clean step is defined", collection)
        return None
    raw = _raw_rows(spark, config, collection, raw_schema, since, batches)
    if raw is None:
        return None
    return clean(latest_per_key(raw, "_id", "lastUpdated") if latest else raw)


def _clean_table(
    spark: SparkSession,
    config: LakeConfig,
    collection: str,
    schema: StructType | None = None,
) -> DataFrame | None:
    """The clean table, once any merge into it that was interrupted has been finished."""
    path = config.clean_path(collection)
    if config.table_format != "delta" and finish_merge(spark, path):
        log.warning("%s: an interrupted merge was finished", path)
    return table_or_none(spark, path, config.table_format, schema)


def clean_load(
    spark: SparkSession,
    config: LakeConfig,
    collection: str,
    raw_schema: StructType | None = None,
    since: date | None = None,
    latest: bool = False,
    extra_columns: bool = True,
    incremental: bool = False,
) -> MergeStats | None:
    """Bring the clean table up to date with the raw table; None if there is nothing to clean.

    The first run creates the table as is, duplicates included; later runs upsert. The raw
    table is read by its noted columns or ``raw_schema``, without its footers; without
    ``extra_columns`` (columns other writers may have added to the clean table) none of the
    clean one are read either.

    ``incremental`` cleans the ingests after the last one cleaned, whatever their documents'
    dates; its number is kept with the clean table, in the same commit as the rows. Without
    one all raw rows are cleaned. ``since`` reads only raw rows whose partition date, that of
    ``lastUpdated``, is that day or later; documents that arrive late under an older date are
    not among them. ``latest`` takes the newest raw row of each document, without which a
    document that was ingested twice is refused by the merge.
    """
    path = config.clean_path(collection)
    keeps_mark = config.table_format != "delta"
    if incremental and not keeps_mark:
        raise ValueError("Delta's own merge keeps no mark of the ingests cleaned")
    layout = read_layout(spark, config.raw_path(collection)) if keeps_mark else None
    if keeps_mark:
        finish_merge(spark, path)
    done = merged_up_to(spark, path) if keeps_mark else None
    batches = None
    if incremental and layout is not None and done is not None:
        batches = (done, layout.batch)
    rows = _cleaned(spark, config, collection, raw_schema, since, latest, batches)
    if rows is None or rows.isEmpty():
        log.warning("%s: nothing to clean", collection)
        return None
    # after a run over some of the dates earlier ingests are not known to be clean
    mark = layout.batch if layout is not None and since is None else None
    schema = None if extra_columns else rows.schema
    target = _clean_table(spark, config, collection, schema)
    layout_options = {"table_format": config.table_format, "partitions": config.write_partitions}
    if target is None or (schema is not None and not has_data(spark, path, config.table_format)):
        # a first load that failed leaves a folder without data files
        first = append_partitioned if path_exists(spark, path) else create_partitioned
        written = first(rows, path, **layout_options)
        if mark is not None:
            write_note(spark, f"{path}/{MARK}", mark)
        return MergeStats(written, 0, written)
    merged = merge_into(spark, path, rows, target=target, mark=mark, **layout_options)
    return merged if merged is not None else MergeStats(-1, -1, -1)  # Delta tells no counts


def _load_mart(df: DataFrame | None, mart: Mart, table: str) -> int:
    if df is None or df.isEmpty():
        log.warning("%s: nothing to load", table)
        return 0
    return mart.overwrite(df, table)


def mart_load(spark: SparkSession, config: LakeConfig, mart: Mart, collection: str) -> int:
    """Overwrite the mart table of a collection by its clean table."""
    return _load_mart(_clean_table(spark, config, collection), mart, collection)


def mart_load_from_raw(
    spark: SparkSession, config: LakeConfig, mart: Mart, collection: str
) -> int:
    """Same from the raw table. Not recommended: raw tables repeat re-ingested rows."""
    return _load_mart(_cleaned(spark, config, collection), mart, collection)


def joined_mart_load(
    spark: SparkSession,
    config: LakeConfig,
    mart: Mart,
    primary: str = "patient",
    secondary: str = "user",
) -> tuple[int, int]:
    """Overwrite ``<primary>_<secondary>`` and ``<primary>_aggData``.

    The join is evaluated once, at full parallelism: for a file mart into a new folder that
    takes the table's place, for a database into the shared folder, which keeps the few
    connections from throttling the join. With an empty join neither table is touched.
    """
    left, right = (_clean_table(spark, config, name) for name in (primary, secondary))
    if left is None or right is None:
        log.warning("%s, %s: a clean table is missing", primary, secondary)
        return 0, 0
    users, table = rename_secondary(right), f"{primary}_{secondary}"
    joined = join_renamed(rename_primary(left), users)
    if isinstance(mart, FileMart):
        joined_rows = mart.overwrite_if_any(joined, table)
    else:
        with staged(joined, "join") as join:
            joined_rows = mart.overwrite(join.df, table) if join.rows else 0
    if joined_rows == 0:
        log.warning("%s, %s: the join is empty", primary, secondary)
        return 0, 0
    return joined_rows, mart.overwrite(activity_counts(users), f"{primary}_aggData")


def document_copy(
    spark: SparkSession,
    config: LakeConfig,
    path: str,
    as_json: bool = False,
    schema: StructType | None = None,
) -> int:
    """Patient documents with a second address column, appended to ``path``."""
    if as_json:
        documents = _documents(spark, config, "patient", schema).drop(CORRUPT_COLUMN)
        if documents.first() is None:
            return 0
        rows = copy_column(with_raw_partition(documents))
        return append_json(rows, path, partitions=config.write_partitions)
    layout = _layout_of(spark, config, path)
    documents = _whole(_documents(spark, config, "patient", schema, layout))
    if documents.first() is None:
        return 0
    return _append_raw(spark, config, copy_column(with_raw_partition(documents)), path, layout)


def object_store_rows(spark: SparkSession, *uris: str) -> DataFrame:
    """Parquet documents at object-store URIs with their partition date; writes nothing."""
    return with_raw_partition(scan_parquet(spark, *uris))


def live_folders(spark: SparkSession, config: LakeConfig) -> list[str]:
    """All tables of the lake, its sources and its file marts."""
    root = config.root.rstrip("/")
    prefixes = (config.raw_prefix, config.clean_prefix, "quarantine.")
    tables = [f"{root}/{n}" for n in children(spark, root) if n.startswith(prefixes)]
    return [*tables, *(p for p in (config.source_root, config.mart_root) if p is not None)]


def retention(
    spark: SparkSession, config: LakeConfig, collection: str, root: str | None = None
) -> DataFrame | None:
    """Clean up a raw table: Delta deletes files itself, otherwise a report is returned.

    The report has the old files below ``root`` that belong to no table of the lake, nor to its
    sources or marts. A Parquet table's own folder holds nothing else, so without a wider
    ``root`` there is nothing to compare and None is returned.
    """
    path = config.raw_path(collection)
    if config.table_format == "delta":
        vacuum_delta(spark, path, config.retention_hours)
        return None
    if root is None:
        log.warning("%s: every file of its own folder is live", path)
        return None
    return stale_files(spark, root, live_folders(spark, config), config.retention_hours)


def remove_stale(spark: SparkSession, config: LakeConfig, root: str) -> int:
    """Delete what ``retention`` reports below ``root``; returns the number of files."""
    live = live_folders(spark, config)
    report = stale_files(spark, root, live, config.retention_hours)
    return delete_stale(report, root, live)


def patient_mart_direct(spark: SparkSession, config: LakeConfig, mart: Mart) -> int:
    """Patient mart straight from raw documents, without a partition date (older form)."""
    raw = _raw_rows(spark, config, "patient")
    return 0 if raw is None else mart.overwrite(patient_rows(raw), "patient")


@dataclass(frozen=True)
class Options:
    """What the command line can add to an action."""

    since: date | None = None
    latest: bool = False
    incremental: bool = False
    json: str | None = None
    objects: tuple[str, ...] = ()
    delete: bool = False


def _process(spark: SparkSession, config: LakeConfig, options: Options) -> object:
    """Documents of the source to the raw table or a JSON folder, or rows at object-store URIs."""
    if options.objects:
        return object_store_rows(spark, *options.objects)
    path = options.json or config.raw_path("patient")
    return document_copy(spark, config, path, as_json=options.json is not None)


def _clean_files(spark: SparkSession, config: LakeConfig, options: Options) -> object:
    if options.delete and config.retention_root is not None and config.table_format != "delta":
        return remove_stale(spark, config, config.retention_root)
    return retention(spark, config, "patient", config.retention_root)


def _clean(spark: SparkSession, config: LakeConfig, options: Options, name: str) -> object:
    return clean_load(
        spark, config, name,
        since=options.since, latest=options.latest, incremental=options.incremental,
    )


# The action names users start jobs by, and how many collections each takes.
ACTIONS: dict[str, tuple[int, Callable]] = {
    "processData": (0, lambda s, c, m, o: _process(s, c, o)),
    "cleanFile": (0, lambda s, c, m, o: _clean_files(s, c, o)),
    "cleanData": (0, lambda s, c, m, o: patient_mart_direct(s, c, m())),
    "processMongoRawData": (1, lambda s, c, m, o, name: raw_ingest(s, c, name)),
    "cleanMongoRawData": (1, lambda s, c, m, o, name: _clean(s, c, o, name)),
    "loadDiscreteDataInMysql": (1, lambda s, c, m, o, name: mart_load(s, c, m(), name)),
    "loadDiscreteDataInMysqlFromRaw": (
        1,
        lambda s, c, m, o, name: mart_load_from_raw(s, c, m(), name),
    ),
    "loadAggregatedDataInMysql": (2, lambda s, c, m, o, a, b: joined_mart_load(s, c, m(), a, b)),
}
