"""Conditional upsert.

A source row whose key is in the target replaces all columns of the target rows with that
key *and* the same guard value; if the guard differs or is null the target row stays and
the source row is dropped. A source row with a new or null key is inserted. Nothing is
deleted. Two source rows for one key that is in the target are an error.

Columns of both sides take the target's type. Columns only the source has are added (null
in other rows); columns only the target has keep their value on update and are null on
insert.
"""

from __future__ import annotations

import logging
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tierfold.session import settings_during
from tierfold.sinks.files import create_partitioned
from tierfold.sources.tables import PENDING, scan_layer
from tierfold.staging import (
    children,
    delete_tree,
    move_tree,
    path_exists,
    read_note,
    staged,
    write_note,
)

log = logging.getLogger(__name__)

# Names in the table's folder, which readers skip as they start with an underscore: the new
# contents of dates, and the mark of the last merge.
STAGE = "_merge-"
MARK = "_merged_up_to"

ACTION = "_merge_action"
UPDATE, INSERT = "update", "insert"


class DuplicateSourceKeys(ValueError):
    """Several source rows match the same target key."""


class LostStage(RuntimeError):
    """Staged contents of a merge are gone before they were put in place."""


@dataclass(frozen=True)
class MergeStats:
    source_rows: int
    updated: int
    inserted: int

    @property
    def dropped(self) -> int:
        """Source rows whose key is in the target under another guard value."""
        return self.source_rows - self.updated - self.inserted


def _keys(df: DataFrame, key: str) -> DataFrame:
    return df.select(key).where(F.col(key).isNotNull()).distinct()


def check_source(target: DataFrame, source: DataFrame, key: str = "mongoId") -> int:
    """Number of source rows; raises if a repeated source key is in the target.

    Reads only the key column of the source. The target is read only if there are
    repeated keys. Counting is partial before the shuffle, so a hot key is cheap.
    """
    per_key = source.groupBy(key).count()
    repeated = (F.col("count") > 1) & F.col(key).isNotNull()
    totals = per_key.agg(
        F.sum("count").alias("rows"), F.count_if(repeated).alias("repeated")
    ).first()
    if totals["repeated"]:
        clashes = per_key.where(repeated).join(_keys(target, key), key, "left_semi")
        example = clashes.first()
        if example is not None:
            raise DuplicateSourceKeys(
                f"{example['count']} source rows for {key} {example[key]!r}, which is in the target"
            )
    return totals["rows"] or 0


def _with_types_of(target: DataFrame, source: DataFrame) -> DataFrame:
    """The source with the target's types in the columns they share."""
    kinds = {f.name.lower(): f.dataType for f in target.schema.fields}
    changed = {
        f.name: F.col(f.name).cast(kinds[f.name.lower()])
        for f in source.schema.fields
        if kinds.get(f.name.lower(), f.dataType).simpleString() != f.dataType.simpleString()
    }
    return source.withColumns(changed) if changed else source


def _columns(target: DataFrame, source: DataFrame) -> list[str]:
    known = {name.lower() for name in target.columns}
    return target.columns + [c for c in source.columns if c.lower() not in known]


def _updated(target: DataFrame, source: DataFrame, key: str, guard: str) -> DataFrame:
    """Target rows, with the columns of the source row of the same key and guard if any.

    A left join: Spark can split a hot key on the target side, and the source side has
    one row per matching key.
    """
    old, new = target.alias("old"), source.withColumn("_hit", F.lit(True)).alias("new")
    condition = (F.col(f"old.{key}") == F.col(f"new.{key}")) & (
        F.col(f"old.{guard}") == F.col(f"new.{guard}")
    )
    theirs = {name.lower() for name in source.columns}
    ours = {name.lower() for name in target.columns}

    def pick(name: str) -> Column:
        if name.lower() not in theirs:
            return F.col(f"old.{name}")
        if name.lower() not in ours:
            return F.col(f"new.{name}").alias(name)
        new_value = F.when(F.col("_hit"), F.col(f"new.{name}"))
        return new_value.otherwise(F.col(f"old.{name}")).alias(name)

    return old.join(new, condition, "left").select(*(pick(c) for c in _columns(target, source)))


def merged(
    target: DataFrame, source: DataFrame, key: str = "mongoId", guard: str = "partitionDate"
) -> DataFrame:
    """The table after the upsert, as one DataFrame; nothing is written."""
    source = _with_types_of(target, source)
    check_source(target, source, key)
    actions = _classified(target, source, key, guard)
    updates = actions.where(F.col(ACTION) == UPDATE).drop(ACTION)
    inserts = actions.where(F.col(ACTION) == INSERT).drop(ACTION)
    changed = _updated(target, updates, key, guard)
    return changed.unionByName(inserts, allowMissingColumns=True)


def merge_into(
    spark: SparkSession,
    path: str,
    source: DataFrame,
    key: str = "mongoId",
    guard: str = "partitionDate",
    table_format: str = "parquet",
    target: DataFrame | None = None,
    partitions: int | None = None,
    mark: int | None = None,
) -> MergeStats | None:
    """Upsert into the table at ``path``, which is partitioned by ``guard``.

    ``target`` is a scan of that table if the caller has one; ``partitions`` is passed to
    the writer (for the fewest files at least the number of dates); ``mark`` is kept with the
    table once the merge is in place (see ``merged_up_to``).

    Delta tables use Delta's own MERGE (no statistics). Other tables, in the same way at
    every size:

    1. finish an earlier merge whose commit was interrupted;
    2. ``stage_merge``: count the source keys and refuse ambiguous ones, join the source to the
       target's (key, guard) pairs, and write the new contents of every date that is updated
       or inserted into, once, beside the table; dates are a small dataset of their own, so
       that Spark prunes the target by them;
    3. note the dates, which begins the commit;
    4. ``finish_merge``: put the folder of each date in the place of the old one.

    A failure before 3 leaves the table as it was and no stage behind, and the merge can
    simply be run again. From 3 on the table is not read until 4 has been finished, which any
    later run does first. There must be one writer at a time.
    """
    if table_format == "delta":
        _merge_delta(spark, path, source, key, guard)
        return None
    if finish_merge(spark, path):
        target = None
    stats = stage_merge(spark, path, source, key, guard, table_format, target, partitions, mark)
    finish_merge(spark, path)
    return stats


def stage_merge(
    spark: SparkSession,
    path: str,
    source: DataFrame,
    key: str = "mongoId",
    guard: str = "partitionDate",
    table_format: str = "parquet",
    target: DataFrame | None = None,
    partitions: int | None = None,
    mark: int | None = None,
) -> MergeStats:
    """Write the new contents of all dates concerned and note them; nothing is replaced yet."""
    if target is None:
        target = scan_layer(spark, path, table_format)
    source = _with_types_of(target, source)
    source_rows = check_source(target, source, key)
    if source_rows == 0:
        return MergeStats(0, 0, 0)

    with staged(
        _classified(target, source, key, guard),
        "merge",
        partition_by=ACTION,
        counts={
            UPDATE: F.count_if(F.col(ACTION) == UPDATE),
            INSERT: F.count_if(F.col(ACTION) == INSERT),
        },
    ) as stage:
        stats = MergeStats(source_rows, stage.counts[UPDATE], stage.counts[INSERT])
        if stats.updated or stats.inserted:
            updates = stage.df.where(F.col(ACTION) == UPDATE).drop(ACTION)
            inserts = stage.df.where(F.col(ACTION) == INSERT).drop(ACTION)
            contents = f"{path}/{STAGE}{uuid.uuid4().hex}"
            try:
                with _dates(stage.df, guard) as dates:
                    rewritten = _updated(_on_dates(target, dates, guard), updates, key, guard)
                    create_partitioned(
                        rewritten.unionByName(inserts, allowMissingColumns=True),
                        contents, table_format, guard, partitions,
                    )
                _begin_commit(spark, path, contents, guard, mark)
            except BaseException:
                if read_note(spark, f"{path}/{PENDING}") is None:
                    delete_tree(spark, contents)
                raise
        elif mark is not None:
            write_note(spark, f"{path}/{MARK}", mark)
    if stats.dropped:
        log.warning("%s: %d source rows dropped, their %s differs", path, stats.dropped, guard)
    return stats


def _begin_commit(
    spark: SparkSession, path: str, contents: str, guard: str, mark: int | None
) -> None:
    """Note the staged dates, each with one of its files by which it is known again."""
    dates = {}
    for name in children(spark, contents):
        if name.startswith(f"{guard}="):
            files = children(spark, f"{contents}/{name}")
            dates[name] = next(f for f in files if not f.startswith(("_", ".")))
    write_note(spark, f"{path}/{PENDING}", {"stage": contents, "dates": dates, "mark": mark})


def finish_merge(spark: SparkSession, path: str) -> bool:
    """Put the staged dates of a begun merge in place; whether there was one.

    Each date's folder is renamed into the place of the old one. A date is done once the table
    holds the file noted for it, so this can be repeated until it succeeds, from whichever
    date it was interrupted at. If a date is neither staged nor in place its rows are lost:
    ``LostStage`` is raised and the note stays, so that the table is not taken for whole.
    """
    note = read_note(spark, f"{path}/{PENDING}")
    if note is None:
        return False
    contents = note["stage"]
    for name, file in note["dates"].items():
        if path_exists(spark, f"{contents}/{name}/{file}"):
            delete_tree(spark, f"{path}/{name}")
            move_tree(spark, f"{contents}/{name}", f"{path}/{name}")
        elif not path_exists(spark, f"{path}/{name}/{file}"):
            raise LostStage(f"{path}: the new contents of {name} are not in {contents} any more")
    if note["mark"] is not None:
        write_note(spark, f"{path}/{MARK}", note["mark"])
    delete_tree(spark, f"{path}/{PENDING}")
    delete_tree(spark, contents)
    return True


def merged_up_to(spark: SparkSession, path: str) -> int | None:
    """The ``mark`` of the last merge into the table, if it was given one."""
    return read_note(spark, f"{path}/{MARK}")


@contextmanager
def _dates(actions: DataFrame, guard: str) -> Iterator[DataFrame]:
    """The distinct dates, as a dataset of their own that is read by an equality filter.

    That is the form in which Spark prunes the other side of a join at run time, by the
    dates it finds.
    """
    dates = actions.select(F.col(guard).alias("_date")).distinct().withColumn("_of", F.lit("dates"))
    with staged(dates, "merge-dates", partition_by="_of") as stage:
        yield stage.df.where(F.col("_of") == "dates").select("_date")


def _on_dates(target: DataFrame, dates: DataFrame, guard: str) -> DataFrame:
    """Rows of the target on these dates; rows without a date too, if null is among them."""
    on = target.join(dates, target[guard] == dates["_date"], "left_semi").select(target.columns)
    if dates.where(F.col("_date").isNull()).isEmpty():
        return on
    return on.union(target.where(F.col(guard).isNull()).select(target.columns))


def _classified(target: DataFrame, source: DataFrame, key: str, guard: str) -> DataFrame:
    """Source rows to update or insert, with the action in a column.

    A key found under several dates in the target joins to one pair per date; at most one
    of them has the source row's own date, so no row comes out twice.
    """
    pairs = (
        target.select(F.col(key).alias("_key"), F.col(guard).alias("_guard"))
        .where(F.col("_key").isNotNull())
        .distinct()
    )
    action = F.when(F.col("_key").isNull(), INSERT).when(F.col(guard) == F.col("_guard"), UPDATE)
    return (
        source.join(pairs, source[key] == pairs["_key"], "left")
        .withColumn(ACTION, action)
        .where(F.col(ACTION).isNotNull())
        .drop("_key", "_guard")
    )


def _merge_delta(
    spark: SparkSession, path: str, source: DataFrame, key: str, guard: str
) -> None:
    view = f"merge_source_{uuid.uuid4().hex}"
    source.createOrReplaceTempView(view)
    try:
        with settings_during(spark, {"spark.databricks.delta.schema.autoMerge.enabled": "true"}):
            spark.sql(
                f"""MERGE INTO delta.`{path}` AS old USING {view} AS new
                ON new.{key} = old.{key}
                WHEN MATCHED AND new.{guard} = old.{guard} THEN UPDATE SET *
                WHEN NOT MATCHED THEN INSERT *"""
            )
    finally:
        spark.catalog.dropTempView(view)
