"""Intermediate results written to the cluster's shared checkpoint folder."""

from __future__ import annotations

import json
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

CHECKPOINT_KEY = "spark.checkpoint.dir"
_local_fallback: dict[str, str] = {}


def shared_folder(spark: SparkSession, label: str) -> str:
    """A new, unused path below the folder named by ``spark.checkpoint.dir``.

    Only a local-mode session without that setting falls back to a temporary folder: on a
    cluster other executors could not see it.
    """
    base = spark.conf.get(CHECKPOINT_KEY, None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"set {CHECKPOINT_KEY} to a folder all executors share")
        if "path" not in _local_fallback:
            _local_fallback["path"] = tempfile.mkdtemp(prefix="tierfold-")
        base = _local_fallback["path"]
    return f"{base.rstrip('/')}/tierfold/{label}-{uuid.uuid4().hex}"


@dataclass(frozen=True)
class Staged:
    df: DataFrame
    path: str
    counts: dict[str, int]

    @property
    def rows(self) -> int:
        return self.counts["rows"]


@contextmanager
def staged(
    df: DataFrame,
    label: str,
    partition_by: str | None = None,
    counts: dict[str, Column] | None = None,
) -> Iterator[Staged]:
    """Evaluate ``df`` once into a shared Parquet folder and read it back from there.

    The lineage ends at the files, so a lost executor never causes the work above to be
    redone. The row count, and any further aggregates in ``counts``, are observed during
    the write. The folder is deleted on leaving the block; it was created by this call.
    """
    spark = df.sparkSession
    path = shared_folder(spark, label)
    observed = Observation()
    measures = {"rows": F.count(F.lit(1)), **(counts or {})}
    writer = df.observe(observed, *(c.alias(n) for n, c in measures.items())).write
    if partition_by is not None:
        writer = writer.partitionBy(partition_by)
    try:
        writer.parquet(path)
        totals = {name: value or 0 for name, value in observed.get.items()}
        reader = spark.read.schema(df.schema)
        yield Staged(reader.parquet(path), path, totals)
    finally:
        delete_tree(spark, path)


def _hadoop_path(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    conf = spark._jsparkSession.sessionState().newHadoopConf()
    return hadoop_path, hadoop_path.getFileSystem(conf)


def qualified(spark: SparkSession, path: str) -> str:
    """The path with scheme and authority, as its file system spells it."""
    hadoop_path, file_system = _hadoop_path(spark, path)
    return file_system.makeQualified(hadoop_path).toString()


def path_exists(spark: SparkSession, path: str) -> bool:
    hadoop_path, file_system = _hadoop_path(spark, path)
    return file_system.exists(hadoop_path)


def move_tree(spark: SparkSession, source: str, target: str) -> None:
    """Rename a file or folder to a path that is free, on one file system."""
    old, file_system = _hadoop_path(spark, source)
    new, _ = _hadoop_path(spark, target)
    if not file_system.rename(old, new):
        raise OSError(f"{source} could not be renamed to {target}")


def replace_tree(spark: SparkSession, new: str, old: str) -> None:
    """Put a folder in the place of another one of the same file system.

    The other one is kept under ``backup_of`` its path until the new one is in place, and is
    put back if that fails.
    """
    backup = backup_of(old)
    recover_tree(spark, old)
    if path_exists(spark, old):
        move_tree(spark, old, backup)
    try:
        move_tree(spark, new, old)
    except Exception:
        recover_tree(spark, old)
        raise
    delete_tree(spark, backup)


def backup_of(path: str) -> str:
    """Where ``replace_tree`` keeps a folder meanwhile; the name is one that readers skip."""
    parent, _, name = path.rstrip("/").rpartition("/")
    return f"{parent}/_old.{name}"


def recover_tree(spark: SparkSession, path: str) -> bool:
    """Bring back what an interrupted ``replace_tree`` had moved away; whether it had.

    If the new folder is in place already, the backup is what is left over.
    """
    backup = backup_of(path)
    if not path_exists(spark, backup):
        return False
    if path_exists(spark, path):
        delete_tree(spark, backup)
        return False
    move_tree(spark, backup, path)
    return True


def children(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, in order; none if it is absent."""
    hadoop_path, file_system = _hadoop_path(spark, path)
    if not file_system.exists(hadoop_path):
        return []
    return sorted(status.getPath().getName() for status in file_system.listStatus(hadoop_path))


def write_note(spark: SparkSession, path: str, note: object) -> None:
    """A small JSON file, complete or not there: written beside its place and renamed."""
    new, file_system = _hadoop_path(spark, f"{path}.{uuid.uuid4().hex}")
    out = file_system.create(new, True)
    try:
        out.write(bytearray(json.dumps(note).encode()))
    finally:
        out.close()
    target, _ = _hadoop_path(spark, path)
    file_system.delete(target, False)
    if not file_system.rename(new, target):
        raise OSError(f"{path} could not be written")


def read_note(spark: SparkSession, path: str) -> object | None:
    """What ``write_note`` wrote, or None if there is no such file."""
    hadoop_path, file_system = _hadoop_path(spark, path)
    if not file_system.exists(hadoop_path):
        return None
    stream = file_system.open(hadoop_path)
    try:
        return json.loads(bytes(stream.readAllBytes()).decode())
    finally:
        stream.close()


def delete_tree(spark: SparkSession, path: str) -> None:
    """Remove a file or folder on whatever file system the path names; absent is fine."""
    hadoop_path, file_system = _hadoop_path(spark, path)
    file_system.delete(hadoop_path, True)
