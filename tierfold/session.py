"""Spark session settings the jobs rely on."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

SETTINGS = {
    # Dates are cut from timestamps, so the zone is part of the result.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.caseSensitive": "false",
    # AQE splits hot join keys, and splits hot dates in front of partitioned writes.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # Size of one task's share after a shuffle, hence roughly of one output file.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.parquet.filterPushdown": "true",
}


def build_session(
    app_name: str = "tierfold",
    master: str | None = None,
    settings: dict[str, str] | None = None,
) -> SparkSession:
    """Session with ``SETTINGS``; ``settings`` adds to or overrides them.

    Object-store access is configuration only: pass ``spark.hadoop.fs.s3a.*`` keys in
    ``settings`` (or to spark-submit) and use ``s3a://`` paths anywhere a path is taken.
    """
    builder = SparkSession.builder.appName(app_name)
    if master is not None:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **(settings or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@contextmanager
def settings_during(spark: SparkSession, settings: dict[str, str]) -> Iterator[None]:
    """Change runtime settings for the length of a block; unset ones are unset again.

    Settings belong to the session, so jobs that share one must not run side by side.
    """
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)
