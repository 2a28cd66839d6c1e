"""Writes of tables partitioned by date."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tierfold.operators.columns import PARTITION_COLUMN
from tierfold.session import settings_during

# Joining small shuffle partitions saves no file here, as a date is in one of them anyway;
# it only makes one task open the files of more dates. So keep all cores busy instead.
SPREAD_DATES = {
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "true",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1b",
}


def _write(
    df: DataFrame,
    path: str,
    table_format: str,
    mode: str,
    column: str,
    partitions: int | None,
    options: dict[str, str] | None = None,
) -> int:
    """Write one folder per date and return the number of rows written.

    Rows are rebalanced by date first, otherwise every task would add a file to every
    date. AQE splits a date that holds much of the data over several tasks and files, at
    the advisory partition size. ``partitions`` is the number of hash partitions before
    that (default ``spark.sql.shuffle.partitions``); for the fewest files it should not be
    less than the number of dates, so that the pieces of a split partition hold few dates.
    """
    spark = df.sparkSession
    observed = Observation()
    arguments = [F.col(column)] if partitions is None else [partitions, F.col(column)]
    balanced = df.hint("rebalance", *arguments)
    counted = balanced.observe(observed, F.count(F.lit(1)).alias("rows"))
    writer = counted.write.format(table_format).mode(mode).options(**(options or {}))
    with settings_during(spark, SPREAD_DATES):
        writer.partitionBy(column).save(path)
    return observed.get["rows"]


def append_partitioned(
    df: DataFrame,
    path: str,
    table_format: str = "parquet",
    column: str = PARTITION_COLUMN,
    partitions: int | None = None,
) -> int:
    """Add rows; new columns are accepted (readers merge the schemas of Parquet files)."""
    options = {"mergeSchema": "true"}
    return _write(df, path, table_format, "append", column, partitions, options)


def create_partitioned(
    df: DataFrame,
    path: str,
    table_format: str = "parquet",
    column: str = PARTITION_COLUMN,
    partitions: int | None = None,
) -> int:
    """Write a new table; fails if the path exists."""
    return _write(df, path, table_format, "errorifexists", column, partitions)


def append_json(
    df: DataFrame, path: str, column: str = PARTITION_COLUMN, partitions: int | None = None
) -> int:
    return _write(df, path, "json", "append", column, partitions)


def overwrite_partitions(
    df: DataFrame,
    path: str,
    table_format: str = "parquet",
    column: str = PARTITION_COLUMN,
    partitions: int | None = None,
) -> int:
    """Replace exactly the partitions that occur in ``df``."""
    options = {"partitionOverwriteMode": "dynamic"}
    return _write(df, path, table_format, "overwrite", column, partitions, options)
