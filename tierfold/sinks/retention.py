"""Files no longer referenced by a table."""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from itertools import islice

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierfold.session import settings_during
from tierfold.staging import delete_tree, qualified

DELETING = 8  # deletions at a time


def _files(spark: SparkSession, root: str) -> DataFrame:
    """One row for each file below ``root``; contents are not among the columns read."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .load(root)
        .select("path", "modificationTime", "length")
    )


def _below(spark: SparkSession, path: str) -> str:
    return qualified(spark, path).rstrip("/") + "/"


def stale_files(
    spark: SparkSession, root: str, live: str | Sequence[str], older_than_hours: float = 1.0
) -> DataFrame:
    """Files under ``root`` that are below none of the live folders ``live``.

    Folders are compared, not rows, so a live file without rows is live. Columns path,
    modificationTime and length. Only files at least ``older_than_hours`` old are listed. A
    report; see ``delete_stale``.
    """
    age_limit = F.current_timestamp() - F.make_dt_interval(
        secs=F.lit(older_than_hours * 3600).cast("decimal(18,6)")
    )
    listing = _files(spark, root).where(F.col("modificationTime") <= age_limit)
    for folder in [live] if isinstance(live, str) else live:
        listing = listing.where(~F.col("path").startswith(_below(spark, folder)))
    return listing


def stale_trees(report: DataFrame, root: str, live: Sequence[str] = ()) -> DataFrame:
    """The ``path`` of whole folders and single files that hold just what ``report`` lists.

    A folder counts whole if every file below it is in the report and no live folder is below
    it; of such folders only the highest is given, and no file in one. Files and their folders
    are counted on Spark, so what is left to delete is a few folders and not each file.
    """
    spark = report.sparkSession
    base = _below(spark, root)
    listed = report.select("path", F.lit(True).alias("is_stale"))
    files = _files(spark, root).select("path").join(listed, "path", "left")
    inner = F.split(F.substring("path", len(base) + 1, 1 << 30), "/")
    depth = F.explode(F.sequence(F.lit(1), F.size("parts")))
    ancestors = (
        files.select("is_stale", inner.alias("parts"))
        .select("is_stale", "parts", depth.alias("depth"))
        .select("is_stale", "depth", F.array_join(F.slice("parts", 1, F.col("depth")), "/").alias("at"))
    )
    whole = (
        ancestors.groupBy("at", "depth")
        .agg(F.count(F.lit(1)).alias("n"), F.count("is_stale").alias("n_stale"))
        .where("n = n_stale")
        .select("at", "depth")
    )
    for folder in live:
        inside = F.lit(_below(spark, folder))
        whole = whole.where(~inside.startswith(F.concat(F.lit(base), "at", F.lit("/"))))
    above = whole.select(F.col("at").alias("parent"))
    parent = F.regexp_replace("at", "/?[^/]*$", "")
    return (
        whole.withColumn("parent", parent)
        .join(above, "parent", "left_anti")
        .select(F.concat(F.lit(base), "at").alias("path"))
    )


def delete_stale(report: DataFrame, root: str, live: Sequence[str] = ()) -> int:
    """Delete the files of a ``stale_files`` report; returns how many files that were.

    Folders that hold nothing else go by one call each (see ``stale_trees``), as rows stream in
    and several at a time. Anything outside ``root`` is refused before anything is deleted.
    """
    spark = report.sparkSession
    outside = report.where(~F.col("path").startswith(_below(spark, root))).first()
    if outside is not None:
        raise ValueError(f"{outside['path']} is not under {root}")
    files = report.count()
    with ThreadPoolExecutor(DELETING) as pool:
        rows = stale_trees(report, root, live).toLocalIterator()
        while some := list(islice(rows, 64 * DELETING)):
            list(pool.map(lambda row: delete_tree(spark, row["path"]), some))
    return files


def vacuum_delta(spark: SparkSession, path: str, hours: float) -> None:
    """Delta's own clean-up, with its safety check off as short retentions need it."""
    check = {"spark.databricks.delta.retentionDurationCheck.enabled": "false"}
    with settings_during(spark, check):
        spark.sql(f"VACUUM delta.`{path}` RETAIN {hours} HOURS")
