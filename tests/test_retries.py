"""Tasks that fail after part of their work and are run again."""

from __future__ import annotations

import subprocess
import sys
from pathlib import Path

SCRIPT = """
import sys
from datetime import date
sys.path.insert(0, {root!r})
from pyspark import TaskContext
from pyspark.sql import functions as F
from tierfold.operators.merge import merge_into
from tierfold.session import build_session
from tierfold.sinks import append_partitioned
from tierfold.sources import scan_layer
from tierfold.staging import staged

spark = build_session("retries", "local[4,3]", {{
    "spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "4"}})
spark.sparkContext.setLogLevel("OFF")

def once_failing(batches):
    task = TaskContext.get()
    for batch in batches:
        yield batch
    if task.attemptNumber() == 0 and task.partitionId() % 2 == 0:
        raise RuntimeError("lost")

def rows(last):
    base = spark.range(0, last, numPartitions=4).select(
        F.col("id").alias("mongoId"),
        F.date_add(F.lit(date(2020, 1, 1)), (F.col("id") % 5).cast("int")).alias("partitionDate"))
    return base.mapInPandas(once_failing, base.schema)

path = {folder!r} + "/t"
print("appended", append_partitioned(rows(4000), path))
print("stored", scan_layer(spark, path).count())
source = rows(6000).withColumn("v", F.lit("new"))
print(merge_into(spark, path, source))
table = scan_layer(spark, path)
print("merged", table.count(), table.select("mongoId").distinct().count(),
      table.where("v = 'new'").count())
with staged(rows(1000), "retry") as stage:
    print("staged", stage.rows, stage.df.count())
spark.stop()
"""


def test_rows_and_counts_survive_failed_tasks(tmp_path):
    root = str(Path(__file__).resolve().parent.parent)
    script = SCRIPT.format(root=root, folder=str(tmp_path))
    done = subprocess.run(
        [sys.executable, "-c", script], capture_output=True, text=True, timeout=300, check=False
    )
    assert done.returncode == 0, done.stderr[-3000:]
    assert done.stdout.split("\n")[:5] == [
        "appended 4000",
        "stored 4000",
        "MergeStats(source_rows=6000, updated=4000, inserted=2000)",
        "merged 6000 6000 6000",
        "staged 1000 1000",
    ]
