"""Contiguous shards of nearly equal size in bytes, from prefix sums. [native]"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tierfold.llm.common import shuffle_partitions, written

ROW_BYTES = 16  # counted for every row beside its text


def with_prefix_sums(
    rows: DataFrame, order: list[str], weight: str
) -> tuple[DataFrame, int]:
    """``global_row`` (from 0) and ``weight_before`` in the order of ``order``; the whole weight.

    ``rows`` should be narrow: it is written, dealt into ranges of the order, and each range
    is summed by itself. Only the totals per range, one row for each shuffle partition, are
    summed in one place. Equal rows follow the order of the written rows, so rows that share
    a key are dealt over several ranges too.
    """
    parts = shuffle_partitions(rows.sparkSession)
    numbered = written(rows.withColumn("__row", F.monotonically_increasing_id()), "prefix-rows")
    ranges = written(
        numbered.repartitionByRange(parts, *order, "__row").withColumn(
            "__range", F.spark_partition_id()
        ),
        "prefix-ranges",
    )
    total = ranges.agg(F.sum(weight)).first()[0] or 0
    before = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    totals = (
        ranges.groupBy("__range")
        .agg(F.count(F.lit(1)).alias("__n"), F.sum(weight).alias("__w"))
        .select(
            "__range",
            F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__n_before"),
            F.coalesce(F.sum("__w").over(before), F.lit(0)).alias("__w_before"),
        )
    )
    within = Window.partitionBy("__range").orderBy(*order, "__row")
    upto = within.rowsBetween(Window.unboundedPreceding, 0)
    placed = (
        ranges.join(totals, "__range")
        .withColumn("global_row", F.col("__n_before") + F.row_number().over(within) - 1)
        .withColumn(
            "weight_before",
            F.col("__w_before") + F.sum(weight).over(upto) - F.col(weight),
        )
        .drop("__row", "__range", "__n_before", "__w_before")
    )
    return placed, total


def text_size(text: Column) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + ROW_BYTES


def byte_shards(
    docs: DataFrame, shards: int = 40, order: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Put documents, in the order of ``order``, into ``shards`` contiguous byte-balanced shards.

    A row belongs to the shard into which the middle of its bytes falls when the whole is cut
    at equal targets, so a shard is off its target by at most half a row at either end. Returns
    ``order``, ``size``, ``text_crc32`` (unsigned, of the UTF-8 text), ``shard`` and ``slot``
    (place in the shard, from 0).

    Nulls: a null text counts as empty (size 16, CRC 0); null ids come first. Repeated ids and
    repeated rows are rows of their own, side by side. An empty table gives no rows; with
    fewer rows than shards some shards are empty. Other columns are not looked at.
    """
    narrow = docs.select(
        F.col(order),
        text_size(F.col(text)).alias("size"),
        F.crc32(F.coalesce(F.col(text), F.lit("")).cast("binary")).alias("text_crc32"),
    )
    placed, total = with_prefix_sums(narrow, [order], "size")
    middle = F.expr(f"(2 * weight_before + size) * {shards} div {2 * max(total, 1)}")
    shard = F.least(F.lit(shards - 1), middle).cast("int")
    cut = written(placed.withColumn("shard", shard), "byte-shards")
    starts = cut.groupBy("shard").agg(F.min("global_row").alias("__first"))
    return cut.join(starts, "shard").select(
        order, "size", "text_crc32", "shard", (F.col("global_row") - F.col("__first")).alias("slot")
    )
