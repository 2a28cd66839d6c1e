"""Helpers the operators share: tables, intermediate results, hashing inside tasks."""

from __future__ import annotations

import string
from collections.abc import Callable, Iterator
from functools import wraps

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tierfold.staging import shared_folder

#: Words are runs without these characters; bytes.split() uses exactly this set.
SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, label: str, **options: str) -> DataFrame:
    """``df`` evaluated once into the shared checkpoint folder and read from there.

    Cuts the lineage at files every executor can read, so that a lost executor repeats
    nothing above them and values that depend on task numbers stay as they are. ``options``
    are those of the Parquet writer.
    """
    return written_at(df, label, **options)[0]


def written_at(df: DataFrame, label: str, **options: str) -> tuple[DataFrame, str]:
    """Same, with the folder, for what is deleted once nothing reads it any more."""
    path = shared_folder(df.sparkSession, label)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def bitmap(hashes: DataFrame, column: str, log2_bits: int = 26) -> np.ndarray:
    """The slots of all values of a column of 64-bit hashes, as ``2 ** log2_bits`` bits.

    Its size is fixed, whatever it holds: values that share a slot make it less selective, but
    none is ever missing. So it may go to every task where it only saves work.
    """
    slot = (F.col(column).bitwiseAND(F.lit((1 << log2_bits) - 1)) + 1).alias("slot")
    parts = (
        hashes.select(slot)
        .groupBy(F.bitmap_bucket_number("slot").alias("bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("slot")).alias("bits"))
    )
    bits = np.zeros((1 << log2_bits) // 8, np.uint8)
    for bucket, found in parts.collect():  # 4 KB for each of at most 2 ** (log2_bits - 15)
        bits[(bucket - 1) * len(found) : bucket * len(found)] = np.frombuffer(found, np.uint8)
    return bits


def in_bitmap(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Whether the slot of each unsigned hash is set."""
    slot = hashes & np.uint64(8 * len(bits) - 1)
    return (bits[slot >> np.uint64(3)] >> (slot & np.uint64(7)).astype(np.uint8)) & 1 == 1


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def ascii_lower(column: Column) -> Column:
    """Lower case of A-Z alone."""
    return F.translate(column, string.ascii_uppercase, string.ascii_lowercase)


def keeps_columns(operator: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """For operators that return the columns of their first argument: any names are allowed.

    Names the operators use themselves begin with two underscores; the table's own columns of
    such names go by others meanwhile.
    """

    @wraps(operator)
    def with_names(docs: DataFrame, *args, **kwargs) -> DataFrame:
        names = docs.columns
        safe = [f"column {i}" if n.startswith("__") else n for i, n in enumerate(names)]
        return operator(docs.toDF(*safe), *args, **kwargs).toDF(*names)

    return with_names


def in_batches(
    df: DataFrame,
    function: Callable[[pa.RecordBatch], pa.RecordBatch],
    schema: str | StructType,
) -> DataFrame:
    """``function`` over Arrow batches; state never crosses a batch."""

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield function(batch)

    return df.mapInArrow(over, schema)
