"""SimHash near-duplicates by exact comparison of tiles of fingerprints."""

from __future__ import annotations

from itertools import product

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierfold.llm.common import in_batches, keeps_columns, written
from tierfold.llm.components import connected_components

SEED = 42
BITS = 64


def fingerprint(text: bytes, shingle: int = 3) -> int:
    """SimHash of the word shingles of a text, A-Z in lower case; 0 for a text without words."""
    return majority(shingle_hashes(text, shingle))


def shingle_hashes(text: bytes, shingle: int) -> np.ndarray:
    """Hashes of the word shingles in order; a text of fewer words is one shingle."""
    words = text.lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    runs = [words[i:] for i in range(shingle)] if len(words) >= shingle else [[b" ".join(words)]]
    digest = xxhash.xxh64_intdigest
    return np.fromiter(
        (digest(x, SEED) for x in map(b" ".join, zip(*runs, strict=False))), np.uint64
    )


def majority(hashes: np.ndarray) -> int:
    """The bits that more than half of the hashes have, as a signed long."""
    bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    most = 2 * bits.sum(axis=0, dtype=np.int64) > len(hashes)
    return int(np.packbits(most, bitorder="little").view(np.int64)[0])


def with_fingerprints(docs: DataFrame, text: str = "text", shingle: int = 3) -> DataFrame:
    """doc_id and ``fp`` (the 64 bits as a signed long) of every row; a null text has no words."""

    def over(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [fingerprint(x or b"", shingle) for x in batch.column("text").to_pylist()]
        return pa.RecordBatch.from_pydict(
            {"doc_id": batch.column("doc_id"), "fp": pa.array(found, pa.int64())}
        )

    rows = docs.select("doc_id", F.col(text).cast("binary").alias("text"))
    return in_batches(rows, over, "doc_id long, fp long")


def _tile(fp: Column, segments: int) -> Column:
    """Population counts of the segments, as digits of one number."""
    width = BITS // segments
    mask = (1 << width) - 1
    return sum(
        F.bit_count(F.shiftrightunsigned(fp, width * i).bitwiseAND(F.lit(mask))).cast("long")
        * (width + 1) ** i
        for i in range(segments)
    )


def neighbour_steps(segments: int, radius: int) -> list[tuple[int, ...]]:
    """Steps between tiles whose population counts differ by at most ``radius`` in sum.

    Of a step and its opposite only one is given, so that every pair of tiles meets once.
    """
    steps = product(range(-radius, radius + 1), repeat=segments)
    near = (s for s in steps if sum(map(abs, s)) <= radius)
    return [s for s in near if next((x for x in s if x), 1) > 0]


def forest(left: np.ndarray, right: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that join what is within ``radius`` bits across two tiles, no more than nodes.

    Every fingerprint with a partner is linked to the first of its group in these two tiles.
    """
    close = np.bitwise_count(left[:, None] ^ right[None, :]) <= radius
    i, j = np.nonzero(close)
    nodes = np.concatenate([left, right])
    j = j + len(left)
    label = np.arange(len(nodes))
    while True:
        least = np.minimum(label[i], label[j])
        after = label.copy()
        np.minimum.at(after, i, least)
        np.minimum.at(after, j, least)
        after = after[after]
        if (after == label).all():
            break
        label = after
    moved = np.flatnonzero(nodes != nodes[label])
    return nodes[moved], nodes[label[moved]]


def _compared(batch: pa.RecordBatch, radius: int) -> pa.RecordBatch:
    sides = []
    for name in ("left", "right"):
        column = batch.column(name)
        values = column.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
        ends = np.cumsum([len(x) for x in column])
        sides.append(np.split(values, ends[:-1]))
    found = [forest(a, b, radius) for a, b in zip(*sides, strict=True)]
    a = np.concatenate([x for x, _ in found]).view(np.int64)
    b = np.concatenate([x for _, x in found]).view(np.int64)
    return pa.RecordBatch.from_pydict({"a": pa.array(a), "b": pa.array(b)})


def fingerprint_links(
    fingerprints: DataFrame, radius: int = 2, segments: int = 4, block: int = 1024
) -> DataFrame:
    """Links (a, b) that connect exactly the distinct ``fp`` within ``radius`` bits.

    Fingerprints fall into tiles by the population counts of ``segments`` equal parts. Each
    differing bit changes one of the counts by one, so tiles whose counts differ by more than
    ``radius`` in sum hold no pair and are never met; the other tile pairs are compared in full
    with exclusive-or and bit counts. Tiles are cut into blocks of about ``block``, and a pair
    of blocks is a unit of work, so a crowded tile is spread over many tasks. More segments
    mean fewer comparisons and more copies of each tile (21 at 4, 73 at 8); results are the
    same. For several hundred million distinct fingerprints take 8, beyond 16.
    """
    width = BITS // segments
    scale = [(width + 1) ** i for i in range(segments)]
    tiles = fingerprints.select("fp").distinct().withColumn("tile", _tile(F.col("fp"), segments))
    tiles = written(tiles, "simhash-tiles")
    sizes = tiles.groupBy("tile").agg(F.ceil(F.count(F.lit(1)) / block).alias("blocks"))
    cut = (
        tiles.join(sizes, "tile")
        .withColumn("block", F.pmod(F.xxhash64("fp"), F.col("blocks")))
        .groupBy("tile", "block")
        .agg(F.collect_list("fp").alias("fps"))
    )
    cut = written(cut, "simhash-blocks")
    steps = neighbour_steps(segments, radius)
    counts = [
        F.pmod(F.floor(F.col("tile") / scale[i]), F.lit(width + 1)) for i in range(segments)
    ]
    targets = [
        F.when(
            # a count outside its range would carry into the next digit
            F.expr("true")
            if not any(s)
            else _all_in_range(counts, s, width),
            F.col("tile") + sum(x * k for x, k in zip(s, scale, strict=True)),
        )
        for s in steps
    ]
    left = cut.select(
        F.col("tile").alias("home"), F.col("block").alias("left_block"), F.col("fps").alias("left"),
        F.explode(F.array_compact(F.array(*targets))).alias("tile"),
    )
    pairs = (
        left.join(cut.withColumnRenamed("fps", "right"), "tile")
        .filter("home <> tile or left_block <= block")
        .select("left", "right")
    )
    links = in_batches(pairs, lambda b: _compared(b, radius), "a long, b long")
    return links.distinct()


def _all_in_range(counts: list[Column], step: tuple[int, ...], width: int) -> Column:
    inside = F.lit(True)
    for count, x in zip(counts, step, strict=True):
        if x:
            inside = inside & ((count + x).between(0, width))
    return inside


def near_duplicates(
    docs: DataFrame, radius: int = 2, shingle: int = 3, segments: int = 4
) -> DataFrame:
    """doc_id, ``fp`` and component_id (smallest doc_id reachable over links) of every row.

    Two rows are linked if their fingerprints differ in at most ``radius`` bits; texts without
    words, empty and null ones among them, have fingerprint 0 and are linked like any other.
    Equal fingerprints are one node, so a group of copies costs one comparison whatever its
    size. Rows of a null doc_id take part; the component_id is the smallest id that is not
    null, or null if there is none. Repeated ids and rows stay rows; an empty table gives none.
    """
    marked = written(with_fingerprints(docs, shingle=shingle), "simhash-fingerprints")
    classes = _classes(marked, F.col("doc_id"), radius, segments)
    return marked.join(classes, "fp").select("doc_id", "fp", F.col("first").alias("component_id"))


def _classes(marked: DataFrame, of_row: Column, radius: int, segments: int) -> DataFrame:
    """``fp`` and ``first`` (smallest ``of_row`` in its component) of every fingerprint."""
    nodes = written(marked.groupBy("fp").agg(F.min(of_row).alias("first")), "simhash-nodes")
    roots = connected_components(fingerprint_links(nodes, radius, segments))
    rooted = nodes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn(
        "component", F.coalesce("component", "fp")
    )
    least = rooted.groupBy("component").agg(F.min("first").alias("first"))
    return written(
        rooted.select("fp", "component").join(least, "component").select("fp", "first"),
        "simhash-classes",
    )


@keeps_columns
def deduplicated(
    docs: DataFrame, radius: int = 2, shingle: int = 3, segments: int = 4
) -> DataFrame:
    """One row of every component of ``near_duplicates``: that of the smallest doc_id.

    Among rows of that id one is taken by two hashes of the whole row; of rows equal in every
    column one stays. Null and empty texts are alike, so one row of them all stays; an empty
    table gives none. Columns and their order stay.
    """
    whole = [*docs.columns, *(F.isnull(c) for c in docs.columns)]  # hashes pass over nulls
    keyed = docs.withColumns(
        {"__key": F.xxhash64(*whole), "__key2": F.xxhash64(F.lit(1), *whole)}
    )

    def over(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [fingerprint(x or b"", shingle) for x in batch.column("text").to_pylist()]
        return pa.RecordBatch.from_pydict(
            {
                "doc_id": batch.column("doc_id"), "key": batch.column("key"),
                "key2": batch.column("key2"), "fp": pa.array(found, pa.int64()),
            }
        )

    rows = keyed.select(
        "doc_id", F.col("__key").alias("key"), F.col("__key2").alias("key2"),
        F.col("text").cast("binary").alias("text"),
    )
    marked = written(
        in_batches(rows, over, "doc_id long, key long, key2 long, fp long"), "simhash-rows"
    )
    classes = _classes(marked, F.struct("doc_id", "key", "key2"), radius, segments)
    both = ["__key", "__key2"]
    kept = classes.select(F.col("first.key").alias(both[0]), F.col("first.key2").alias(both[1]))
    return keyed.join(kept.distinct(), both).dropDuplicates(both).select(*docs.columns)


def fingerprint_hex(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
