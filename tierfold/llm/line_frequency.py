"""Quality rules with cross-document line frequency per host."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierfold.llm.common import in_batches, keeps_columns, written

SYMBOLS = b"#*$%&|<>"
BLANKS = b" \t\n\v\f\r"
WINDOW = 8
STATS = (
    "__k1 long, __k2 int, doc_id long, host string, n_words long, word_chars long, n_symbols long,"
    " n_dup_lines long, n_repeat_words long, content long,"
    " lines array<struct<h: long, words: int>>"
)
_MIX = np.random.default_rng(11).integers(1, 2**63, WINDOW, dtype=np.uint64) * np.uint64(2) + 1
_GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def repeat_words(words: list[bytes]) -> int:
    """Words inside windows of eight words that occur at least twice in the text."""
    n = len(words) - WINDOW + 1
    if n < 2:
        return 0
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.uint64, len(words))
    if len(number) == len(words):
        return 0
    mixed = (ids + np.uint64(1)) * _GOLDEN
    mixed ^= mixed >> np.uint64(29)
    mixed *= mixed | np.uint64(1)
    hashes = np.zeros(n, np.uint64)
    for j in range(WINDOW):
        hashes += mixed[j : j + n] * _MIX[j]
        hashes ^= hashes >> np.uint64(31)
    order = np.argsort(hashes, kind="stable")
    same = hashes[order[1:]] == hashes[order[:-1]]
    if not same.any():
        return 0
    twice = np.zeros(n, bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    steps = np.zeros(len(words) + 1, np.int64)
    at = np.flatnonzero(twice)
    np.add.at(steps, at, 1)
    np.add.at(steps, at + WINDOW, -1)
    return int((np.cumsum(steps[:-1]) > 0).sum())


def line_hash(line: bytes) -> int:
    """Signed XXH64 of the line in lower case (A-Z) with single spaces."""
    h = xxhash.xxh64_intdigest(b" ".join(line.lower().split()))
    return h - (1 << 64) if h >> 63 else h


def text_stats(text: bytes) -> tuple:
    words = text.split()
    chars = len(text.translate(None, BLANKS).decode("utf-8", "replace"))
    symbols = len(text) - len(text.translate(None, SYMBOLS))
    seen: set[bytes] = set()
    lines, repeated = [], 0
    for line in text.split(b"\n"):
        n = len(line.split())
        if n:
            repeated += line in seen
            seen.add(line)
            lines.append({"h": line_hash(line), "words": n})
    content = xxhash.xxh64_intdigest(text) - (1 << 63)
    return len(words), chars, symbols, repeated, repeat_words(words), content, lines


def _row_keys(docs: DataFrame) -> tuple[Column, Column]:
    parts = [F.col("doc_id"), F.col("source"), F.col("text")]
    return F.xxhash64(*parts).alias("__k1"), F.hash(*parts).alias("__k2")


def _stats(batch: pa.RecordBatch) -> pa.RecordBatch:
    found = [text_stats(x or b"") for x in batch.column("text").to_pylist()]
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "content")
    columns = {name: batch.column(name) for name in ("__k1", "__k2", "doc_id", "host")}
    for k, name in enumerate(names):
        columns[name] = pa.array([f[k] for f in found], pa.int64())
    kind = pa.list_(pa.struct([("h", pa.int64()), ("words", pa.int32())]))
    columns["lines"] = pa.array([f[6] for f in found], kind)
    return pa.RecordBatch.from_pydict(columns)


def line_verdicts(
    docs: DataFrame,
    min_docs: int = 10,
    host_share: float = 0.01,
    min_left: float = 0.2,
    min_words: int = 20,
) -> DataFrame:
    """Base counts and verdict of every row of ``docs`` (doc_id, source, text).

    Lines are compared in lower case (A-Z) with single spaces, by a 64-bit hash. A line is
    above the limit of a host (``source``) if more than ``min_docs`` and more than
    ``host_share`` of the host's documents contain it; documents of equal text count once, so
    that copies do not make each other's lines frequent. Documents keep at least ``min_left``
    of their words after those lines are removed, or are depleted and rejected; so is
    ``base_failed``: under ``min_words`` words, or over 30 % of the words in repeated windows
    of eight words.

    Returns two row keys, doc_id, the counts, ``removed`` (hashes of removed lines),
    ``words_left``, base_failed and kept. Null texts count as empty, a null host is the host of
    the empty name, ids may be null or repeated: every row gets its own verdict. An empty table
    gives no rows; other columns are not looked at.
    """
    k1, k2 = _row_keys(docs)
    host = F.coalesce(F.col("source").cast("string"), F.lit("")).alias("host")
    rows = docs.select(k1, k2, "doc_id", host, F.col("text").cast("binary").alias("text"))
    stats = written(in_batches(rows, _stats, STATS), "line-stats")

    limits = (
        stats.select("host", "content").distinct().groupBy("host")
        .agg(F.greatest(F.lit(min_docs), F.count(F.lit(1)) * host_share).alias("limit"))
    )
    each = stats.select(
        "host", "content", F.explode(F.array_distinct("lines.h")).alias("h"), "__k1", "__k2"
    )
    counted = (
        each.select("host", "h", "content").distinct()
        .groupBy("host", "h").agg(F.count(F.lit(1)).alias("n"))
        .filter(F.col("n") > min_docs)
    )
    above = written(
        counted.join(limits, "host").filter(F.col("n") > F.col("limit")).select("host", "h"),
        "line-frequent",
    )
    removed = (
        each.join(above, ["host", "h"])
        .groupBy("__k1", "__k2")
        .agg(F.collect_set("h").alias("removed"))  # at most the lines of one text
    )
    left = F.expr(
        "aggregate(filter(lines, x -> removed is null or not array_contains(removed, x.h)),"
        " 0L, (s, x) -> s + x.words)"
    )
    base_failed = (F.col("n_words") < min_words) | (
        100 * F.col("n_repeat_words") > 30 * F.col("n_words")
    )
    return (
        stats.join(removed, ["__k1", "__k2"], "left")
        .withColumn("words_left", left)
        .withColumn("base_failed", base_failed)
        .withColumn(
            "kept", ~base_failed & (F.col("words_left") >= min_left * F.col("n_words"))
        )
        .drop("lines", "content")
    )


def _pack(batch: pa.RecordBatch) -> pa.RecordBatch:
    squeeze = zstandard.ZstdCompressor(level=1).compress
    packed = [None if x is None else squeeze(x) for x in batch.column("text").to_pylist()]
    at = batch.schema.get_field_index("text")
    return batch.set_column(at, "text", pa.array(packed, pa.binary()))


def _apply(batch: pa.RecordBatch) -> pa.RecordBatch:
    expand = zstandard.ZstdDecompressor().decompress
    texts = []
    gone = batch.column("__removed").to_pylist()
    for packed, hashes in zip(batch.column("text").to_pylist(), gone, strict=True):
        text = None if packed is None else expand(packed)
        if hashes:
            drop = set(hashes)
            lines = text.split(b"\n")
            text = b"\n".join(x for x in lines if not x.split() or line_hash(x) not in drop)
        texts.append(None if text is None else text.decode("utf-8", "replace"))
    at = batch.schema.get_field_index("text")
    out = batch.set_column(at, "text", pa.array(texts, pa.string()))
    return out.select([n for n in out.schema.names if n != "__removed"])


@keeps_columns
def apply_line_rules(docs: DataFrame, **limits) -> DataFrame:
    """Rows of ``docs`` that pass, their lines above the limits taken out of the text.

    Columns and their order stay; the keyword arguments are those of ``line_verdicts``. Texts
    are compressed on their way through the join with their verdicts.
    """
    verdicts = line_verdicts(docs, **limits)
    k1, k2 = _row_keys(docs)
    plain = docs.select("*", k1, k2).withColumn("text", F.col("text").cast("binary"))
    packed = in_batches(plain, _pack, plain.schema)
    passed = verdicts.filter("kept").select(
        "__k1", "__k2", F.col("removed").alias("__removed")
    ).dropDuplicates(["__k1", "__k2"])
    joined = packed.join(passed, ["__k1", "__k2"])
    return in_batches(joined.select(*docs.columns, "__removed"), _apply, docs.schema)
