"""Marginal document probability over all subword segmentations."""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierfold.llm.common import in_batches, shuffle_partitions, written
from tierfold.llm.lattice import DEFAULT_VOCABULARY, Vocabulary, load_vocabulary, log_likelihoods

CHUNK_BYTES = 32 << 20  # of text counted together; bounds the dictionary of a task
TASK_CHUNKS = 4  # chunks a task scores one after the other, on average
_ROW_WORDS = 20_000
_COUNTED = pa.schema(
    [
        ("chunk", pa.int64()), ("doc_id", pa.int64()), ("held_out", pa.bool_()),
        ("n_tokens", pa.int64()), ("ids", pa.list_(pa.int32())), ("counts", pa.list_(pa.int32())),
        ("first", pa.int32()), ("words", pa.list_(pa.binary())), ("trained", pa.list_(pa.int64())),
    ]
)
_COUNTED_SQL = (
    "chunk long, doc_id long, held_out boolean, n_tokens long, ids array<int>, counts array<int>,"
    " first int, words array<binary>, trained array<long>"
)


def held_out(doc_id: int | None) -> bool:
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % 10 == 0


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents as counts of numbered words, and the numbered words of each chunk of text."""
    chunk = TaskContext.get().partitionId() << 24
    number: dict[bytes, int] = {}
    trained: list[int] = []
    size = 0

    def dictionary() -> Iterator[pa.RecordBatch]:
        words = list(number)
        for k in range(0, len(words), _ROW_WORDS):
            row = {
                "chunk": chunk, "first": k,
                "words": words[k : k + _ROW_WORDS], "trained": trained[k : k + _ROW_WORDS],
            }
            yield pa.RecordBatch.from_pylist([row], _COUNTED)

    for batch in batches:
        ids = batch.column("doc_id").to_pylist()
        for start in range(0, len(ids), 500):
            rows = []
            texts = batch.column("text").slice(start, 500).to_pylist()
            for doc_id, text in zip(ids[start : start + 500], texts, strict=True):
                words = (text or b"").lower().split()
                out = held_out(doc_id)
                tally: dict[int, int] = {}
                for w in words:
                    k = number.setdefault(w, len(number))
                    tally[k] = tally.get(k, 0) + 1
                trained.extend([0] * (len(number) - len(trained)))
                if not out:
                    for k, n in tally.items():
                        trained[k] += n
                size += len(text or b"")
                rows.append(
                    {
                        "chunk": chunk, "doc_id": doc_id, "held_out": out,
                        "n_tokens": len(words) + 1,
                        "ids": np.fromiter(tally, np.int32, len(tally)),
                        "counts": np.fromiter(tally.values(), np.int32, len(tally)),
                    }
                )
                if size >= CHUNK_BYTES:
                    yield pa.RecordBatch.from_pylist(rows, _COUNTED)
                    yield from dictionary()
                    rows, number, trained, size, chunk = [], {}, [], 0, chunk + 1
            if rows:
                yield pa.RecordBatch.from_pylist(rows, _COUNTED)
    yield from dictionary()


def trained_model(
    words: DataFrame, ends: int, vocabulary: Vocabulary, rounds: int = 3
) -> tuple[np.ndarray, float]:
    """Natural-log probabilities of the slots and of the end, by expectation maximisation.

    ``words`` (word, c) are all words with their counts in training. Every round starts from the
    present probabilities (the vocabulary's own at first), weights all segmentations of every
    word, and sums the expected uses of each piece; only those sums, one number for each slot
    of the vocabulary, come to the driver. A hundredth is added to each.
    """
    logp = np.array(vocabulary.scores)
    end = math.log(1 / (len(logp) + 1))
    for _ in range(rounds):

        def expect(batches: Iterator[pa.RecordBatch], logp=logp) -> Iterator[pa.RecordBatch]:
            expected = np.zeros(len(logp))
            for batch in batches:
                weights = batch.column("c").to_numpy().astype(float)
                texts = batch.column("word").to_pylist()
                log_likelihoods(texts, logp, vocabulary, weights, expected)
            used = np.flatnonzero(expected)
            yield pa.RecordBatch.from_pydict({"slot": used, "uses": expected[used]})

        known = words.filter("c > 0")
        sums = known.mapInArrow(expect, "slot long, uses double")
        rows = sums.groupBy("slot").agg(F.sum("uses").alias("uses")).collect()
        uses = np.full(len(logp), 0.01)
        for slot, n in rows:
            uses[slot] += n
        total = uses.sum() + ends + 0.01
        logp, end = np.log(uses / total), math.log((ends + 0.01) / total)
    return logp, end


def lattice_scores(
    docs: DataFrame, vocabulary_path: str = DEFAULT_VOCABULARY, rounds: int = 3
) -> DataFrame:
    """Log10 probability of every text, summed over all segmentations into pieces.

    Words are runs without white space, A-Z in lower case; a text is its words, each with the
    mark in front, and one end. No piece holds a mark behind its first place, so all
    segmentations of a text pass its word starts and the marginal is a product over words. The
    vocabulary's scores weight the segmentations first; piece probabilities are then fitted to
    the training texts (crc32 of doc_id as text, modulo 10, not 0). Unknown characters go by
    single-byte pieces, so every text has a probability.

    Documents are counted where they are read, against a dictionary for each chunk of 32 MB of
    text; dictionaries meet by word, so a frequent word has one row a chunk, and come back by
    chunk. Texts are not shuffled.

    Returns doc_id, held_out, n_tokens (words and the end), n_known, train_tokens, base_score
    and score. Null and empty texts are the end alone; a null id counts as the empty text for
    the split; repeated rows are rows; without training texts base_score and fitted scores are
    those of the smoothing alone. Other columns are not looked at.
    """
    vocabulary = load_vocabulary(vocabulary_path)
    rows = docs.select("doc_id", F.col("text").cast("binary").alias("text"))
    counted = written(rows.mapInArrow(_counted, _COUNTED_SQL), "lm-counts")
    per_doc = counted.filter("n_tokens is not null").select(
        "chunk", "doc_id", "held_out", "n_tokens", "ids", "counts"
    )
    entries = counted.filter("words is not null").select(
        "chunk", "first", F.posexplode(F.arrays_zip("words", "trained")).alias("k", "x")
    ).select(
        "chunk", (F.col("first") + F.col("k")).alias("id"), F.col("x.words").alias("word"),
        F.col("x.trained").alias("trained"),
    )
    # in the order of their length, as words of one length are worked off as vectors
    counts = entries.groupBy("word").agg(F.sum("trained").alias("c"))
    words = written(counts.sortWithinPartitions(F.octet_length("word")), "lm-words")
    total, distinct = words.agg(F.sum("c"), F.sum(F.expr("int(c > 0)"))).first()
    ends, chunks = per_doc.agg(F.count_if(~F.col("held_out")), F.count_distinct("chunk")).first()
    n, v = (total or 0) + ends, (distinct or 0) + (ends > 0)
    logp, end = trained_model(words, ends, vocabulary, rounds)

    def scored(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = log_likelihoods(batch.column("word").to_pylist(), logp, vocabulary)
        return batch.append_column("score", pa.array(found / math.log(10)))

    of_word = in_batches(words, scored, "word binary, c long, score double")
    below = math.log10(n + 0.1 * (v + 1))
    back = entries.join(of_word, "word").select(F.col("chunk").alias("of_chunk"), "id", "c", "score")

    def gathered(docs: pa.Table, known: pa.Table) -> pa.Table:
        ids = known.column("id").to_numpy()
        c, score = np.zeros(len(ids)), np.zeros(len(ids))
        c[ids] = known.column("c").to_numpy()
        score[ids] = known.column("score").to_numpy()
        base = np.log10(c + 0.1) - below
        columns = {k: [] for k in ("n_known", "base_score", "score")}
        for found, counts in zip(docs.column("ids"), docs.column("counts"), strict=True):
            k = found.values.to_numpy() if len(found) else np.zeros(0, np.int64)
            times = counts.values.to_numpy() if len(counts) else np.zeros(0, np.int64)
            columns["n_known"].append(int(times[c[k] > 0].sum()) + (ends > 0))
            columns["base_score"].append(
                math.fsum(times * base[k]) + math.log10(ends + 0.1) - below
            )
            columns["score"].append(math.fsum(times * score[k]) + end / math.log(10))
        return pa.table(
            {
                "doc_id": docs.column("doc_id"),
                "held_out": docs.column("held_out"),
                "n_tokens": docs.column("n_tokens"),
                "n_known": pa.array(columns["n_known"], pa.int64()),
                "train_tokens": pa.array([n] * docs.num_rows, pa.int64()),
                "base_score": pa.array(columns["base_score"], pa.float64()),
                "score": pa.array(columns["score"], pa.float64()),
            }
        )

    parts = max(shuffle_partitions(docs.sparkSession), -(-chunks // TASK_CHUNKS))
    return (
        per_doc.repartition(parts, "chunk").groupBy("chunk")
        .cogroup(back.repartition(parts, "of_chunk").groupBy("of_chunk"))
        .applyInArrow(
            gathered,
            "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long,"
            " base_score double, score double",
        )
    )
