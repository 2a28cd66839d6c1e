"""Removal of passages that occurred earlier, found by automata of recurring phrases."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tierfold.llm.common import (
    bitmap,
    in_batches,
    in_bitmap,
    shuffle_partitions,
    written,
    written_at,
)
from tierfold.staging import delete_tree

PHRASE = 6  # words of a phrase; every window of 20 words holds one that its content selects
BLOCK_BYTES = 8 << 20  # of text that share an automaton
TASK_BLOCKS = 16  # blocks a task works off one after the other at most, on average
_RANDOM = np.random.default_rng(29)
_BASES = [int(x) * 8 + 5 for x in _RANDOM.integers(1, 2**60, 2)]  # odd, of the full period
_FOUND = (
    "uid long, doc_id long, n_words long, n_removed long, kept_sha256 string, packed binary,"
    " own array<int>, places array<int>, w1 array<long>, w2 array<int>"
)
_FOUND_ARROW = pa.schema(
    [
        ("uid", pa.int64()), ("doc_id", pa.int64()), ("n_words", pa.int64()),
        ("n_removed", pa.int64()), ("kept_sha256", pa.string()), ("packed", pa.binary()),
        ("own", pa.list_(pa.int32())), ("places", pa.list_(pa.int32())),
        ("w1", pa.list_(pa.int64())), ("w2", pa.list_(pa.int32())),
    ]
)


class _Numbers(dict):
    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self) + 1
        return n


class Numbering:
    """Words as numbers from 1 and as hashes; each distinct word is hashed once."""

    def __init__(self) -> None:
        self.number: dict[bytes, int] = _Numbers()
        self._hashes = np.zeros(1024, np.uint64)

    def ids(self, words: list[bytes]) -> np.ndarray:
        known, number = len(self.number), self.number
        out = np.fromiter(map(number.__getitem__, words), np.int64, len(words))
        if len(number) > known:
            if len(number) >= len(self._hashes):
                self._hashes = np.concatenate(
                    [self._hashes, np.zeros(max(len(number), len(self._hashes)), np.uint64)]
                )
            fresh = list(number)[known:] if known * 2 < len(number) else _last(number, known)
            digest = xxhash.xxh64_intdigest
            self._hashes[known + 1 : len(number) + 1] = [digest(w) for w in fresh]
        return out

    def hashes(self, ids: np.ndarray) -> np.ndarray:
        return self._hashes[ids]


def _last(number: dict[bytes, int], known: int) -> list[bytes]:
    backwards = reversed(number)
    return [next(backwards) for _ in range(len(number) - known)][::-1]


@lru_cache(maxsize=4)
def _powers(base: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of ``base`` and of its inverse, modulo 2**64."""
    both = []
    for b in (base, pow(base, -1, 2**64)):
        with np.errstate(over="ignore"):
            steps = np.full(size, b, np.uint64)
            steps[0] = 1
            both.append(np.multiply.accumulate(steps))
    return both[0], both[1]


def rolled(hashes: np.ndarray, width: int, base: int) -> np.ndarray:
    """A 64-bit hash of every run of ``width`` words: differences of one running sum.

    The sum of word hashes times falling powers of ``base``, taken from one place to another
    and multiplied back by the power of its start, depends on the words between alone.
    """
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    up, down = _powers(base, 1 << max(10, len(hashes).bit_length()))
    sums = np.zeros(len(hashes) + 1, np.uint64)
    np.cumsum(hashes * down[: len(hashes)], out=sums[1:])
    out = (sums[width:] - sums[:n]) * up[:n]
    out ^= out >> np.uint64(32)
    out *= np.uint64(0x9E3779B97F4A7C15)
    out ^= out >> np.uint64(29)
    return out


def selected(hashes: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of the phrases that are least in some window of ``width`` words.

    The choice depends on the window's content alone, so equal windows select equal phrases.
    """
    phrases = rolled(hashes, PHRASE, _BASES[0])
    span = width - PHRASE + 1
    if len(phrases) < span:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    windows = np.lib.stride_tricks.sliding_window_view(phrases, span)
    places = np.arange(len(windows)) + windows.argmin(axis=1)  # in rising order
    places = places[np.diff(places, prepend=-1) > 0]
    return places, phrases[places]


def covered(starts: np.ndarray, width: int, n: int) -> np.ndarray:
    """Which of ``n`` words lie in the windows of ``width`` words with these starts."""
    steps = np.zeros(n + 1, np.int64)
    np.add.at(steps, starts, 1)
    np.add.at(steps, starts + width, -1)
    return np.cumsum(steps[:-1]) > 0


def _signed(values: np.ndarray) -> np.ndarray:
    return values.view(np.int64)


def _surveyed(batch: pa.RecordBatch, width: int) -> pa.RecordBatch:
    words_of, rows = Numbering(), []
    for text in batch.column("text").to_pylist():
        words = (text or b"").split()
        joined = b" ".join(words)
        content = xxhash.xxh3_128_intdigest(joined)
        _, found = selected(words_of.hashes(words_of.ids(words)), width)
        values, times = np.unique(found, return_counts=True)
        high, low = content >> 64, content & (2**64 - 1)
        phrases = _signed(np.repeat(values, np.minimum(times, 2)))
        whole = hashlib.sha256(joined).hexdigest()
        rows.append((len(text or b""), high - 2**63, low - 2**63, phrases, len(words), whole))
        if len(words_of.number) > 400_000:
            words_of = Numbering()
    sizes, h1, h2, phrases, n_words, whole = zip(*rows, strict=True)
    return pa.RecordBatch.from_pydict(
        {
            "key": batch.column("key"), "key2": batch.column("key2"),
            "doc_id": batch.column("doc_id"), "n_words": pa.array(n_words, pa.int64()),
            "kept_sha256": pa.array(whole, pa.string()), "size": pa.array(sizes, pa.int64()), "h1": pa.array(h1, pa.int64()),
            "h2": pa.array(h2, pa.int64()), "phrases": pa.array(phrases, pa.list_(pa.int64())),
        }
    )


def _unsigned(column: pa.Array) -> np.ndarray:
    return column.to_numpy(zero_copy_only=False).view(np.uint64)


def _recurring_keys(bits: np.ndarray):
    """Keys of the surveyed rows one of whose phrases is in the bitmap of recurring ones."""

    def over(batch: pa.RecordBatch) -> pa.RecordBatch:
        phrases = batch.column("phrases")
        sizes = pc.list_value_length(phrases).fill_null(0).to_numpy(zero_copy_only=False)
        hit = in_bitmap(bits, _unsigned(phrases.flatten()))
        rows = np.repeat(np.arange(len(sizes)), sizes)[hit]
        mask = np.zeros(len(sizes), bool)
        mask[rows] = True
        return batch.select(["key", "key2"]).filter(pa.array(mask))

    return over


def _without(bits: np.ndarray):
    """Surveyed rows whose key is not in the bitmap of those to search."""

    def over(batch: pa.RecordBatch) -> pa.RecordBatch:
        return batch.filter(pa.array(~in_bitmap(bits, _unsigned(batch.column("key")))))

    return over


def _packed(bits: np.ndarray):
    """Rows whose key is in the bitmap, with their words joined by one space and compressed."""

    def over(batch: pa.RecordBatch) -> pa.RecordBatch:
        squeeze = zstandard.ZstdCompressor(level=9)
        batch = batch.filter(pa.array(in_bitmap(bits, _unsigned(batch.column("key")))))
        texts = [b" ".join((x or b"").split()) for x in batch.column("text").to_pylist()]
        packed = pa.array([squeeze.compress(x) for x in texts], pa.binary())
        return batch.set_column(batch.schema.get_field_index("text"), "text", packed)

    return over


def _kept(words: list[bytes], gone: np.ndarray | None) -> tuple[int, str]:
    if gone is not None:
        words = [w for w, x in zip(words, gone.tolist(), strict=True) if not x]
    return len(words), hashlib.sha256(b" ".join(words)).hexdigest()


def spelled(ids: np.ndarray) -> str:
    """Numbered words as three letters each, the first from an alphabet of its own.

    An automaton looks through the letters that may follow one by one, so there are few of them.
    """
    letters = np.stack([(ids >> 14) + 257, ((ids >> 7) & 127) + 1, (ids & 127) + 129], 1)
    return letters.astype("<u4").tobytes().decode("utf-32-le")


class Block:
    """Documents that share an automaton, with the phrases in them that recur anywhere."""

    def __init__(self, width: int) -> None:
        self.width = width
        self.recurring: list[np.ndarray] = []
        self.copies: set[tuple[int, int]] = set()
        self.docs: list[tuple[tuple[int, int], int | None, bytes]] = []

    def rows(self, next_uid: Iterator[int]) -> Iterator[dict]:
        """Documents streamed through the automaton compiled from the block's phrases."""
        expand = zstandard.ZstdDecompressor().decompress
        numbering, width = Numbering(), self.width
        recurring = np.unique(np.concatenate([np.zeros(0, np.int64), *self.recurring]))
        automaton = ahocorasick.Automaton(ahocorasick.STORE_LENGTH)
        held = []
        for key, doc_id, packed in self.docs:
            words = expand(packed).split()
            ids = numbering.ids(words)
            copy = key in self.copies
            letters = spelled(ids)
            held.append((doc_id, packed, words, ids, letters, copy))
            if not copy and len(recurring):
                places, found = selected(numbering.hashes(ids), width)
                at = np.searchsorted(recurring, _signed(found))
                at[at == len(recurring)] = 0
                for place in places[recurring[at] == _signed(found)].tolist():
                    automaton.add_word(letters[3 * place : 3 * (place + PHRASE)])
        if len(automaton):
            automaton.make_automaton()
        found = []
        for doc_id, packed, words, ids, letters, copy in held:
            row = {"uid": next(next_uid), "doc_id": doc_id, "n_words": len(words)}
            windows = len(words) - width + 1
            if copy and windows > 0:
                yield row | {"n_removed": len(words), "kept_sha256": _kept([], None)[1]}
                continue
            near = np.zeros(max(windows, 0), bool)
            if windows > 0 and len(automaton):
                steps = np.zeros(windows + 1, np.int64)
                for letter, _ in automaton.iter(letters):
                    end = letter // 3
                    first, last = max(0, end - width + 1), min(windows - 1, end - PHRASE + 1)
                    if first <= last:
                        steps[first] += 1
                        steps[last + 1] -= 1
                near = np.cumsum(steps[:-1]) > 0
            if not near.any():
                yield row | {"n_removed": 0, "kept_sha256": _kept(words, None)[1]}
                continue
            at = np.flatnonzero(near)
            hashes = numbering.hashes(ids)
            w1, w2 = (_signed(rolled(hashes, width, base)[at]) for base in _BASES)
            order = -(2**63) if doc_id is None else doc_id
            found.append((row | {"packed": packed}, order, at, w1, (w2 >> 32).astype(np.int32)))
        yield from _sifted(found)


def _sifted(found: list[tuple]) -> Iterator[dict]:
    """Rows of a block, each window once for the block: where it starts first.

    A window that is in several documents of the block, or several times in one, goes from all
    places but those of the smallest id there, whatever other blocks hold.
    """
    if not found:
        return
    sizes = [len(at) for _, _, at, _, _ in found]
    orders = np.repeat(np.array([f[1] for f in found], np.int64), sizes)
    owners = np.repeat(np.arange(len(found)), sizes)
    at, w1, w2 = (np.concatenate([f[k] for f in found]) for k in (2, 3, 4))
    rank = np.lexsort((at, owners, orders, w2, w1))
    same = (np.diff(w1[rank]) == 0) & (np.diff(w2[rank]) == 0)
    new = np.concatenate([[True], ~same])  # begins a window
    least = orders[rank][np.maximum.accumulate(np.where(new, np.arange(len(rank)), 0))]
    again = np.concatenate([[False], same & (np.diff(owners[rank]) == 0)])  # in this document
    gone = np.zeros(len(at), bool)
    gone[rank] = again | (orders[rank] > least)
    ends = np.cumsum(sizes)
    for (row, *_), a, e in zip(found, ends - sizes, ends, strict=True):
        part, stays = gone[a:e], ~gone[a:e]
        yield row | {
            "own": at[a:e][part].astype(np.int32), "places": at[a:e][stays].astype(np.int32),
            "w1": w1[a:e][stays], "w2": w2[a:e][stays],
        }


def _streamed(width: int):
    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        uids = iter(range(TaskContext.get().partitionId() << 40, 1 << 62))
        now, block = None, Block(width)

        def done() -> Iterator[pa.RecordBatch]:
            rows = []
            for row in block.rows(uids):
                rows.append(row)
                if len(rows) == 1000:
                    yield pa.RecordBatch.from_pylist(rows, _FOUND_ARROW)
                    rows = []
            if rows:
                yield pa.RecordBatch.from_pylist(rows, _FOUND_ARROW)

        for batch in batches:
            blocks = batch.column("block").to_numpy()
            kinds = batch.column("kind").to_numpy()
            ends = np.flatnonzero((np.diff(blocks) != 0) | (np.diff(kinds) != 0)) + 1
            for a, e in zip([0, *ends], [*ends, len(blocks)], strict=True):
                if blocks[a] != now:
                    yield from done()
                    now, block = blocks[a], Block(width)
                part = batch.slice(a, e - a)
                values = part.column("value").to_numpy()
                if kinds[a] == 0:
                    block.recurring.append(values)
                    continue
                keys = zip(values.tolist(), part.column("value2").to_pylist(), strict=True)
                if kinds[a] == 1:
                    block.copies.update(keys)
                else:
                    ids, texts = part.column("doc_id").to_pylist(), part.column("text").to_pylist()
                    block.docs.extend(zip(keys, ids, texts, strict=True))
        yield from done()

    return over


def _finished(width: int):
    def over(batch: pa.RecordBatch) -> pa.RecordBatch:
        expand = zstandard.ZstdDecompressor().decompress
        removed, sums = [], []
        for packed, own, gone in zip(
            *(batch.column(n).to_pylist() for n in ("packed", "own", "gone")), strict=True
        ):
            words = expand(packed).split()
            starts = np.array([*(own or ()), *(gone or ())], np.int64)
            left, digest = _kept(words, covered(starts, width, len(words)))
            removed.append(len(words) - left)
            sums.append(digest)
        return pa.RecordBatch.from_pydict(
            {
                "doc_id": batch.column("doc_id"), "n_words": batch.column("n_words"),
                "n_removed": pa.array(removed, pa.int64()), "kept_sha256": pa.array(sums),
            }
        )

    return over


def without_repeats(docs: DataFrame, width: int = 20) -> DataFrame:
    """Words left of every row when windows of ``width`` words that start earlier are taken out.

    A window goes if its word sequence starts earlier too: in a document of smaller doc_id, or
    earlier in the same document; windows are judged on the input. Words are runs without white
    space, unchanged.

    1. Every window selects the least, by hash, of its six-word phrases. Selected phrases are
       counted over all documents; those met twice recur. Rows of equal words are copies of the
       one with the smallest id and need no search; nor do rows without a recurring phrase.
       Both are settled where they were read: bitmaps of fixed size tell the tasks which
       phrases recur and which rows are to be searched, and where slots are shared a row too
       many is searched.
    2. Documents go in blocks of 8 MB of text, each with the recurring phrases selected in it.
       A block compiles an Aho-Corasick automaton over word numbers from them and streams its
       documents through it; windows around an occurrence are candidates, hashed to 96 bits.
    3. Of a window that is in several documents of a block only the first can stay. The one row
       left for each block and window goes to the other blocks' rows of that window, and stays
       if its doc_id is the smallest.

    A phrase and a window are at a block once, so a passage that most documents share gathers
    one row for 8 MB of text, and neither it nor a large group of copies makes rows of its
    square.

    Returns doc_id, n_words, n_removed and kept_sha256 (kept words joined by one space). Null
    and empty texts have no words. A null id comes before all others; rows that share an id are
    one document as to the order between documents, so none is earlier than the other. An empty
    table gives no rows; other columns are not looked at.
    """
    spark = docs.sparkSession
    keyed = docs.select(
        F.xxhash64("doc_id", "text").alias("key"),
        F.xxhash64(F.lit(1), "doc_id", "text").alias("key2"),
        "doc_id",
        F.col("text").cast("binary").alias("text"),
    )
    survey, survey_folder = written_at(
        in_batches(
            keyed,
            lambda b: _surveyed(b, width),
            "key long, key2 long, doc_id long, n_words long, kept_sha256 string, size long,"
            " h1 long, h2 long, phrases array<long>",
        ),
        "phrase-survey",
    )
    size = survey.agg(F.sum("size")).first()[0] or 0
    n_blocks = 1 + size // BLOCK_BYTES
    blocks = F.pmod(F.col("key"), F.lit(n_blocks)).cast("int").alias("block")
    key = ["key", "key2"]

    order = F.coalesce("doc_id", F.lit(-(2**63)))
    firsts = survey.groupBy("h1", "h2").agg(F.min(order).alias("first"), F.max(order).alias("last"))
    copies = written(
        survey.select(*key, "doc_id", "h1", "h2")
        .join(firsts.filter("first < last"), ["h1", "h2"])
        .filter(order > F.col("first")).select(*key).distinct(),
        "phrase-copies",
    )
    met = survey.join(copies, key, "left_anti").select(blocks, F.explode("phrases").alias("value"))
    twice = met.groupBy("value").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("value")
    recurring = written(met.join(twice, "value", "left_semi").distinct(), "phrase-recurring")

    hits = in_batches(
        survey.select(*key, "phrases"),
        _recurring_keys(bitmap(recurring, "value")),
        "key long, key2 long",
    )
    searched = bitmap(hits.join(copies, key, "left_anti"), "key")
    plain = in_batches(
        survey.select(*key, "doc_id", "n_words", "kept_sha256"),
        _without(searched),
        "key long, key2 long, doc_id long, n_words long, kept_sha256 string",
    ).join(copies.withColumn("is_copy", F.lit(True)), key, "left")
    gone_whole = F.col("is_copy") & (F.col("n_words") >= width)
    settled = written(
        plain.select(
            "doc_id", "n_words",
            F.when(gone_whole, F.col("n_words")).otherwise(0).alias("n_removed"),
            F.when(gone_whole, _kept([], None)[1]).otherwise(F.col("kept_sha256"))
            .alias("kept_sha256"),
        ),
        "phrase-settled",
    )

    texts = in_batches(
        keyed, _packed(searched), "key long, key2 long, doc_id long, text binary"
    ).select(blocks, F.lit(2).alias("kind"), F.col("key").alias("value"),
             F.col("key2").alias("value2"), "doc_id", "text")
    nothing = [F.lit(None).cast("long").alias("doc_id"), F.lit(None).cast("binary").alias("text")]
    dealt = (
        recurring.select("block", F.lit(0).alias("kind"), "value", F.lit(None).cast("long").alias("value2"), *nothing)
        .union(copies.select(blocks, F.lit(1), *key, *nothing))
        .union(texts)
        .repartition(max(shuffle_partitions(spark), -(-n_blocks // TASK_BLOCKS)), "block")
        .sortWithinPartitions("block", "kind")
    )
    found = written(dealt.mapInArrow(_streamed(width), _FOUND), "phrase-occurrences")
    delete_tree(spark, survey_folder)  # nothing that follows reads it

    windows = found.filter("packed is not null").select(
        "uid", order.alias("doc"), F.explode(F.arrays_zip("places", "w1", "w2")).alias("x")
    ).select("uid", "doc", "x.*")
    first = F.min("doc").over(Window.partitionBy("w1", "w2"))  # at most a row for each block
    gone = (
        windows.withColumn("first", first).filter("doc > first")
        .groupBy("uid").agg(F.collect_list("places").alias("gone"))  # at most the words of a text
    )
    candidates = found.filter("packed is not null").join(gone, "uid", "left").select(
        "doc_id", "n_words", "packed", "own", "gone"
    )
    schema = "doc_id long, n_words long, n_removed long, kept_sha256 string"
    plain = found.filter("packed is null").select("doc_id", "n_words", "n_removed", "kept_sha256")
    return settled.union(plain).union(in_batches(candidates, _finished(width), schema))
