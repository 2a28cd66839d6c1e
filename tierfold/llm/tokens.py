"""Token counts by byte-pair merging of ragged arrays, one rank of every sequence at a time."""

from __future__ import annotations

import heapq
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property
from itertools import chain, islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DEFAULT_TOKENIZER = "/opt/tokenizers/byte_bpe_50k.json"
SLICE_CHARS = 1 << 20  # of text whose pre-tokens are merged together
KNOWN_WORDS = 300_000  # pre-tokens a task remembers the counts of before it starts afresh
LONG = 4_096  # bytes from which a pre-token is merged by itself
_LONG_TEXT = 1 << 22  # characters from which pre-tokens of a text are taken in parts
_PART = 200_000
_NONE = np.int32(2**31 - 1)
_COUNTED = "doc_id long, n_bytes long, n_tokens long, over_limit boolean"

# Code points that are letters or numbers only in Unicode versions past that of
# the library whose counts are to be met (first and last of each range).
_LATER = (
    "558-558 58b-58c 88f-88f c5c-c5c cdc-cdc 208f-208f 209d-209f a7ce-a7cf a7d2-a7d2 a7d4-a7d4"
    " a7dd-a7dd a7e2-a7e2 a7f1-a7f1 ab6c-ab6d 107bb-107bf 10940-10959 10ec5-10ec7 10ed9-10eee"
    " 11b0a-11b0a 11db0-11ddb 11de0-11de9 11df1-11df1 1246f-1246f 12475-1247f 12550-12686"
    " 16ea0-16eb8 16ebb-16ed3 16ff2-16ff6 187f8-187ff 18cd6-18cda 18d09-18d20 18d80-18df2"
    " 18e00-19191 191a0-191d2 1b123-1b128 1b168-1b168 1d6a6-1d6a6 1df1f-1df24 1df2b-1df81"
    " 1df90-1df96 1dfcd-1dfff 1e6c0-1e6de 1e6e0-1e6e2 1e6e4-1e6e5 1e6e7-1e6ed 1e6f0-1e6f4"
    " 1e6fe-1e6ff 2b73a-2b73f 2b81e-2b81e 2cea2-2cead 323b0-33479 3d000-3fc3f"
)


def _pre_tokens(letters: str, numbers: str, marks: str, space: str, engine=regex):
    """Runs of letters, of numbers and of other marks, each with a space before it, and spaces."""
    runs = rf" ?{letters}+|'(?:[sdmt]|ll|ve|re)| ?{numbers}+| ?{marks}+"
    return engine.compile(rf"{runs}|{space}+(?!(?!{space})[\s\S])|{space}+")


def _every_pre_token() -> regex.Pattern:
    ends = [pair.split("-") for pair in _LATER.split()]
    later = "".join(f"{chr(int(a, 16))}-{chr(int(b, 16))}" for a, b in ends)
    marks = rf"(?:[^\s\p{{L}}\p{{N}}]|[{later}])"
    return _pre_tokens(rf"(?V1:[\p{{L}}--[{later}]])", rf"(?V1:[\p{{N}}--[{later}]])", marks, r"\s")


#: For any text, for one without the later code points, and for one of ASCII alone.
PRE_TOKEN = _every_pre_token()
_EARLIER = _pre_tokens(r"\p{L}", r"\p{N}", r"[^\s\p{L}\p{N}]", r"\s")
_ASCII = _pre_tokens("[A-Za-z]", "[0-9]", r"[^ \t-\rA-Za-z0-9]", r"[ \t-\r]", re)
_BEYOND = re.compile(f"[^\0-{chr(int(_LATER[:3], 16) - 1)}]")


def _pattern(text: str):
    if text.isascii():
        return _ASCII
    return PRE_TOKEN if _BEYOND.search(text) else _EARLIER


@dataclass(frozen=True)
class Merges:
    """Symbols of single bytes, the merges by rank, and the strings that are one token each."""

    of_byte: np.ndarray
    left: np.ndarray
    right: np.ndarray
    made: np.ndarray
    special: tuple[str, ...]

    @cached_property
    def _table(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Sorted pairs, their ranks, and a table of hashed pairs in use."""
        pairs = self._pairs(self.left, self.right)
        order = np.argsort(pairs)
        used = np.zeros(1 << 20, bool)
        used[_slot(pairs)] = True
        return pairs[order], order.astype(np.int32), used

    def _pairs(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        return (left.astype(np.uint64) << np.uint64(32)) | right.astype(np.uint64)

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair, the largest number for pairs that do not merge."""
        pairs, order, used = self._table
        wanted = self._pairs(left, right)
        out = np.full(len(wanted), _NONE)
        maybe = np.flatnonzero(used[_slot(wanted)])
        at = np.searchsorted(pairs, wanted[maybe])
        at[at == len(pairs)] = 0
        hit = pairs[at] == wanted[maybe]
        out[maybe[hit]] = order[at[hit]]
        return out

    @cached_property
    def rank_of(self) -> dict[tuple[int, int], int]:
        pairs = zip(self.left.tolist(), self.right.tolist(), strict=True)
        return {pair: rank for rank, pair in enumerate(pairs)}


def _slot(pairs: np.ndarray) -> np.ndarray:
    return (pairs * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(44)


def load_merges(path: str = DEFAULT_TOKENIZER) -> Merges:
    """A byte-level BPE file; refuses files whose texts would have to be treated otherwise."""
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    model, before = spec["model"], spec["pre_tokenizer"] or {}
    plain = (
        model["type"] == "BPE"
        and not any(
            model.get(k)
            for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix",
                      "fuse_unk", "byte_fallback", "ignore_merges")
        )
        and spec["normalizer"] is None
        and before.get("type") == "ByteLevel"
        and before.get("use_regex")
        and not before.get("add_prefix_space")
    )
    if not plain:
        raise ValueError(f"{path} is not a plain byte-level BPE tokenizer")
    added = spec["added_tokens"]
    if any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"] for t in added):
        raise ValueError(f"{path} has added tokens that take more than their own text")
    ids = model["vocab"]
    # Bytes that print stand for themselves, the others for the code points from 256 on.
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letter = {b: chr(b) for b in shown}
    hidden = (b for b in range(256) if b not in letter)
    letter |= {b: chr(256 + k) for k, b in enumerate(hidden)}
    merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    return Merges(
        np.array([ids[letter[b]] for b in range(256)], np.int32),
        np.array([ids[a] for a, _ in merges], np.int32),
        np.array([ids[b] for _, b in merges], np.int32),
        np.array([ids[a + b] for a, b in merges], np.int32),
        tuple(t["content"] for t in added),
    )


def surviving(words: list[bytes], merges: Merges) -> np.ndarray:
    """How many symbols of each word are left when no pair of them merges any more.

    All words are one ragged array: symbols in a row, and the length of each word. In a round
    every word finds the lowest rank among its pairs and merges all pairs of that rank, from
    the left where they overlap; only pairs beside a merged symbol are looked up again. Words
    without a pair to merge leave the array with their count.
    """
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    counts = lengths.copy()
    for k in np.flatnonzero(lengths >= LONG).tolist():
        counts[k] = _one_by_one(words[k], merges)
    rows = np.flatnonzero((lengths > 1) & (lengths < LONG))
    if not len(rows):
        return counts
    size = lengths[rows]
    joined = np.frombuffer(b"".join([words[k] for k in rows.tolist()]), np.uint8)
    symbols = merges.of_byte[joined]
    rank = np.full(len(symbols), _NONE)
    rank[:-1] = merges.ranks(symbols[:-1], symbols[1:])
    start = np.cumsum(size) - size
    rank[start + size - 1] = _NONE  # the last symbol of a word has no pair
    while True:
        least = np.minimum.reduceat(rank, start)
        alive = least < _NONE
        if not alive.all():
            counts[rows[~alive]] = size[~alive]
            stays = np.repeat(alive, size)
            symbols, rank, rows = symbols[stays], rank[stays], rows[alive]
            size, least = size[alive], least[alive]
            if not len(rows):
                return counts
            start = np.cumsum(size) - size
        at = np.flatnonzero(rank == np.repeat(least, size))
        turn = np.arange(len(at))
        begins = np.diff(at, prepend=-2) != 1  # a run of pairs that overlap
        at = at[(turn - np.maximum.accumulate(np.where(begins, turn, 0))) % 2 == 0]
        symbols[at] = merges.made[rank[at]]
        stays = np.ones(len(symbols), bool)
        stays[at + 1] = False
        moved = (np.cumsum(stays) - 1)[at]
        size = size - np.add.reduceat((~stays).astype(np.int64), start)
        symbols, rank = symbols[stays], rank[stays]
        start = np.cumsum(size) - size
        beside = np.concatenate([moved, moved[moved > 0] - 1])
        rank[beside] = merges.ranks(symbols[beside], symbols[np.minimum(beside + 1, len(symbols) - 1)])
        rank[start + size - 1] = _NONE


def _one_by_one(word: bytes, merges: Merges) -> int:
    """``surviving`` of one long word: pairs in a queue by rank and place, symbols linked."""
    rank_of, made = merges.rank_of, merges.made.tolist()
    symbols = merges.of_byte[np.frombuffer(word, np.uint8)].tolist()
    after, before = list(range(1, len(symbols) + 1)), list(range(-1, len(symbols) - 1))
    end, left = len(symbols), len(symbols)
    queue = []

    def offer(at: int) -> None:
        if at >= 0 and after[at] < end:
            rank = rank_of.get((symbols[at], symbols[after[at]]))
            if rank is not None:
                heapq.heappush(queue, (rank, at))

    for at in range(end - 1):
        offer(at)
    while queue:
        rank, at = heapq.heappop(queue)
        # an entry is out of date if its place now holds another pair or none
        if symbols[at] is None or after[at] >= end:
            continue
        if rank_of.get((symbols[at], symbols[after[at]])) != rank:
            continue
        gone = after[at]
        symbols[at], symbols[gone], after[at] = made[rank], None, after[gone]
        if after[at] < end:
            before[after[at]] = at
        left -= 1
        offer(at)
        offer(before[at])
    return left


class Counter:
    """Token counts of texts; remembers the counts of pre-tokens it has met."""

    def __init__(self, merges: Merges) -> None:
        self.merges = merges
        self.special = (
            re.compile("|".join(map(re.escape, sorted(merges.special, key=len, reverse=True))))
            if merges.special
            else None
        )
        self.known: dict[str, int] = {}

    def _learn(self, words: Iterator[str]) -> None:
        known = self.known
        fresh = [w for w in set(words) if w not in known]
        counts = surviving([w.encode() for w in fresh], self.merges).tolist()
        known.update(zip(fresh, counts, strict=True))

    def _pieces(self, text: str) -> tuple[list[str], int]:
        """The text between special strings, and how many of those there are."""
        if self.special is None:
            return [text], 0
        pieces = self.special.split(text)
        return pieces, len(pieces) - 1

    def counts(self, texts: list[str]) -> list[int]:
        """Tokens of each text of a slice; very long ones should come alone."""
        if len(self.known) > KNOWN_WORDS:
            self.known = {}
        found, words = [], []
        for text in texts:
            pieces, special = self._pieces(text)
            if len(text) > _LONG_TEXT:
                found.append(special + sum(map(self._long, pieces)))
                words.append([])
            else:
                found.append(special)
                words.append([w for piece in pieces for w in _pattern(piece).findall(piece)])
        self._learn(chain.from_iterable(words))
        count = self.known.__getitem__
        return [n + sum(map(count, own)) for n, own in zip(found, words, strict=True)]

    def _long(self, text: str) -> int:
        matches, total = _pattern(text).finditer(text), 0
        while words := [m[0] for m in islice(matches, _PART)]:
            if len(self.known) > KNOWN_WORDS:
                self.known = {}
            self._learn(words)
            total += sum(map(self.known.__getitem__, words))
        return total


def _slices(texts: list[str]) -> Iterator[tuple[int, int]]:
    """First and end of runs of texts of about ``SLICE_CHARS`` together."""
    first, held = 0, 0
    for k, text in enumerate(texts):
        held += len(text)
        if held >= SLICE_CHARS:
            yield first, k + 1
            first, held = k + 1, 0
    if first < len(texts):
        yield first, len(texts)


def token_counts(
    docs: DataFrame, tokenizer_path: str = DEFAULT_TOKENIZER, limit: int = 1024
) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit (more than ``limit``) of every row of ``docs``.

    Counts are those of the tokenizer file's own library, without added begin or end; special
    strings inside a text are one token each, as that library takes them by default. A text
    falls into pre-tokens; those a task has not met are merged together as arrays (see
    ``surviving``), and a text's count is the sum over its pre-tokens. Whole texts are counted
    where they are read: nothing is shuffled, and what a task holds is bounded by slices of
    text and a bounded memory of pre-tokens (plus the pre-tokens of one text, or the bytes of
    one very long pre-token).

    Null and empty texts have no bytes and no tokens. Null ids and repeated rows are rows like
    any other; an empty table gives none; other columns are not looked at.
    """
    merges = load_merges(tokenizer_path)

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(merges)
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            counts = [n for a, e in _slices(texts) for n in counter.counts(texts[a:e])]
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": batch.column("doc_id"),
                    "n_bytes": batch.column("n_bytes"),
                    "n_tokens": pa.array(counts, pa.int64()),
                    "over_limit": pa.array([n > limit for n in counts], pa.bool_()),
                }
            )

    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), size, "text")
    return rows.mapInArrow(over, _COUNTED)
