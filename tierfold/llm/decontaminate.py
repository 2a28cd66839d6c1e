"""Benchmark passages in documents, by the q-gram lemma on diagonals and banded alignment."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierfold.llm.common import in_batches, keeps_columns, written

QGRAM = 8
EDIT_SHARE = 0.08  # of an item's characters may differ
BLOCK_CHARS = 1 << 20  # of benchmark text searched for in one pass over the documents
MATCHES = (
    "doc_id long, item_id long, start long, end long, edits int, edit_budget int, shared_qgrams int"
)
LEAKS = "__leak long, __leak2 long"
_BLANK = np.zeros(128, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True
_BASE, _MARK = np.uint64(0x100000001B3), np.uint64(0x9E3779B97F4A7C15)


def normalised(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Code points with A-Z in lower case and white space as single spaces; their places."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).copy()
    points[(points >= 65) & (points <= 90)] += 32
    blank = _BLANK[np.minimum(points, 127)]
    points[blank] = 32
    keep = ~blank
    keep[1:] |= ~blank[:-1]
    places = np.flatnonzero(keep)
    return points[places], places


def trimmed(points: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The same without a space at either end."""
    inside = slice(int(len(points) > 0 and points[0] == 32), len(points))
    points, places = points[inside], places[inside]
    if len(points) and points[-1] == 32:
        points, places = points[:-1], places[:-1]
    return points, places


def qgrams(points: np.ndarray, q: int) -> np.ndarray:
    n = len(points) - q + 1
    out = np.zeros(max(n, 0), np.uint64)
    if n > 0:
        marks = (points.astype(np.uint64) + np.uint64(1)) * _MARK
        for j in range(q):
            out *= _BASE
            out += marks[j : j + n]
        out ^= out >> np.uint64(32)
        out *= _MARK
    return out


@dataclass(frozen=True)
class Item:
    item_id: int | None
    points: np.ndarray
    budget: int
    needed: int


class Index:
    """Every q-gram of a block of benchmark items with the items and places it is at."""

    def __init__(self, items: list[tuple[int | None, str]], q: int, share: float) -> None:
        self.q, self.items, grams, owners, places = q, [], [], [], []
        self.short: dict[bytes, list[Item]] = {}
        for item_id, text in items:
            points, _ = trimmed(*normalised(text))
            if len(points) < q:
                if len(points):
                    short = Item(item_id, points, 0, 0)
                    self.short.setdefault(points.tobytes(), []).append(short)
                continue
            budget = min(int(share * len(points)), (len(points) - q) // q)
            found = qgrams(points, q)
            grams.append(found)
            owners.append(np.full(len(found), len(self.items)))
            places.append(np.arange(len(found)))
            needed = len(points) + 1 - q - budget * q
            self.items.append(Item(item_id, points, budget, needed))
        if not self.items:
            return
        every = np.concatenate(grams)
        order = np.argsort(every, kind="stable")
        self.keys, first = np.unique(every[order], return_index=True)
        self.first = np.append(first, len(every))
        self.owners, self.places = np.concatenate(owners)[order], np.concatenate(places)[order]
        self.used = np.zeros(1 << 22, bool)
        self.used[self.keys >> np.uint64(42)] = True
        self.step = np.array([max(8, i.budget) for i in self.items])
        self.lengths = np.array([len(i.points) for i in self.items])
        self.needed = np.array([i.needed for i in self.items])

    def bands(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Item, band and count where the shared q-grams in a band reach the lemma's bound.

        Band b of an item covers the diagonals from b to b + 2 of its steps, so that bands
        overlap by half and any run of as many diagonals as the budget lies in one of them.
        """
        none = np.zeros(0, np.int64)
        if not self.items or len(points) < self.q:
            return none, none, none
        grams = qgrams(points, self.q)
        at = np.flatnonzero(self.used[grams >> np.uint64(42)])
        key = np.searchsorted(self.keys, grams[at])
        key[key == len(self.keys)] = 0
        hit = self.keys[key] == grams[at]
        at, key = at[hit], key[hit]
        times = self.first[key + 1] - self.first[key]
        offset = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
        entry = np.repeat(self.first[key], times) + offset
        owner = self.owners[entry]
        diagonal = np.repeat(at, times) - self.places[entry] + self.lengths[owner]  # 0 or more
        band = diagonal // self.step[owner]
        width = int((len(points) + self.lengths.max()) // 8 + 2)
        cell = owner * width + band + 1
        if width * len(self.items) <= 16 * len(cell) + 1000:
            counts = np.bincount(cell, minlength=width * len(self.items) + 1)
            cells = np.flatnonzero(counts)
            counts = counts[cells]
        else:
            cells, counts = np.unique(cell, return_counts=True)
        both = np.concatenate([cells, cells - 1])
        both, where = np.unique(both, return_inverse=True)
        total = np.bincount(where, np.concatenate([counts, counts]))
        item = both // width
        enough = total >= self.needed[item]
        return item[enough], (both % width)[enough] - 1, total[enough].astype(np.int64)

    def matches(self, points: np.ndarray) -> list[tuple[int, int, int, int, int]]:
        """(item, start, end, edits, shared q-grams) of every passage within its edit budget.

        Passages of one item that overlap count once, the one of fewest edits (then the first).
        """
        found: list[tuple[int, int, int, int, int]] = []
        for item, band, shared in zip(*(x.tolist() for x in self.bands(points)), strict=True):
            step, entry = int(self.step[item]), self.items[item]
            low = band * step - len(entry.points) - entry.budget
            spans = aligned(points, entry.points, low, 2 * step + 2 * entry.budget, entry.budget)
            found += [(item, *span, shared) for span in spans]
        best: list[tuple[int, int, int, int, int]] = []
        for one in sorted(found, key=lambda m: (m[0], m[3], m[1], m[2], -m[4])):
            if not any(m[0] == one[0] and m[1] < one[2] and one[1] < m[2] for m in best):
                best.append(one)
        return best


def aligned(
    text: np.ndarray, pattern: np.ndarray, low: int, width: int, budget: int
) -> list[tuple[int, int, int]]:
    """Passages of ``text`` within ``budget`` edits of ``pattern``, on the diagonals
    ``low`` to ``low + width``, as (start, end, edits); those that do not overlap, best first."""
    if budget == 0:
        starts = np.arange(max(low, 0), min(low + width, len(text) - len(pattern)) + 1)
        same = [s for s in starts.tolist() if (text[s : s + len(pattern)] == pattern).all()]
        return [(s, s + len(pattern), 0) for s in same]
    last = _last_row(text, pattern, low, width, None)
    spans: list[tuple[int, int, int]] = []
    for d in np.argsort(last, kind="stable").tolist():
        edits = int(last[d])
        if edits > budget:
            break
        end = low + d + len(pattern)
        if any(a < end and end - len(pattern) < e for a, e, _ in spans):
            continue
        back = _last_row(text[:end][::-1], pattern[::-1], -budget, 2 * budget, 0)
        shift = int(np.argmin(back))
        start = end - (len(pattern) - budget + shift)
        spans.append((start, end, int(back[shift])))
    return spans


def _last_row(
    text: np.ndarray, pattern: np.ndarray, low: int, width: int, start: int | None
) -> np.ndarray:
    """Edit distances of the whole pattern to text ending on each diagonal of the band.

    ``start`` None lets an alignment begin on any diagonal of the band, else on that one.
    """
    far = len(pattern) + len(text) + 1
    n = width + 1
    lead = max(0, -low)
    tail = max(0, low + n + len(pattern) - len(text))
    padded = np.concatenate(
        [np.full(lead, 2**32 - 1, np.uint32), text[max(low, 0) :], np.full(tail, 2**32 - 1, np.uint32)]
    )
    along = np.arange(n)
    places = low + along
    row = np.where((places >= 0) & (places <= len(text)), 0, far)
    if start is not None:
        row = np.where(places == start, 0, far)
        row = np.where(places >= start, np.minimum.accumulate(row - along) + along, far)
        row = np.where((places >= 0) & (places <= len(text)), row, far)
    for i, letter in enumerate(pattern):
        step = row + (padded[i : i + n] != letter)
        step[:-1] = np.minimum(step[:-1], row[1:] + 1)
        row = np.minimum.accumulate(step - along) + along
        places = places + 1
        row = np.where((places >= 0) & (places <= len(text)), row, far)
    return row


def contaminated_passages(
    docs: DataFrame, benchmark: DataFrame, share: float = EDIT_SHARE, q: int = QGRAM
) -> DataFrame:
    """Passages of ``docs`` (doc_id, text) that are items of ``benchmark`` (item_id, text).

    Texts are compared by code points, A-Z in lower case, white space as single spaces. A
    passage matches an item of m characters within ``budget = share * m`` edits. By the q-gram
    lemma it then shares at least ``m + 1 - q - budget * q`` q-grams with the item, on diagonals
    not further apart than the budget; shared q-grams are counted in overlapping diagonal
    bands, bands that reach the bound are kept and verified by banded alignment. For short
    items the budget is lowered until the bound is at least one. Items of fewer than ``q``
    characters have no q-gram: they match texts that are equal to them as a whole, as a word
    or two inside a text say nothing of a benchmark.

    Different items go in blocks of about a million characters, one pass over the documents for
    each, so what a task holds is bounded however large the benchmark or often an item repeats;
    a block's matches are written before the next block is built, so the driver holds one.
    Repeats are joined to the matches. Documents are not shuffled.

    Returns doc_id, item_id, start, end (code points of the text as given), edits, edit_budget
    and shared_qgrams, one row for each passage and item. Null and empty texts or items match
    nothing; repeated rows and items give rows of their own; empty tables give none. Other
    columns are not looked at.
    """
    items = _items(benchmark)
    rows = docs.select("doc_id", "text")
    found = _matches_of_items(rows, items, share, q, _matches, MATCHES).withColumnRenamed(
        "item_id", "key"
    )
    repeated = items.select("key", "item_id", F.explode(F.expr("sequence(1L, times)")).alias("time"))
    return found.join(repeated, "key").select(*(x.split()[0] for x in MATCHES.split(", ")))


def _items(benchmark: DataFrame) -> DataFrame:
    """key, item_id, text and ``times`` of the different rows of ``benchmark``."""
    rows = benchmark.filter("text is not null").groupBy("item_id", "text")
    counted = rows.agg(F.count(F.lit(1)).alias("times"))
    return written(counted.withColumn("key", F.xxhash64("item_id", "text")), "benchmark-items")


def _matches_of_items(
    rows: DataFrame,
    items: DataFrame,
    share: float,
    q: int,
    function: Callable[[pa.RecordBatch, Index], pa.RecordBatch],
    schema: str,
) -> DataFrame:
    """``function`` over all ``rows`` with the index of each block of ``items`` in turn."""
    size = items.agg(F.sum(F.length("text"))).first()[0] or 0
    count = 1 + size // BLOCK_CHARS
    parts = []
    for k in range(count):
        # at most about BLOCK_CHARS characters, and one long item
        block = items.filter(F.pmod("key", F.lit(count)) == k)
        index = Index([tuple(r) for r in block.select("key", "text").collect()], q, share)
        part = in_batches(rows, lambda b, index=index: function(b, index), schema)
        parts.append(written(part, "benchmark-matches"))
    return reduce(DataFrame.union, parts)


def _matches(batch: pa.RecordBatch, index: Index) -> pa.RecordBatch:
    """``MATCHES`` of a batch (doc_id, text), the item's key as ``item_id``."""
    rows = []
    ids = batch.column("doc_id").to_pylist()
    for doc_id, text in zip(ids, batch.column("text").to_pylist(), strict=True):
        if not text:
            continue
        points, places = normalised(text)
        found = [(index.items[item], *match) for item, *match in index.matches(points)]
        if len(points) < index.q + 2:
            points, places = trimmed(points, places)
            same = index.short.get(points.tobytes(), [])
            found += [(entry, 0, len(points), 0, 0) for entry in same]
        for entry, start, end, edits, shared in found:
            rows.append(
                (
                    doc_id, entry.item_id, int(places[start]), int(places[end - 1]) + 1, edits,
                    entry.budget, shared,
                )
            )
    kinds = [pa.int64()] * 4 + [pa.int32()] * 3
    names = [x.split()[0] for x in MATCHES.split(", ")]
    columns = list(zip(*rows, strict=True)) or [[]] * len(names)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names
    )


def _leaks(batch: pa.RecordBatch, index: Index) -> pa.RecordBatch:
    """``LEAKS`` of the texts of a batch (both hashes, text) in which an item was found."""
    alone = pa.RecordBatch.from_arrays(
        [pa.array(range(batch.num_rows), pa.int64()), batch.column("text")], ["doc_id", "text"]
    )
    hit = pa.array(sorted(set(_matches(alone, index).column("doc_id").to_pylist())), pa.int64())
    return batch.select(["__leak", "__leak2"]).take(hit)


@keeps_columns
def without_contaminated(
    docs: DataFrame, benchmark: DataFrame, share: float = EDIT_SHARE, q: int = QGRAM
) -> DataFrame:
    """Rows of ``docs`` in which no benchmark item was found; columns stay as they are.

    Decided by text, told by two 64-bit hashes, so rows that repeat an id are judged one by
    one and copies alike. Null and empty texts stay; with an empty benchmark all rows do.
    """
    hashes = {"__leak": F.xxhash64("text"), "__leak2": F.xxhash64(F.lit(1), "text")}
    rows = docs.select(*(h.alias(n) for n, h in hashes.items()), "text")
    leaks = _matches_of_items(rows, _items(benchmark), share, q, _leaks, LEAKS).distinct()
    keyed = docs.withColumns(hashes)
    return keyed.join(leaks, list(hashes), "left_anti").select(*docs.columns)
