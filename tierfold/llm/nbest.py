"""SentencePiece encoding with the N best segmentations, and decoding."""

from __future__ import annotations

import heapq
import math
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierfold.llm.common import in_batches
from tierfold.llm.lattice import (
    DEFAULT_VOCABULARY,
    HASH_BASE,
    Vocabulary,
    hash_marks,
    load_vocabulary,
)

FEW = 16  # units of one length below which vectors do not pay
KNOWN_UNITS = 200_000  # segmented words a task remembers before it starts afresh
ENCODED = (
    "doc_id long, n_pieces long, score double, piece_ids array<int>,"
    " nbest array<struct<score: double, n_pieces: long,"
    " changes: array<struct<at: int, was: int, ids: array<int>>>>>, round_trip boolean"
)
_NBEST = pa.list_(
    pa.struct(
        [
            ("score", pa.float64()), ("n_pieces", pa.int64()),
            (
                "changes",
                pa.list_(
                    pa.struct([("at", pa.int32()), ("was", pa.int32()), ("ids", pa.list_(pa.int32()))])
                ),
            ),
        ]
    )
)
#: A run of spaces with the word after it, or a line end: no piece reaches across.
_UNIT = re.compile(rb" +[^ \n]*|[^ \n]+|\n")
_LETTER = re.compile(rb"[\x00-\x7f]|[\xc0-\xff][\x80-\xbf]*")


def units_of(text: bytes) -> list[bytes]:
    return _UNIT.findall(b" " + text) if text else []


class Segmenter:
    """Best and next segmentations of units under one vocabulary; a task holds one."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        for piece in vocabulary.pieces:
            if b" " in piece.lstrip(b" ") or b"\n" in piece:
                raise ValueError(f"piece {piece!r} reaches across units")
        self.vocabulary = vocabulary
        self.scores = list(vocabulary.scores)
        self.first_byte = len(vocabulary.pieces)
        self.known: dict[bytes, tuple[bytes, float, float]] = {}
        self.lists: dict[bytes, list[tuple[float, tuple[int, ...]]]] = {}

    def edges(self, unit: bytes) -> list[tuple[int, int, int]]:
        """(start, end, slot) in order of start; bytes only in characters without a piece."""
        slots, longest, n = self.vocabulary.slots, self.vocabulary.longest, len(unit)
        out = []
        for letter in _LETTER.finditer(unit):
            s, after = letter.span()
            if letter[0] not in slots:
                out += [(k, k + 1, self.first_byte + unit[k]) for k in range(s, after)]
            for e in range(s + 1, min(n, s + longest) + 1):
                slot = slots.get(unit[s:e])
                if slot is not None:
                    out.append((s, e, slot))
        out.sort()
        return out

    def viterbi(self, unit: bytes, edges: list[tuple[int, int, int]]) -> tuple[list, list]:
        """Best score of every prefix and the edge it ends with."""
        scores = self.scores
        alpha = [0.0] + [-math.inf] * len(unit)
        last: list = [None] * (len(unit) + 1)
        for edge in edges:
            s, e, slot = edge
            new = alpha[s] + scores[slot]
            if new > alpha[e]:
                alpha[e], last[e] = new, edge
        return alpha, last

    def _entry(self, unit: bytes, slots: bytes, score: float, loss: float):
        if self._joined(np.frombuffer(slots, np.int32).tolist()) != unit:
            raise AssertionError(f"the pieces of {unit!r} do not give it back")
        return slots, score, loss

    def _joined(self, slots: list[int]) -> bytes:
        pieces, first = self.vocabulary.pieces, self.first_byte
        return b"".join([pieces[k] if k < first else bytes((k - first,)) for k in slots])

    def best(self, unit: bytes) -> tuple[bytes, float, float]:
        """Slots (as int32) and score of the best segmentation, and the second's loss on it."""
        got = self.known.get(unit)
        if got is None:
            edges, scores, n = self.edges(unit), self.scores, len(unit)
            alpha, last = self.viterbi(unit, edges)
            path, at = [], n
            while at:
                path.append(last[at])
                at = last[at][0]
            beta = [-math.inf] * n + [0.0]
            for s, e, slot in reversed(edges):
                new = scores[slot] + beta[e]
                if new > beta[s]:
                    beta[s] = new
            on = set(path)
            other = max(
                (alpha[s] + scores[k] + beta[e] for s, e, k in edges if (s, e, k) not in on),
                default=-math.inf,
            )
            slots = np.array([k for _, _, k in reversed(path)], np.int32).tobytes()
            got = self._entry(unit, slots, alpha[n], max(0.0, alpha[n] - other))
            self.known[unit] = got
        return got

    def learn(self, units: set[bytes]) -> None:
        """``best`` for many units at once, those of one length as vectors.

        Beyond ``KNOWN_UNITS`` all that these units do not need is forgotten.
        """
        fresh = [u for u in units if u not in self.known]
        if len(self.known) + len(fresh) > KNOWN_UNITS:
            self.known = {u: self.known[u] for u in units if u in self.known}
            self.lists.clear()
        by_length: dict[int, list[bytes]] = {}
        for unit in fresh:
            by_length.setdefault(len(unit), []).append(unit)
        for length, group in by_length.items():
            if len(group) < FEW:
                for unit in group:
                    self.best(unit)
                continue
            for k in range(0, len(group), 20_000):
                part = group[k : k + 20_000]
                letters = np.frombuffer(b"".join(part), np.uint8).reshape(len(part), length)
                self.known.update(zip(part, self._best_of(letters), strict=True))

    def _check(self, letters: np.ndarray, slots: np.ndarray) -> None:
        """The pieces of ``slots``, row after row, must spell the bytes of ``letters``."""
        spelling, starts, sizes = self.vocabulary.spelling
        long = sizes[slots]
        ends = np.cumsum(long)
        if len(slots) == 0 or ends[-1] != letters.size:
            raise AssertionError("pieces of other lengths than their units")
        at = np.arange(letters.size) + np.repeat(starts[slots] - (ends - long), long)
        if (spelling[at] != letters.ravel()).any():
            raise AssertionError("pieces that do not give their units back")

    def _best_of(self, letters: np.ndarray) -> Iterator[tuple[bytes, float, float]]:
        """``best`` of a matrix of units of one length, a row each."""
        n, length = letters.shape
        scores, longest = np.array(self.scores), self.vocabulary.longest
        marks = hash_marks(letters)
        alpha = np.full((length + 1, n), -np.inf)
        alpha[0] = 0
        from_start = np.zeros((length + 1, n), np.int32)
        from_slot = np.zeros((length + 1, n), np.int32)
        edges = []
        unknown = np.zeros(n, bool)
        for s in range(length):
            lead = letters[:, s]
            size = 1 + (lead >= 0xC0).astype(int) + (lead >= 0xE0) + (lead >= 0xF0)
            starts = (lead & 0xC0) != 0x80
            has_piece = np.zeros(n, bool)
            found = []
            h = np.zeros(n, np.uint64)
            for e in range(s + 1, min(length, s + longest) + 1):
                h = h * HASH_BASE + marks[:, e - 1]
                rows, slots = self.vocabulary.find(h)
                if len(rows):
                    found.append((s, e, rows, slots))
                    has_piece[rows[size[rows] == e - s]] = True
            unknown = np.where(starts, ~has_piece, unknown)
            rows = np.flatnonzero(unknown)
            if len(rows):
                found.insert(0, (s, s + 1, rows, self.first_byte + letters[rows, s].astype(int)))
            for _, e, rows, slots in found:
                new = alpha[s, rows] + scores[slots]
                better = new > alpha[e, rows]
                to = rows[better]
                alpha[e, to], from_start[e, to], from_slot[e, to] = new[better], s, slots[better]
            edges += found
        beta = np.full((length + 1, n), -np.inf)
        beta[length] = 0
        for s, e, rows, slots in reversed(edges):
            beta[s, rows] = np.maximum(beta[s, rows], scores[slots] + beta[e, rows])
        every, at = np.arange(n), np.full(n, length)
        next_of = np.zeros((length + 1, n), np.int32)
        path = []
        while at.any():
            path.append(np.where(at > 0, from_slot[at, every], -1))
            before = from_start[at, every]
            next_of[before, every] = np.where(at > 0, at, next_of[before, every])
            at = np.where(at > 0, before, 0)
        other = np.full(n, -np.inf)
        for s, e, rows, slots in edges:
            off = next_of[s, rows] != e
            rows, slots = rows[off], slots[off]
            through = alpha[s, rows] + scores[slots] + beta[e, rows]
            other[rows] = np.maximum(other[rows], through)
        loss = np.maximum(0.0, alpha[length] - other)
        steps = np.stack(path[::-1], 1)  # filled from the right
        flat = steps[steps >= 0].astype(np.int32)
        self._check(letters, flat)
        ends = np.cumsum(4 * (steps >= 0).sum(axis=1)).tolist()
        packed = flat.tobytes()
        slots = [packed[a:e] for a, e in zip([0, *ends], ends, strict=False)]
        return zip(slots, alpha[length].tolist(), loss.tolist(), strict=True)

    def nbest(self, unit: bytes, n: int) -> list[tuple[float, tuple[int, ...]]]:
        """Up to ``n`` best (score, slots) of a unit, best first.

        A backward A-star search from the end of the unit. The forward Viterbi score of a place
        is exactly the best that can still be added to a suffix that begins there, so whole
        segmentations leave the queue in order. Of sums within a millionth the one nearest the
        start goes first, so that long runs with many equal segmentations need no wide search;
        ties keep a fixed order.
        """
        got = self.lists.get(unit)
        if got is not None:
            return got
        edges = self.edges(unit)
        alpha, _ = self.viterbi(unit, edges)
        into: list[list[tuple[int, int]]] = [[] for _ in range(len(unit) + 1)]
        for s, e, slot in edges:
            into[e].append((s, slot))
        queue = [(0.0, len(unit), 0, 0.0, None)]
        out: list[tuple[float, tuple[int, ...]]] = []
        pushed = 0
        while queue and len(out) < n:
            _, at, _, suffix, path = heapq.heappop(queue)
            if at == 0:
                slots = []
                while path is not None:
                    slots.append(path[0])
                    path = path[1]
                out.append((suffix, tuple(slots)))
                continue
            for s, slot in into[at]:
                if alpha[s] > -math.inf:
                    pushed += 1
                    added = suffix + self.scores[slot]
                    total = round(-(added + alpha[s]), 6)
                    heapq.heappush(queue, (total, s, pushed, added, (slot, path)))
        out.sort(key=lambda x: -x[0])
        self.lists[unit] = out
        return out

    def text_nbest(
        self, units: list[bytes], n: int
    ) -> tuple[np.ndarray, float, list[tuple[float, list]]]:
        """Slots and score of the best segmentation of a text's units, and the ``n`` best of all.

        Of units only the ``n - 1`` whose second segmentations lose least can differ from their
        best ones in any of the ``n`` best texts: with another unit changed there are already
        ``n`` texts that are as good. Their lists are merged, so the result is exact. A list
        begins with the best segmentation of the unit that is in use, so that where several are
        equally good it is not taken for a change.
        Each of the ``n`` is (score, changes), a change being (place in slots, number of slots
        replaced, slots instead).
        """
        known, best = self.known.get, self.best
        entries = [known(u) or best(u) for u in units]
        slots = np.frombuffer(b"".join([e[0] for e in entries]), np.int32)
        score = math.fsum([e[1] for e in entries])
        ranked: list[tuple[float, tuple]] = [(0.0, ())]
        loss = np.array([e[2] for e in entries], float)
        few = min(n - 1, len(loss))
        near = np.argsort(loss, kind="stable")[:few]
        for k in sorted(near.tolist()):
            if loss[k] == math.inf:
                continue
            used = tuple(np.frombuffer(entries[k][0], np.int32).tolist())
            top = entries[k][1]
            others = [(s, way) for s, way in self.nbest(units[k], n) if way != used][: n - 1]
            more = [*ranked]
            more += [
                (lost + max(0.0, top - s), (*changed, (k, way)))
                for lost, changed in ranked
                for s, way in others
            ]
            ranked = heapq.nsmallest(n, more, key=lambda x: x[0])
        sizes = [len(e[0]) // 4 for e in entries] if len(ranked) > 1 else []
        starts = np.cumsum([0, *sizes])
        out = []
        for lost, changed in ranked:
            edits = [(int(starts[k]), sizes[k], way) for k, way in sorted(changed)]
            out.append((score - lost, edits))
        return slots, score, out

    def decoded(self, slots: list[int]) -> bytes:
        """The text of a segmentation; the mark put in front of it is taken off."""
        return self._joined(slots)[1:]


def changed(ids: list[int], changes: list[dict]) -> list[int]:
    """The segmentation that ``changes`` make of the best one."""
    out = list(ids)
    for c in sorted(changes, key=lambda c: -c["at"]):
        out[c["at"] : c["at"] + c["was"]] = c["ids"]
    return out


def encoded(docs: DataFrame, n: int = 4, vocabulary_path: str = DEFAULT_VOCABULARY) -> DataFrame:
    """The ``n`` best segmentations of every text of ``docs`` (doc_id, text).

    A text gets the mark in front and its spaces become marks; nothing else is normalised.
    Piece scores are those of the vocabulary (see ``load_vocabulary``); characters without a
    piece go by bytes. No piece holds a mark behind another character or a line end, so a text
    falls into units that are segmented by themselves (words a task has met are remembered).

    Returns doc_id, n_pieces, score and piece_ids of the best segmentation, ``nbest``
    (score, n_pieces and changes against the best, which comes first), and round_trip: whether
    decoding gives the text back. Null and empty texts have no pieces, score 0 and themselves as
    only segmentation. Repeated rows are rows; texts are done where they are read, without
    shuffle; other columns are not looked at.
    """
    vocabulary = load_vocabulary(vocabulary_path)
    ids = np.array(vocabulary.ids, np.int32)

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        segmenter = Segmenter(vocabulary)
        for batch in batches:
            for start in range(0, batch.num_rows, 1000):
                yield encode_rows(batch.slice(start, 1000), segmenter)

    def encode_rows(batch: pa.RecordBatch, segmenter: Segmenter) -> pa.RecordBatch:
        columns: dict[str, list] = {k: [] for k in ("n", "score", "ids", "nbest", "same")}
        texts = [text or b"" for text in batch.column("text").to_pylist()]
        units = [units_of(text) for text in texts]
        segmenter.learn(set(chain.from_iterable(units)))
        for text, parts in zip(texts, units, strict=True):
            slots, score, ranked = segmenter.text_nbest(parts, n)
            columns["n"].append(len(slots))
            columns["score"].append(score)
            columns["ids"].append(ids[slots])
            columns["nbest"].append(
                [
                    {
                        "score": s,
                        "n_pieces": len(slots) + sum(len(new) - was for _, was, new in edits),
                        "changes": [
                            {"at": at, "was": was, "ids": [vocabulary.ids[k] for k in new]}
                            for at, was, new in edits
                        ],
                    }
                    for s, edits in ranked
                ]
            )
            # the pieces of a unit give the unit, see _entry
            columns["same"].append(b"".join(parts)[1:] == text)
        return pa.RecordBatch.from_pydict(
            {
                "doc_id": batch.column("doc_id"),
                "n_pieces": pa.array(columns["n"], pa.int64()),
                "score": pa.array(columns["score"], pa.float64()),
                "piece_ids": pa.array(columns["ids"], pa.list_(pa.int32())),
                "nbest": pa.array(columns["nbest"], _NBEST),
                "round_trip": pa.array(columns["same"], pa.bool_()),
            }
        )

    rows = docs.select("doc_id", F.col("text").cast("binary").alias("text"))
    return rows.mapInArrow(over, ENCODED)


def decoded(rows: DataFrame, vocabulary_path: str = DEFAULT_VOCABULARY) -> DataFrame:
    """doc_id and ``text`` of every row's piece_ids; null ids give null, no ids the empty text."""
    vocabulary = load_vocabulary(vocabulary_path)
    slot_of = {piece_id: slot for slot, piece_id in enumerate(vocabulary.ids)}

    def decode_rows(batch: pa.RecordBatch) -> pa.RecordBatch:
        segmenter = Segmenter(vocabulary)
        texts = [
            None if ids is None else segmenter.decoded([slot_of[i] for i in ids]).decode("utf-8", "replace")
            for ids in batch.column("piece_ids").to_pylist()
        ]
        return pa.RecordBatch.from_pydict(
            {"doc_id": batch.column("doc_id"), "text": pa.array(texts, pa.string())}
        )

    return in_batches(rows.select("doc_id", "piece_ids"), decode_rows, "doc_id long, text string")
