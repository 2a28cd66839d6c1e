"""The lattice of a word's pieces under a public subword vocabulary, and sums over it."""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import cached_property

import numpy as np

DEFAULT_VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"  # stands for the space in pieces
HASH_BASE = np.uint64(0x100000001B3)
_FEW = 16  # words of one length below which vectors do not pay


@dataclass(frozen=True)
class Vocabulary:
    """Pieces as bytes, with a space for the word mark; then the 256 single-byte pieces.

    Slots number the pieces; ``ids`` gives the id of each slot in the vocabulary file.
    """

    pieces: tuple[bytes, ...]
    ids: tuple[int, ...]
    scores: tuple[float, ...]

    @cached_property
    def slots(self) -> dict[bytes, int]:
        return {p: k for k, p in enumerate(self.pieces)}

    @cached_property
    def longest(self) -> int:
        return max(map(len, self.pieces))

    @property
    def size(self) -> int:
        return len(self.ids)

    @cached_property
    def hashes(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Sorted hashes of the pieces, their slots, and a table of hash prefixes in use."""
        found = np.array([_hash(p) for p in self.pieces], np.uint64)
        order = np.argsort(found)
        if (np.diff(found[order]) == 0).any():
            raise ValueError("two pieces share a hash")
        used = np.zeros(1 << 20, bool)
        used[found >> np.uint64(44)] = True
        return found[order], order, used

    @cached_property
    def spelling(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The bytes of all slots in a row, and where each slot's begin and how many they are."""
        every = [*self.pieces, *(bytes((b,)) for b in range(256))]
        sizes = np.fromiter(map(len, every), np.int64, len(every))
        return np.frombuffer(b"".join(every), np.uint8), np.cumsum(sizes) - sizes, sizes

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of the hashes are pieces', and the slots of those."""
        keys, order, used = self.hashes
        rows = np.flatnonzero(used[hashes >> np.uint64(44)])
        at = np.searchsorted(keys, hashes[rows])
        at[at == len(keys)] = 0
        hit = keys[at] == hashes[rows]
        return rows[hit], order[at[hit]]


def hash_marks(letters: np.ndarray) -> np.ndarray:
    return (letters.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)


def _hash(piece: bytes) -> int:
    h = 0
    for x in piece:
        h = ((h * int(HASH_BASE)) + (x + 1) * 0x9E3779B97F4A7C15) & (2**64 - 1)
    return h


def load_vocabulary(path: str = DEFAULT_VOCABULARY) -> Vocabulary:
    """Pieces and scores of a SentencePiece model file with byte fallback.

    The scores of the file are minus the piece's rank. They become log-probabilities by Zipf's
    law (one over rank plus two), over pieces and single bytes together; bytes have the last rank.
    """
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    text, single = [], {}
    for i in range(model.get_piece_size()):
        if model.is_byte(i):
            single[int(model.id_to_piece(i)[3:5], 16)] = i
        elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
            text.append((model.id_to_piece(i).replace(MARK, " ").encode(), i, model.get_score(i)))
    if len(single) != 256:
        raise ValueError(f"{path} has no byte fallback")
    last = max(-s for *_, s in text)
    weights = [1 / (2 - s) for *_, s in text] + [1 / (2 + last)] * 256
    total = math.fsum(weights)
    return Vocabulary(
        tuple(p for p, *_ in text),
        tuple(i for _, i, _ in text) + tuple(single[b] for b in range(256)),
        tuple(math.log(w / total) for w in weights),
    )


def edges_of(word: bytes, vocabulary: Vocabulary) -> list[list[tuple[int, int]]]:
    """For each start in ``word`` the (end, slot) of every piece there, single bytes last."""
    slots, longest, n = vocabulary.slots, vocabulary.longest, len(word)
    byte_slot = len(vocabulary.pieces)
    out = []
    for s in range(n):
        found = []
        for e in range(s + 1, min(n, s + longest) + 1):
            slot = slots.get(word[s:e])
            if slot is not None:
                found.append((e, slot))
        found.append((s + 1, byte_slot + word[s]))
        out.append(found)
    return out


def _log_add(a: float, b: float) -> float:
    if a < b:
        a, b = b, a
    return a if b == -math.inf else a + math.log1p(math.exp(b - a))


def _scalar(word, logp, vocabulary, weight, expected):
    edges, n = edges_of(word, vocabulary), len(word)
    alpha = [0.0] + [-math.inf] * n
    for s, found in enumerate(edges):
        for e, slot in found:
            alpha[e] = _log_add(alpha[e], alpha[s] + logp[slot])
    if expected is not None and weight:
        beta = [-math.inf] * n + [0.0]
        for s in range(n - 1, -1, -1):
            for e, slot in edges[s]:
                beta[s] = _log_add(beta[s], logp[slot] + beta[e])
        for s, found in enumerate(edges):
            for e, slot in found:
                expected[slot] += weight * math.exp(alpha[s] + logp[slot] + beta[e] - alpha[n])
    return alpha[n]


def _vectors(letters, logp, vocabulary, weights, expected):
    """``_scalar`` for a matrix of words of one length, a row each."""
    n, length = letters.shape
    marks = hash_marks(letters)
    alpha = np.full((length + 1, n), -np.inf)
    alpha[0] = 0
    edges = []
    every, byte_slot = np.arange(n), len(vocabulary.pieces)
    for s in range(length):
        h, first = np.zeros(n, np.uint64), len(edges)
        for e in range(s + 1, min(length, s + vocabulary.longest) + 1):
            h = h * HASH_BASE + marks[:, e - 1]
            rows, slots = vocabulary.find(h)
            if len(rows):
                edges.append((s, e, rows, slots))
        edges.append((s, s + 1, every, byte_slot + letters[:, s].astype(np.int64)))
        for a, e, rows, slots in edges[first:]:
            alpha[e, rows] = np.logaddexp(alpha[e, rows], alpha[a, rows] + logp[slots])
    if expected is not None:
        beta = np.full((length + 1, n), -np.inf)
        beta[length] = 0
        for a, e, rows, slots in reversed(edges):
            beta[a, rows] = np.logaddexp(beta[a, rows], logp[slots] + beta[e, rows])
        for a, e, rows, slots in edges:
            share = np.exp(alpha[a, rows] + logp[slots] + beta[e, rows] - alpha[length, rows])
            expected += np.bincount(slots, share * weights[rows], minlength=len(expected))
    return alpha[length]


def log_likelihoods(
    words: list[bytes],
    logp: np.ndarray,
    vocabulary: Vocabulary,
    weights: np.ndarray | None = None,
    expected: np.ndarray | None = None,
) -> np.ndarray:
    """Natural log of the summed probability of all segmentations of each word.

    A forward recursion in log space; a word is taken with its mark in front. With ``weights``
    and ``expected`` a backward recursion adds the expected uses of every slot, times weight.
    """
    out = np.empty(len(words))
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    for length in np.unique(lengths):
        at = np.flatnonzero(lengths == length)
        for part in np.array_split(at, -(-len(at) // 20_000)):
            own = None if weights is None else weights[part]
            if len(part) < _FEW:
                for k, i in enumerate(part):
                    weight = 0 if own is None else own[k]
                    out[i] = _scalar(b" " + words[i], logp, vocabulary, weight, expected)
            else:
                joined = np.frombuffer(b"".join(words[i] for i in part), np.uint8)
                letters = np.full((len(part), length + 1), ord(" "), np.uint8)
                letters[:, 1:] = joined.reshape(len(part), length)
                out[part] = _vectors(letters, logp, vocabulary, own, expected)
    return out
