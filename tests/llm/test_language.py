from __future__ import annotations

import itertools
import math
import os
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from tierfold.llm.lattice import load_vocabulary, log_likelihoods
from tierfold.llm.likelihood import lattice_scores, trained_model
from tierfold.llm.nbest import Segmenter, changed, decoded, encoded, units_of

TESTDATA = os.environ.get("TESTDATA_DIR", "/root/testdata")


@pytest.fixture(scope="module")
def vocabulary():
    return load_vocabulary()


def all_segmentations(word, slots, first_byte, every_byte):
    if not word:
        yield ()
        return
    ends = [e for e in range(1, len(word) + 1) if word[:e] in slots]
    for e in ends:
        for rest in all_segmentations(word[e:], slots, first_byte, every_byte):
            yield (slots[word[:e]], *rest)
    if every_byte:
        for rest in all_segmentations(word[1:], slots, first_byte, every_byte):
            yield (first_byte + word[0], *rest)


def brute_marginal(word, logp, vocabulary):
    paths = all_segmentations(b" " + word, vocabulary.slots, len(vocabulary.pieces), True)
    return math.log(math.fsum(math.exp(sum(logp[k] for k in p)) for p in paths))


@pytest.mark.parametrize("copies", [1, 20])
def test_marginal_and_expected_uses(vocabulary, copies):
    """A sum over every segmentation, by recursion one by one and as vectors."""
    logp = np.array(vocabulary.scores)
    words = [b"the", b"thing", b"qzx", "né".encode(), b"a", b""]
    expected = np.zeros(vocabulary.size)
    found = log_likelihoods(words * copies, logp, vocabulary, np.ones(len(words) * copies), expected)
    truth = [brute_marginal(w, logp, vocabulary) for w in words]
    assert np.allclose(found, truth * copies, rtol=1e-12)
    uses = np.zeros(vocabulary.size)
    for word, total in zip(words, truth, strict=True):
        for path in all_segmentations(b" " + word, vocabulary.slots, len(vocabulary.pieces), True):
            for k in path:
                uses[k] += math.exp(sum(logp[j] for j in path) - total)
    assert np.allclose(expected, uses * copies, atol=1e-9)


def test_scores(spark, documents, rows, vocabulary):
    counts, ends = Counter(), 0
    for r in rows:
        if zlib.crc32(str(r["doc_id"]).encode()) % 10:
            counts.update(r["text"].encode().lower().split())
            ends += 1
    n, v = sum(counts.values()) + ends, len(counts) + 1
    words = spark.createDataFrame(
        [(bytearray(w), c) for w, c in counts.items()], "word binary, c long"
    )
    logp, end = trained_model(words, ends, vocabulary, 2)
    assert abs(math.exp(end) + np.exp(logp).sum() - 1) < 1e-9
    every = sorted({w for r in rows for w in r["text"].encode().lower().split()})
    of_word = dict(zip(every, log_likelihoods(every, logp, vocabulary), strict=True))
    found = {r["doc_id"]: r for r in lattice_scores(documents, rounds=2).collect()}
    for r in rows:
        tokens, got = r["text"].encode().lower().split(), found[r["doc_id"]]
        held = zlib.crc32(str(r["doc_id"]).encode()) % 10 == 0
        base = [math.log10((counts[w] + 0.1) / (n + 0.1 * (v + 1))) for w in tokens]
        base.append(math.log10((ends + 0.1) / (n + 0.1 * (v + 1))))
        known = sum(counts[w] > 0 for w in tokens) + 1
        assert tuple(got)[1:5] == (held, len(tokens) + 1, known, n)
        assert math.isclose(got["base_score"], math.fsum(base), rel_tol=1e-9)
        score = (math.fsum(of_word[w] for w in tokens) + end) / math.log(10)
        assert math.isclose(got["score"], score, rel_tol=1e-9)


def test_training_raises_held_out_likelihood(documents):
    held = [
        lattice_scores(documents, rounds=k).filter("held_out").agg({"score": "sum"}).first()[0]
        for k in (0, 1, 3)
    ]
    assert held[0] < held[1] < held[2]


def test_scores_on_odd_rows(odd_docs, no_docs):
    found = lattice_scores(odd_docs).collect()
    assert len(found) == 12
    empty = {(r["n_tokens"], r["score"]) for r in found if r["doc_id"] in (1, 2, 3)}
    assert len(empty) == 1 and empty.pop()[0] == 1
    assert all(math.isfinite(r["score"]) and r["score"] < 0 for r in found)
    assert lattice_scores(no_docs).count() == 0


def test_nbest_against_all_segmentations(vocabulary):
    segmenter = Segmenter(vocabulary)
    units = [b" the", b" thing", b" hello", b"\n", b"   a", b" xqz"]
    for unit in units:
        paths = all_segmentations(unit, vocabulary.slots, segmenter.first_byte, False)
        truth = sorted((sum(segmenter.scores[k] for k in p) for p in paths), reverse=True)
        if not truth:  # a line end goes by its byte
            truth = [segmenter.scores[segmenter.first_byte + unit[0]]]
        found = segmenter.nbest(unit, 7)
        assert np.allclose([s for s, _ in found], truth[:7]) and len(set(found)) == len(found)
        slots, score, loss = segmenter.best(unit)
        assert math.isclose(score, truth[0], rel_tol=1e-12)
        assert len(truth) == 1 or math.isclose(loss, truth[0] - truth[1], abs_tol=1e-9)
    text = b"the thing\nis a  thing"
    lists = [segmenter.nbest(u, 6) for u in units_of(text)]
    sums = sorted((math.fsum(s for s, _ in c) for c in itertools.product(*lists)), reverse=True)
    assert np.allclose([s for s, _ in segmenter.text_nbest(units_of(text), 6)[2]], sums[:6])


def test_vectors_equal_one_by_one(vocabulary, rows):
    units = {u for r in rows for u in units_of(r["text"].encode())}
    units |= set(units_of("a中文b é中 x€€y ▁ \x00".encode()))
    many, one = Segmenter(vocabulary), Segmenter(vocabulary)
    many.learn(units)
    for unit in units:
        a, b = many.known[unit], one.best(unit)
        assert a[0] == b[0] and np.allclose(a[1:], b[1:])


def test_encoding_decodes_to_the_text(spark, documents, rows, vocabulary):
    odd = ["", " ", "  two  spaces ", "tab\tand\nline\r\n", "▁mark", "中文 🙂", "é" * 300, None]
    docs = spark.createDataFrame(
        [(r["doc_id"], r["text"]) for r in rows] + [(10_000 + i, t) for i, t in enumerate(odd)],
        "doc_id long, text string",
    )
    pieces = encoded(docs, 5).cache()
    back = {r["doc_id"]: r["text"] for r in decoded(pieces).collect()}
    texts = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    assert back == texts
    score = dict(zip(vocabulary.ids, vocabulary.scores, strict=True))
    for r in pieces.collect():
        assert r["round_trip"] and r["n_pieces"] == len(r["piece_ids"])
        scores = [b["score"] for b in r["nbest"]]
        assert scores == sorted(scores, reverse=True) and scores[0] == r["score"]
        ways = [changed(r["piece_ids"], [c.asDict() for c in b["changes"]]) for b in r["nbest"]]
        assert len({tuple(w) for w in ways}) == len(ways)
        for way, b in zip(ways, r["nbest"], strict=True):
            assert len(way) == b["n_pieces"]
            assert math.isclose(math.fsum(score[i] for i in way), b["score"], rel_tol=1e-9, abs_tol=1e-9)
    pieces.unpersist()


def test_encoding_odd_rows(odd_docs, no_docs):
    assert encoded(odd_docs).filter("round_trip").count() == 12
    assert encoded(no_docs).count() == 0


def test_no_piece_reaches_across_units(vocabulary):
    assert all(re.fullmatch(rb" *[^ \n]*", p) for p in vocabulary.pieces)


@pytest.mark.parametrize("text", ["rrrrñ", "aaaaaaa rrrrñ", "......", "    a\n\n\nhahaha"])
def test_equal_segmentations_are_listed_once(vocabulary, text):
    """Of units with ties too the n ways are different, and their sums the n largest."""
    segmenter, parts, n = Segmenter(vocabulary), units_of(text.encode()), 6
    segmenter.learn(set(parts))
    slots, score, ranked = segmenter.text_nbest(parts, n)
    base = slots.tolist()
    ways = [
        changed(base, [{"at": a, "was": w, "ids": list(new)} for a, w, new in edits])
        for _, edits in ranked
    ]
    assert len({tuple(w) for w in ways}) == len(ways) and ways[0] == base
    every = [
        [
            (sum(segmenter.scores[k] for k in p), p)
            for p in all_segmentations(u, vocabulary.slots, segmenter.first_byte, False)
        ]
        or [(segmenter.scores[segmenter.first_byte + b], (segmenter.first_byte + b,)) for b in u]
        if "ñ" not in u.decode()
        else _with_bytes(segmenter, u)
        for u in parts
    ]
    sums = [0.0]
    for found in every:
        sums = sorted((a + s for a in sums for s, _ in found), reverse=True)[: 50 * n]
    assert np.allclose([s for s, _ in ranked], sums[:n])
    assert len(ranked) == min(n, math.prod(map(len, every)))


def _with_bytes(segmenter, unit):
    """All segmentations over ``edges``, which go by bytes where a character has no piece."""
    edges, out = segmenter.edges(unit), []

    def go(at, score, path):
        if at == len(unit):
            out.append((score, path))
        for s, e, slot in edges:
            if s == at:
                go(e, score + segmenter.scores[slot], (*path, slot))

    go(0, 0.0, ())
    return out


def test_ways_of_every_text_are_distinct(spark):
    """At sf0.01, where units with equally good segmentations occur."""
    docs = spark.read.parquet(f"{TESTDATA}/sf0.01/documents.parquet")
    for r in encoded(docs, 4).collect():
        ways = [changed(r["piece_ids"], [c.asDict() for c in b["changes"]]) for b in r["nbest"]]
        assert len({tuple(w) for w in ways}) == len(ways)
