from __future__ import annotations

import hashlib

import numpy as np
import pytest
import xxhash

from tierfold.llm.components import connected_components
from tierfold.llm.phrases import without_repeats
from tierfold.llm.simhash import (
    deduplicated,
    fingerprint,
    fingerprint_links,
    near_duplicates,
    neighbour_steps,
)


def slow_fingerprint(text):
    words = text.encode().lower().split()
    if not words:
        return 0
    runs = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [b" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(x, 42) for x in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(pairs, nodes):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_fingerprints_and_components(documents, rows):
    prints = {r["doc_id"]: slow_fingerprint(r["text"]) for r in rows}
    found = near_duplicates(documents).collect()
    assert {r["doc_id"]: r["fp"] % 2**64 for r in found} == prints
    ids = sorted(prints)
    pairs = [
        (a, b) for i, a in enumerate(ids) for b in ids[i + 1 :]
        if (prints[a] ^ prints[b]).bit_count() <= 2
    ]
    assert {r["doc_id"]: r["component_id"] for r in found} == components(pairs, ids)


@pytest.mark.parametrize(("segments", "block"), [(2, 50), (4, 7), (4, 1024)])
def test_links_join_exactly_what_is_near(spark, segments, block):
    random = np.random.default_rng(5)
    values = random.integers(0, 2**63, 150).tolist() + [0, -1, 1, 3, 7, 15]
    for _ in range(300):
        x = values[random.integers(len(values))]
        flips = random.integers(0, 64, random.integers(1, 4))
        x = (x % 2**64) ^ int(np.bitwise_or.reduce(np.uint64(1) << flips.astype(np.uint64)))
        values.append(x - 2**64 if x >> 63 else x)
    values = sorted(set(values))
    df = spark.createDataFrame([(v,) for v in values], "fp long")
    links = [tuple(r) for r in fingerprint_links(df, 2, segments, block).collect()]
    near = [
        (a, b) for i, a in enumerate(values) for b in values[i + 1 :]
        if ((a ^ b) % 2**64).bit_count() <= 2
    ]
    assert components(links, values) == components(near, values)
    assert len(neighbour_steps(segments, 2)) == {2: 7, 4: 21}[segments]


def test_components_of_long_chains(spark):
    chain = [(i, i + 1) for i in range(100, 180)] + [(5, 3), (3, 5), (9, 9), (None, 4)]
    found = dict(
        tuple(r) for r in connected_components(spark.createDataFrame(chain, "a long, b long")).collect()
    )
    assert found == {**{i: 100 for i in range(100, 181)}, 3: 3, 5: 3}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_near_duplicates_on_odd_rows(odd_docs, no_docs):
    found = near_duplicates(odd_docs).collect()
    assert len(found) == 12
    wordless = {r["component_id"] for r in found if r["fp"] == 0}
    assert wordless == {1}
    one = deduplicated(odd_docs)
    assert one.columns == odd_docs.columns
    ids = sorted((r["doc_id"] is not None, r["doc_id"]) for r in one.select("doc_id").collect())
    # of the rows without words that of the null id stays, and one of each other group
    assert ids == [(False, None)] * 2 + [(True, k) for k in (4, 4, 7, 9, 10)]
    assert near_duplicates(no_docs).count() == 0 and deduplicated(no_docs).count() == 0


def test_fingerprint_of_few_words():
    for text in ("", "  \n", "One", "one two", "one two three", "É é"):
        assert fingerprint(text.encode()) % 2**64 == slow_fingerprint(text)


def brute_repeats(texts, width=20):
    """{id: (words, removed, digest)} of (order, id, text); rows of one order are one place."""
    first = {}
    for order, _, text in texts:
        words = text.split()
        for i in range(len(words) - width + 1):
            key = tuple(words[i : i + width])
            first[key] = min(first.get(key, (order, i)), (order, i))
    out = []
    for order, doc_id, text in texts:
        words = text.encode().split()
        gone = [False] * len(words)
        for i in range(len(words) - width + 1):
            if first[tuple(text.split()[i : i + width])] < (order, i):
                gone[i : i + width] = [True] * width
        kept = b" ".join(w for w, g in zip(words, gone, strict=True) if not g)
        out.append((doc_id, len(words), sum(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def test_repeated_passages(documents, rows):
    found = sorted((tuple(r) for r in without_repeats(documents).collect()), key=repr)
    assert found == brute_repeats([(r["doc_id"], r["doc_id"], r["text"]) for r in rows])


def test_repeats_inside_and_across(spark):
    base = [f"w{i}" for i in range(200)]
    run = " ".join(base[50:75])
    texts = [
        (3, " ".join(base)), (1, f"start {run} end"), (2, " ".join(["la"] * 60)),
        (4, " ".join(["la"] * 30 + base[:22])), (5, f"{run} x {run}"), (6, " ".join(base[:19])),
        (7, " ".join(base)), (8, f"W50 {run.upper()}"),
    ]
    df = spark.createDataFrame(texts, "doc_id long, text string")
    found = sorted((tuple(r) for r in without_repeats(df).collect()), key=repr)
    assert found == brute_repeats([(i, i, t) for i, t in texts])


def test_repeats_on_odd_rows(odd_docs, no_docs):
    found = {}
    for r in without_repeats(odd_docs).collect():
        found.setdefault(r["doc_id"], []).append(r["n_removed"])
    assert found[8] == [60_000] and found[7][0] > 0 and found[1] == [0]
    assert found[4] == [0, 0, 0]  # rows that share an id are one document
    assert without_repeats(no_docs).count() == 0
