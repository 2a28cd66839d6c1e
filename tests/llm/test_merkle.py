from __future__ import annotations

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from tierfold.llm.merkle import TOP, manifest
from tierfold.llm.queries import op13_merkle_manifest

COLUMNS = ["doc_id", "source", "lang", "n_chars", "text"]


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    texts = [None if row[c] is None else str(row[c]) for c in COLUMNS]
    return h(*("-" if t is None else f"{len(t.encode())}:{t}" for t in texts))


def tree(digests):
    levels = [digests]
    while len(levels[-1]) > 1:
        now = levels[-1]
        levels.append([h(*now[k : k + 2]) for k in range(0, len(now), 2)])
    return levels


def climb(digest, levels, at):
    """Siblings on the way up, and the root that ``digest`` in the place ``at`` gives."""
    siblings = []
    for level in levels[:-1]:
        pair = list(level[at & ~1 : (at & ~1) + 2])
        siblings += [d for k, d in enumerate(pair) if k != at & 1]
        pair[at & 1] = digest
        digest, at = h(*pair), at >> 1
    return siblings, digest


def tampered(row):
    seventh = row["doc_id"] is not None and zlib.crc32(str(row["doc_id"]).encode()) % 7 == 0
    return {**row, "n_chars": row["n_chars"] + 1} if seventh and row["n_chars"] is not None else row


def brute(rows):
    """The contract, row by row."""
    groups = {}
    for r in rows:
        groups.setdefault(r["lang"], []).append(r)
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for g, members in groups.items():
        members.sort(key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf(r)))
        trees[g] = tree([leaf(r) for r in members])
    top = tree([trees[g][-1][0] for g in order])
    out = []
    for g, members in groups.items():
        for at, r in enumerate(members):
            siblings, new = climb(leaf(tampered(r)), trees[g], at)
            more, new = climb(new, top, order.index(g))
            root = top[-1][0]
            proof = h(*siblings, *more)
            out.append((r["doc_id"], leaf(r), trees[g][-1][0], root, proof, new, new == root))
    return out


def by_leaf(rows):
    return sorted(map(tuple, rows), key=lambda r: (r[1], r[4]))


def seventh():
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0


def built(docs, height):
    return manifest(docs, COLUMNS, seventh(), {"n_chars": F.col("n_chars") + 1}, height=height)


PROOF = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def test_query_against_the_contract(spark, rows, sf_dir):
    found = op13_merkle_manifest(spark, sf_dir)
    assert found.columns == PROOF
    assert by_leaf(found.collect()) == by_leaf(brute(rows))


@pytest.mark.parametrize("height", [1, 2, 3])
def test_several_strata_of_blocks(documents, rows, height):
    """Low blocks, so that trees have many strata; counts just at and past powers of two."""
    found = built(documents, height).proofs.select(*PROOF).collect()
    assert by_leaf(found) == by_leaf(brute(rows))
    assert 0 < sum(not r["verified"] for r in found) < len(found) / 4


@pytest.mark.parametrize("n", [1, 2, 8, 9])
def test_sizes_of_one_tree(spark, n):
    rows = [
        {"doc_id": k, "source": None, "lang": "en", "n_chars": k, "text": "x"} for k in range(n)
    ]
    docs = spark.createDataFrame(
        [tuple(r[c] for c in COLUMNS) for r in rows],
        "doc_id long, source string, lang string, n_chars long, text string",
    )
    found = built(docs, 2).proofs.select(*PROOF).collect()
    assert by_leaf(found) == by_leaf(brute(rows))


@pytest.mark.parametrize("height", [2, 12])
def test_odd_rows(odd_docs, no_docs, height):
    rows = [r.asDict() for r in odd_docs.collect()]
    found = built(odd_docs, height).proofs.select(*PROOF).collect()
    assert by_leaf(found) == by_leaf(brute(rows))
    empty = built(no_docs, height)
    assert empty.proofs.count() == 0 and empty.nodes().count() == 0


def test_a_changed_null_stays(spark):
    """Ids that are to be tampered with (49 is one) but have no number of characters."""
    ids = [k for k in range(200) if zlib.crc32(str(k).encode()) % 7 == 0][:3]
    docs = spark.createDataFrame(
        [(k, "s", "en", None, "t") for k in ids],
        "doc_id long, source string, lang string, n_chars long, text string",
    )
    made = built(docs, 2).proofs
    assert made.filter("verified and copied is not null").count() == len(ids)


def test_versions_share_all_nodes_but_their_own(documents, rows):
    """Base nodes with a version's copies over them are the tree built anew from the change."""
    made = built(documents, 2)
    base = {(r["tree"], r["level"], r["position"]): r["digest"] for r in made.nodes().collect()}
    versions = {}
    for r in made.copies().collect():
        version = versions.setdefault((r["version_tree"], r["version_position"]), {})
        version[r["tree"], r["level"], r["position"]] = r["digest"]
    proofs = {(r["tree"], r["position"]): r for r in made.proofs.collect()}
    assert set(versions) == {k for k, r in proofs.items() if r["copied"] is not None}
    assert len(versions) > 10
    groups = {}
    for (key, place), r in proofs.items():
        groups.setdefault(key, {})[place] = r["leaf"]
    for (key, place), own in sorted(versions.items())[::7]:
        leaves = {g: [m[k] for k in range(len(m))] for g, m in groups.items()}
        leaves[key][place] = own[key, 0, place]
        whole = {g: tree(m) for g, m in leaves.items()}
        whole[TOP] = tree([whole[g][-1][0] for g in sorted(leaves)])
        wanted = {
            (g, level, k): digest
            for g, levels in whole.items()
            for level, digests in enumerate(levels)
            for k, digest in enumerate(digests)
        }
        assert base | own == {k: v for k, v in wanted.items() if k[:2] != (TOP, 0)}
        assert len(own) <= len(whole[key]) + len(whole[TOP])
