from __future__ import annotations

import os
import random

import numpy as np
import pytest
from tokenizers import Tokenizer

from tierfold.llm import tokens
from tierfold.llm.queries import op12_array_merging
from tierfold.llm.tokens import Counter, load_merges, surviving, token_counts

TESTDATA = os.environ.get("TESTDATA_DIR", "/root/testdata")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(tokens.DEFAULT_TOKENIZER)


@pytest.fixture(scope="module")
def merges():
    return load_merges()


def wanted(library, texts):
    return [len(e.ids) for e in library.encode_batch(texts, add_special_tokens=False)]


def test_query_against_the_library(spark, library):
    found = op12_array_merging(spark, f"{TESTDATA}/sf0.01")
    assert found.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
    rows = spark.read.parquet(f"{TESTDATA}/sf0.01/documents.parquet").collect()
    texts = [r["text"] or "" for r in rows]
    truth = {
        (r["doc_id"], len(t.encode()), n, n > 1024)
        for r, t, n in zip(rows, texts, wanted(library, texts), strict=True)
    }
    found = [tuple(r) for r in found.collect()]
    assert len(found) == len(rows) and set(found) == truth
    assert any(r[3] for r in found) and not all(r[3] for r in found)


def test_every_code_point(library, merges):
    """Each code point among letters, numbers, spaces and line ends."""
    points = [c for c in map(chr, range(0x110000)) if not "\ud800" <= c <= "\udfff"]
    texts = [f"a{c}b {c}1{c} {c}{c}!{c} \n{c}{c} x{c}" for c in points]
    counter = Counter(merges)
    for k in range(0, len(texts), 50_000):
        part = texts[k : k + 50_000]
        assert counter.counts(part) == wanted(library, part)


def test_odd_texts(library, merges):
    texts = [
        "", " ", "   ", "\n\n \n", "don't I'LL we've 'tis 's", "a<|endoftext|> <|endoftext|>b",
        "<|endoftext|><|endoftext|>", "x <|endoftext|", "  two  spaces  ", "\x1c\x1d \x85\xa0  a",
        "é" * 300, "🙂👩‍👩‍👧", "՘՘a", "1½²Ⅷ三", "áé", "\x00\x00",
        "aaaaaaaaaaaaaaa", "abababababab", "'" * 31, "=" * 79, "trailing \t",
    ]
    assert Counter(merges).counts(texts) == wanted(library, texts)


@pytest.mark.parametrize("seed", range(3))
def test_random_texts(library, merges, seed):
    pick = random.Random(seed)
    letters = "aabbcceehhinorst  .,'\n\t09éß中🙂" + "<|endoftext|>"
    texts = ["".join(pick.choices(letters, k=pick.randrange(1, 400))) for _ in range(400)]
    assert Counter(merges).counts(texts) == wanted(library, texts)


def test_long_words_one_by_one_and_as_arrays(library, merges, monkeypatch):
    pick = random.Random(5)
    words = ["x" * 50_000, "ab" * 9_001, "".join(pick.choices("etaoinshr", k=30_000))]
    truth = wanted(library, words)
    assert surviving([w.encode() for w in words], merges).tolist() == truth
    monkeypatch.setattr(tokens, "LONG", 1 << 30)
    short = [w[:3_000].encode() for w in words]
    assert surviving(short, merges).tolist() == wanted(library, [w.decode() for w in short])


def test_long_text_in_parts(library, merges, monkeypatch):
    monkeypatch.setattr(tokens, "_LONG_TEXT", 100)
    monkeypatch.setattr(tokens, "_PART", 7)
    text = "some words <|endoftext|> and more, 12 of them.  \n" * 20
    assert Counter(merges).counts([text, "a b"]) == wanted(library, [text, "a b"])


def test_forgetting_changes_nothing(library, merges, monkeypatch):
    monkeypatch.setattr(tokens, "KNOWN_WORDS", 3)
    counter = Counter(merges)
    texts = ["one two three four", "two five six", "one one seven"]
    assert [counter.counts([t])[0] for t in texts] == wanted(library, texts)


def test_no_words(merges):
    assert surviving([], merges).tolist() == []
    assert surviving([b"a", b"z"], merges).tolist() == [1, 1]
    assert np.all(merges.ranks(merges.left, merges.right) == np.arange(len(merges.left)))


def test_odd_rows(odd_docs, no_docs, library):
    found = sorted(map(tuple, token_counts(odd_docs).collect()), key=str)
    rows = odd_docs.collect()
    counts = wanted(library, [r["text"] or "" for r in rows])
    truth = [
        (r["doc_id"], len((r["text"] or "").encode()), n, n > 1024)
        for r, n in zip(rows, counts, strict=True)
    ]
    assert found == sorted(truth, key=str)
    assert token_counts(no_docs).count() == 0


def test_other_files_are_refused(tmp_path):
    with pytest.raises(ValueError, match="byte-level"):
        load_merges("/opt/tokenizers/word_bpe_49k.json")
