from __future__ import annotations

from collections import Counter

from tierfold.llm import decontaminate
from tierfold.llm.decontaminate import contaminated_passages, without_contaminated
from tierfold.llm.disclosure import disclosing_terms, mentions, sanitised


def test_terms_of_entities_that_stand_in_one_text(spark):
    """A name beside a unique address is found where another text holds the name as well."""
    data = [(i, f"plain words of a common text {i} about nothing") for i in range(40)]
    data += [(100, "please ask Zyxwora by zy@only.example about common words of a text")]
    data += [(101, "yesterday Zyxwora spoke"), (102, "copied Qqword by qq@only.example here")]
    data += [(103, "copied Qqword by qq@only.example here")]
    df = spark.createDataFrame(data, "doc_id long, text string")
    found = {tuple(r)[:2] for r in disclosing_terms(mentions(df, ["doc_id"]), df).collect()}
    assert ("email zy@only.example", "zyxwora") in found
    # common words give little away, and a text with its copy is no evidence for its words
    assert not {t for _, t in found} & {"about", "words", "of", "text", "qqword", "copied"}
    clean = {r["doc_id"]: r["text"] for r in sanitised(df).collect()}
    assert "Zyxwora" not in clean[100] and "[TERM] by [EMAIL]" in clean[100]
    assert "Qqword" in clean[102] and clean[101] == "yesterday Zyxwora spoke"


def test_repeated_benchmark_rows_take_one_place(spark, monkeypatch):
    item = "The quick brown fox jumps over the lazy dog while nobody looks."
    other = "A second passage under the same number that nobody repeats at all."
    bench = [(1, item)] * 30 + [(1, other), (None, item), (None, item), (2, None), (2, None)]
    held = []

    class Counted(decontaminate.Index):
        def __init__(self, items, q, share):
            held.extend(items)
            super().__init__(items, q, share)

    monkeypatch.setattr(decontaminate, "Index", Counted)
    docs = spark.createDataFrame(
        [(7, f"Start. {item} End."), (7, f"Start. {item} End."), (8, f"{other} x"), (9, "no")],
        "doc_id long, text string",
    )
    found = contaminated_passages(
        docs, spark.createDataFrame(bench, "item_id long, text string")
    ).collect()
    assert Counter((r["doc_id"], r["item_id"]) for r in found) == {
        (7, 1): 60, (7, None): 4, (8, 1): 1,
    }
    assert len(held) == len(set(held)) == 3


def test_short_items_match_equal_texts(spark):
    docs = [
        (1, "  Ab\n c "), (2, "ab c"), (3, "ab cd"), (4, "so ab c it is"), (5, "\u4e2d"), (6, None),
        (7, ""), (8, " "), (9, "x" * 300_000 + " abcdefgh"), (2, "ab c"),
    ]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame(
        [(1, "AB  c"), (2, "\u4e2d"), (3, " "), (4, ""), (5, "abcdefgh"), (6, "ab c")],
        "item_id long, text string",
    )
    found = sorted(tuple(r)[:5] for r in contaminated_passages(df, bench).collect())
    assert found == [
        (1, 1, 2, 7, 0), (1, 6, 2, 7, 0), (2, 1, 0, 4, 0), (2, 1, 0, 4, 0), (2, 6, 0, 4, 0),
        (2, 6, 0, 4, 0), (5, 2, 0, 1, 0), (9, 5, 300_001, 300_009, 0),
    ]
    assert sorted(r["doc_id"] for r in without_contaminated(df, bench).collect()) == [3, 4, 6, 7, 8]


def test_many_blocks_give_what_one_gives(spark, monkeypatch):
    words = [f"number {i} of the passages that a benchmark asks about" for i in range(30)]
    df = spark.createDataFrame(
        [(i, f"x {w} y {words[i // 2]}") for i, w in enumerate(words)], "doc_id long, text string"
    )
    bench = spark.createDataFrame(list(enumerate(words)), "item_id long, text string")
    whole = sorted(map(tuple, contaminated_passages(df, bench).collect()))
    monkeypatch.setattr(decontaminate, "BLOCK_CHARS", 200)
    assert sorted(map(tuple, contaminated_passages(df, bench).collect())) == whole != []
    assert without_contaminated(df, bench).count() == 0


def test_words_near_an_entity_are_ten_whatever_their_length(spark):
    def text(size, n):
        left = [f"l{i}{'a' * size}" for i in range(n)]
        right = [f"r{i}{'b' * size}" for i in range(n)]
        return " ".join([*left, "me@x.example", *right])

    data = [
        (k, text(size, n))
        for k, (size, n) in enumerate([(0, 3), (0, 30), (15, 10), (40, 12), (500, 12), (9_000, 11)])
    ]
    data += [(10, "y" * 100_000 + " me@x.example " + "z" * 100_000), (11, "me@x.example")]
    data += [(12, "w" * 50 + ",me@x.example;" + "v" * 50 + " last")]
    df = spark.createDataFrame(data, "doc_id long, text string")
    for r in mentions(df, ["doc_id"]).collect():
        whole = dict(data)[r["doc_id"]]
        at = whole.index("me@x.example")
        left = whole[:at].split() if whole[:at].endswith(" ") else whole[:at].split()[:-1]
        after = whole[at + len("me@x.example") :]
        right = after.split() if after.startswith(" ") else after.split()[1:]
        [near] = r["__near"]
        assert [w["term"] for w in near["words"]] == [*left[-10:], *right[:10]]
        assert all(whole[w["start"] : w["end"]] == w["term"] for w in near["words"])
