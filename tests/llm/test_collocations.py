from __future__ import annotations

import os
import random
import re
import time
from collections import Counter

import pytest

from tierfold.llm import collocations as c
from tierfold.llm.collocations import collocations, gram_counts, phrase_graph
from tierfold.llm.queries import op11_word_graph

TESTDATA = os.environ.get("TESTDATA_DIR", "/root/testdata")
COLUMNS = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
LOWER = {k: k + 32 for k in range(65, 91)}


def pieces(text):
    for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
        if words := re.findall(r"[^\x20\x09]+", piece):
            yield words


def brute_counts(rows):
    counts = {}
    for r in rows:
        of_lang = counts.setdefault("und" if r["lang"] is None else r["lang"], Counter())
        for words in pieces(r["text"]):
            for i in range(len(words)):
                for k in range(1, min(5, len(words) - i) + 1):
                    of_lang[tuple(words[i : i + k])] += 1
    return counts


def brute(rows, least, top):
    out = []
    for lang, f in brute_counts(rows).items():
        n = sum(x for g, x in f.items() if len(g) == 1)
        candidates = {g: a for g, a in f.items() if len(g) > 1 and a >= least}
        inside = {}
        for g, a in candidates.items():
            for k in range(2, len(g)):
                for i in range(len(g) - k + 1):
                    inside[g[i : i + k]] = max(a, inside.get(g[i : i + k], 0))
        found = []
        for g, a in candidates.items():
            if 100 * inside.get(g, 0) >= 100 * a:
                continue
            cuts = [(1000 * a * n // (f[g[:k]] * f[g[k:]]), k) for k in range(1, len(g))]
            score, k = min(cuts)
            found.append((" ".join(g), a, f[g[:k]], f[g[k:]], n, score))
        found.sort(key=lambda x: (-x[5], -x[1], x[0].encode()))
        out += [(lang, rank, *x) for rank, x in enumerate(found[:top], 1)]
    return sorted(out)


def same(found, truth):
    assert found.columns == COLUMNS
    found = sorted(map(tuple, found.collect()))
    assert found == truth


def made(spark, texts, langs=None):
    langs = langs or ["en"] * len(texts)
    rows = [{"doc_id": k, "text": t, "lang": g} for k, (t, g) in enumerate(zip(texts, langs, strict=True))]
    return spark.createDataFrame(
        [(r["doc_id"], r["text"], r["lang"]) for r in rows], "doc_id long, text string, lang string"
    ).repartition(3), rows


def test_query_against_all_counts(spark):
    docs = spark.read.parquet(f"{TESTDATA}/sf0.01/documents.parquet")
    truth = brute([r.asDict() for r in docs.collect()], 100, 2000)
    assert len(truth) > 50
    same(op11_word_graph(spark, f"{TESTDATA}/sf0.01"), truth)


@pytest.mark.parametrize(("least", "top", "bits"), [(2, 10_000, 26), (3, 40, 26), (3, 10_000, 15)])
def test_low_limits(documents, rows, least, top, bits):
    """Also with a bitmap that nearly every hash shares with others."""
    same(collocations(documents, least, top, bits), brute(rows, least, top))


@pytest.mark.parametrize("seed", range(3))
def test_graphs_with_branches_and_cycles(spark, seed):
    """Few words, so that there are cycles, repeats and branches; ends of pieces everywhere."""
    pick = random.Random(seed)
    texts = [
        " ".join(pick.choices(["ha", "Ho", "hum", "é", "x."], [6, 3, 2, 1, 1], k=pick.randrange(30)))
        for _ in range(60)
    ]
    passage = " ".join(f"w{k}" for k in range(40))
    texts += ["ha " * 40, passage, f"{passage} and on", f"before {passage}"] * 3
    docs, rows = made(spark, texts, [pick.choice(["en", "de", None, "und"]) for _ in texts])
    same(collocations(docs, 2, 100_000), brute(rows, 2, 100_000))


def test_counts_and_compaction(spark):
    passage = " ".join(f"w{k}" for k in range(30))
    docs, rows = made(spark, [passage, f"a b {passage} c", f"{passage}. {passage}", "ha " * 9])
    totals, paths, ends = phrase_graph(docs, 1)
    assert [tuple(r) for r in totals.collect()] == [("en", 4 * 30 + 3 + 9)]
    found = {r["gram"]: r["f"] for r in gram_counts(paths, ends, 1).collect()}
    assert found == {" ".join(g): x for g, x in brute_counts(rows)["en"].items()}
    lengths = Counter((len(r["words"]), r["c"]) for r in paths.collect())
    assert lengths[30, 4] == 1  # 26 edges of the passage in one row
    assert sum(lengths.values()) < 10


def test_a_cycle_without_a_beginning_stays_whole(spark):
    edges = [" ".join(f"k{(i + j) % 6}" for j in range(5)) for i in range(6)]
    rows = c.compacted(
        spark.createDataFrame([("en", e, 7) for e in edges], "lang string, gram string, c long")
    ).collect()
    assert sorted(" ".join(r["words"]) for r in rows) == sorted(edges)


def test_products_past_64_bits(spark):
    """The arithmetic of the score at counts no test table has."""
    a, n, l, r = 9_000_000_000_001, 99_999_999_999_999, 10_000_000_000_007, 9_500_000_000_003
    row = spark.createDataFrame([(a, n, l, r)], "a long, n long, l long, r long")
    found = c.with_score(row).first()["score"]
    assert found == 1000 * a * n // (l * r)


def test_long_texts_in_sections(spark, monkeypatch):
    monkeypatch.setattr(c, "CHUNK_BYTES", 50)
    text = ("some words here, and more of them there. " * 20).encode()
    sections = list(c._sections(text))
    assert len(sections) > 10
    assert [w for s in sections for w in pieces(s.decode())] == list(pieces(text.decode()))
    assert list(c._sections(b"x" * 500)) == [b"x" * 500]


def test_tasks_hold_few_chunks_of_a_file(spark, tmp_path, monkeypatch):
    """Chunks are rows of megabytes: a page or an Arrow batch of many would be their sum."""
    seen, count = str(tmp_path / "seen"), c._word_counts

    def noted(batches):
        def each():
            for batch in batches:
                with open(seen, "a") as log:
                    log.write(f"{batch.num_rows} {batch.nbytes}\n")
                yield batch

        yield from count(each())

    monkeypatch.setattr(c, "_word_counts", noted)
    words = [f"w{k}" for k in range(3000)]
    text = " ".join(words * (c.CHUNK_BYTES // len(" ".join(words)) + 1))
    docs = spark.createDataFrame([("en", text)] * 6, "lang string, text string").coalesce(1)
    totals, _, _ = phrase_graph(docs, 10**9)
    assert [tuple(r) for r in totals.collect()] == [("en", 6 * len(text.split()))]

    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    (path,) = totals.inputFiles()
    hadoop = jvm.org.apache.parquet.hadoop
    file = hadoop.util.HadoopInputFile.fromPath(jvm.org.apache.hadoop.fs.Path(path), conf)
    reader = hadoop.ParquetFileReader.open(file)
    try:
        (block,) = reader.getFooter().getBlocks()
        column = next(x for x in block.getColumns() if "tokens" in x.getPath().toDotString())
        assert block.getRowCount() == 6
        assert reader.readOffsetIndex(column).getPageCount() == 6
    finally:
        reader.close()
    with open(seen) as log:
        batches = [tuple(map(int, line.split())) for line in log]
    assert sum(n for n, _ in batches) == 6
    assert max(size for _, size in batches) < 2 * c.CHUNK_BYTES
    assert spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch") != str(c.CHUNK_BYTES)


def test_shuffle_files_go_with_each_pass(spark):
    """The passes shuffle as much as the texts are large; only what the last one made may stay."""

    def files():
        disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
        found = disk.getAllFiles().mkString(" ").split()
        return {f for f in found if "/shuffle_" in f and f.endswith(".data")}

    docs, _ = made(spark, ["some words that come again and again. " * 9] * 40)
    before = files()
    collocations(docs, 5)
    end = time.time() + 20
    while (left := files() - before) and time.time() < end:
        time.sleep(0.5)
    assert not left


def test_odd_rows(odd_docs, no_docs):
    rows = [r.asDict() for r in odd_docs.collect()]
    same(collocations(odd_docs, 2, 50), brute(rows, 2, 50))
    assert collocations(no_docs).count() == 0
