from __future__ import annotations

import hashlib
import math
import random
import re
from collections import defaultdict

import numpy as np
import pytest

import __spark_entry__ as entry_module
import corpus_pipeline
from tierfold.llm import queries
from tierfold.llm.decontaminate import (
    Index,
    contaminated_passages,
    normalised,
    without_contaminated,
)
from tierfold.llm.disclosure import mentions, personal_data, disclosing_terms, sanitised

BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    twice = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
    return sum(x - 9 * (x > 9) for x in twice) % 10 == 0


def brute_spans(text):
    out = []
    for kind, pattern in BASE.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            if (
                kind == "email"
                or (kind == "ip" and all(int(p) <= 255 for p in m[0].split(".")))
                or (kind == "card" and 12 <= len(digits) <= 19 and luhn(digits))
                or (kind == "phone" and 9 <= len(digits) <= 15)
            ):
                out.append((m.start(), list(BASE).index(kind), m.end(), kind))
    return sorted(out)


def best_distance(text, pattern):
    """Least edits between the pattern and any part of the text."""
    row = np.zeros(len(text) + 1, int)
    along = np.arange(len(text) + 1)
    for i, c in enumerate(pattern, 1):
        step = np.concatenate([[i], np.minimum(row[:-1] + (text != c), row[1:] + 1)])
        row = np.minimum.accumulate(step - along) + along
    return int(row.min())


def test_edited_passages_against_full_alignment(rows):
    random.seed(3)
    texts = [r["text"] for r in rows if 120 < len(r["text"]) < 2500]
    items = [" ".join(t.split())[:length].strip() for t, length in zip(texts, range(40, 260, 11))]
    index = Index(list(enumerate(items)), 8, 0.08)
    for _ in range(80):
        k = random.randrange(len(items))
        letters, entry = list(items[k]), index.items[k]
        for _ in range(random.randrange(int(1.5 * entry.budget) + 2)):
            p, way = random.randrange(len(letters)), random.random()
            if way < 0.4:
                letters[p] = random.choice("abcxyz")
            elif way < 0.7:
                del letters[p]
            else:
                letters.insert(p, random.choice("abcxyz"))
        host = "".join(random.choice("abc def ") for _ in range(400))
        cut = random.randrange(400)
        points, _ = normalised(host[:cut] + " " + "".join(letters) + " " + host[cut:])
        truth = best_distance(points, entry.points)
        found = [m for m in index.matches(points) if m[0] == k]
        assert bool(found) == (truth <= entry.budget)
        if found:
            _, start, end, edits, _ = found[0]
            assert edits == truth == best_distance(points[start:end], entry.points)


def test_passages_and_places(spark):
    item = "The quick brown fox jumps over the lazy dog while nobody looks."
    docs = [
        (1, f"Start. {item} End."), (2, f"Start.\n{item.upper().replace(' ', '  ')} End."),
        (3, "nothing of the kind here at all, only other words in a row"), (4, None), (5, ""),
        (6, item.replace("quick", "quikc").replace("lazy", "crazy")), (7, f"{item} {item}"),
        (7, f"{item} {item}"), (8, item[:30]),
    ]
    df = spark.createDataFrame([(*d, "x") for d in docs], "doc_id long, text string, item_id string")
    bench = spark.createDataFrame(
        [(10, item), (11, None), (12, "short"), (13, "")], "item_id long, text string"
    )
    found = contaminated_passages(df, bench).collect()
    assert sorted((r["doc_id"], r["item_id"], r["edits"] > 0) for r in found) == [
        (1, 10, False), (2, 10, False), (6, 10, True), *[(7, 10, False)] * 4,
    ]
    for r in found:
        text = dict(docs)[r["doc_id"]]
        assert len(" ".join(text[r["start"] : r["end"]].split())) == len(item) + (r["doc_id"] == 6)
    clean = without_contaminated(df, bench)
    assert clean.columns == df.columns
    assert sorted(r["doc_id"] for r in clean.collect()) == [3, 4, 5, 8]
    assert contaminated_passages(df.limit(0), bench).count() == 0
    assert contaminated_passages(df, bench.limit(0)).count() == 0


def test_whole_passages_of_the_table(spark, documents, rows, sf_dir):
    bench = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    norm = lambda t: " ".join(re.sub("[A-Z]", lambda m: m[0].lower(), t).split())
    items = [(r["item_id"], norm(r["text"])) for r in bench.collect()]
    truth = {(r["doc_id"], i) for r in rows for i, t in items if t in norm(r["text"])}
    found = {
        (r["doc_id"], r["item_id"])
        for r in contaminated_passages(documents, bench).filter("edits = 0").collect()
    }
    assert truth and found == truth


def test_base_spans(spark, rows):
    odd = [
        "a@b.c@d.e", "a@b.c_x@d.e", "x..y@-.-.", "@a.b", "a@b", "é a.b+c@d-e.f. ü", "a@b.c" * 50,
        "300.1.2.3.4", "1.2.3.4.5.6.7.8", "0001.0.0.255", "1.2.3.256", "1.2.3.4" * 20,
        "4111 1111 1111 1111", "4111-1111-1111-1111 4", "41111111111111112", "4111  1111 1111 1111",
        "4111 1111-1111 1111", "x4111111111111111y", "9" * 6_000, "1 " * 6_000, "1-" * 40,
        "+1 (555) 123-4567", "+1555", "+1" + "(" * 5000, "+12345678901234567", "++1 234 567 8901)",
        "+1.234.567.890 4111111111111111", "中文 +49 (0) 30 123456 🙂 a@b.cd", "a@b" + ".c" * 6_000,
        "x" * 8_000, "", None,
    ]
    texts = [r["text"] for r in rows] + odd
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, spans string")
    found = {r["doc_id"]: r for r in personal_data(df.repartition(4)).collect()}
    for i, text in enumerate(texts):
        spans = brute_spans(text or "")
        joined = ",".join(f"{k}:{a}:{e}" for a, _, e, k in spans)
        got = found[i]
        assert [got[f"n_{k}"] for k in BASE] == [sum(s[3] == k for s in spans) for k in BASE]
        assert got["base_sha256"] == hashlib.sha256(joined.encode()).hexdigest()
        base = [s for s in got["spans"].split(",") if s and not s.startswith("term")]
        assert ",".join(base) == joined


def leaks(spark):
    words = "alpha beta gamma delta"
    data = [(i, f"The secretname{i} met {words} near x{i}@y.example on a day") for i in range(12)]
    data += [(100 + i, f"{i} Bigboss wrote from boss@y.example about {words} item{i}") for i in range(4)]
    data += [(200 + i, f"only {words} and nothing else {i}") for i in range(30)]
    data += [(300, "copied unique words by one@y.example here")] * 5
    data += [(400, None), (401, "")]
    return data, spark.createDataFrame(data, "doc_id long, text string")


def test_disclosing_terms_against_brute_force(spark):
    data, df = leaks(spark)
    found = {
        (r["entity"], r["term"]): r["share"]
        for r in disclosing_terms(mentions(df, ["doc_id"]), df).collect()
    }
    near, of_entity, of_term = defaultdict(list), defaultdict(int), defaultdict(int)
    for _, text in data:
        text = text or ""
        for term in {w.lower() for w in text.split()}:
            of_term[term] += 1
        pairs, entities = set(), set()
        for a, _, e, kind in brute_spans(text):
            entity = f"{kind} {text[a:e].lower()}"
            entities.add(entity)
            for w in [*text[:a].split()[-10:], *text[e:].split()[:10]]:
                pairs.add((entity, w.lower()))
        for entity in entities:
            of_entity[entity] += 1
        for pair in pairs:
            near[pair].append(text)
    truth = {}
    for (entity, term), texts in near.items():
        own = math.log(len(data) / of_entity[entity])
        pmi = math.log(len(texts) * len(data) / (of_entity[entity] * of_term[term]))
        if len(set(texts)) >= 2 and pmi / own >= 0.8:
            truth[entity, term] = pmi / own
    assert ("email boss@y.example", "bigboss") in truth
    assert found.keys() == truth.keys()
    assert all(math.isclose(found[k], truth[k]) for k in truth)


def test_sanitised_texts(spark):
    data, df = leaks(spark)
    clean = {r["doc_id"]: r["text"] for r in sanitised(df).collect()}
    assert clean[0] == "The secretname0 met alpha beta gamma delta near [EMAIL] on a day"
    assert "boss@" not in clean[101] and "Bigboss" not in clean[101]
    assert all(clean[i] == t for i, t in data if 200 <= i < 300 or i >= 400)
    assert sanitised(df).count() == len(data)


def test_personal_data_on_odd_rows(odd_docs, no_docs):
    found = personal_data(odd_docs).collect()
    assert len(found) == 12 and sum(r["n_email"] + r["n_phone"] for r in found) == 2
    clean = sanitised(odd_docs)
    assert clean.columns == odd_docs.columns and clean.count() == 12
    assert clean.filter("doc_id = 10").first()["text"] == "mail [EMAIL] and [PHONE] é中"
    assert personal_data(no_docs).count() == 0 and sanitised(no_docs).count() == 0


def test_pipeline_stages(spark, documents, rows, sf_dir):
    names = documents.columns
    assert 4 <= len(corpus_pipeline.STAGES) <= 5
    docs, kept = documents, [{r["doc_id"] for r in rows}]
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf_dir).cache()
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == names and docs.schema["n_chars"].dataType.simpleString() == "bigint"
        ids = [r["doc_id"] for r in docs.select("doc_id").collect()]
        assert len(ids) == len(set(ids)) and set(ids) <= kept[-1]
        kept.append(set(ids))
    assert len(kept[1]) < len(kept[0]) and len(kept[2]) < len(kept[1]) and len(kept[3]) < len(kept[2])
    assert kept[3] == kept[4] == kept[5]
    found = {r["doc_id"]: r["n_pieces"] for r in corpus_pipeline.run(spark, sf_dir).collect()}
    assert found == {r["doc_id"]: r["n_pieces"] for r in docs.collect()}


def test_pipeline_on_empty_and_odd_tables(odd_docs, no_docs, spark, sf_dir):
    for start in (odd_docs.select("doc_id", "text", "lang", "source", "n_chars"), no_docs):
        docs = start
        for _, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, sf_dir)
        assert docs.count() <= start.count()


def test_every_operator_is_registered():
    names = entry_module.queries()
    numbers = sorted(int(n[2 : n.index("_")]) for n in queries.QUERIES)
    assert numbers == list(range(1, 14)) and set(queries.QUERIES) < set(names)
    assert "pipeline" in names and set(entry_module.oracle_sql()) <= set(names)


@pytest.mark.parametrize("name", [n for n in queries.QUERIES if n.startswith(("op1_", "op6_", "op8_"))])
def test_native_queries_run_no_python(spark, sf_dir, name):
    plan = queries.QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
