"""Phrase collocations, counted on a weighted de Bruijn graph of words."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tierfold.llm.common import bitmap, in_bitmap, written
from tierfold.session import settings_during

LONGEST = 5  # words of a phrase at most; edges have as many, nodes one less
CHUNK_BYTES = 4 << 20  # of text that shares the numbers of its words
NO_LANG = "und"
_BATCH_ROWS = 100_000  # of what a chunk yields
# A chunk is a row of megabytes. By default Parquet looks at the size of a page after 100 rows
# and Arrow closes a batch at 64 MB, so that tasks would hold all chunks of a file at once,
# several times and outside the heap.
_PAGES = {"parquet.page.size.row.check.min": "1", "parquet.page.size.row.check.max": "1"}
# Shuffle files go at the end of each pass instead of when the driver collects its garbage.
_SETTINGS = {
    "spark.sql.execution.arrow.maxBytesPerBatch": str(CHUNK_BYTES),
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
}
_RANK_PARTS = 64  # in which phrases of a language are ranked before the whole language is
_CHUNK = "lang string, n_words long, tokens binary, words array<binary>"
_CHUNK_ARROW = pa.schema(
    [
        ("lang", pa.string()), ("n_words", pa.int64()), ("tokens", pa.binary()),
        ("words", pa.list_(pa.binary())),
    ]
)

# What ends a piece, and what stands between words.
_ENDS = b".,;:!?\n\x0b\x0c\r"
_END = b"\xff"  # stands for them; no byte of a text in UTF-8
_MARKED = bytes.maketrans(_ENDS + b"\t", _END * len(_ENDS) + b" ")
_NEXT_END = re.compile(b"[" + re.escape(_ENDS) + b"]")


class _Numbers(dict):
    """Words numbered from 1 as they are met; 0 is the end of a piece."""

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


def _sections(text: bytes) -> Iterator[bytes]:
    """A text whole or, where it is very long, cut at ends of pieces."""
    at = 0
    while len(text) - at > CHUNK_BYTES:
        end = _NEXT_END.search(text, at + CHUNK_BYTES)
        if end is None:
            break
        yield text[at : end.start()]
        at = end.end()
    yield text[at:]


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts as numbers of their words, by chunk and language, with the numbered words."""
    numbers: dict[str, _Numbers] = {}
    tokens: dict[str, list[np.ndarray]] = {}
    size = 0

    def chunk() -> Iterator[pa.RecordBatch]:
        for lang, parts in tokens.items():
            ids = np.concatenate(parts)
            row = {
                "lang": lang, "n_words": int(np.count_nonzero(ids)), "tokens": ids.tobytes(),
                "words": list(numbers[lang])[1:],
            }
            yield pa.RecordBatch.from_pylist([row], _CHUNK_ARROW)

    for batch in batches:
        langs, texts = batch.column("lang").to_pylist(), batch.column("text")
        for lang, text in zip(langs, texts, strict=True):
            for section in _sections(text.as_py()):
                if lang not in numbers:
                    numbers[lang], tokens[lang] = _Numbers({_END: 0}), []
                marked = section.lower().translate(_MARKED) + _END
                found = marked.replace(_END, b" \xff ").split(b" ")
                number = numbers[lang].__getitem__
                tokens[lang].append(np.array([number(w) for w in found if w], np.int32))
                size += len(section)
                if size >= CHUNK_BYTES:
                    yield from chunk()
                    numbers, tokens, size = {}, {}, 0
    yield from chunk()


def _hashes(lang: str, words: list[bytes]) -> np.ndarray:
    """Hashes of the words of a language, by number; 0 for the end of a piece."""
    head = lang.encode() + b"\x00"
    digest = xxhash.xxh64_intdigest
    return np.fromiter((0, *(digest(head + w) for w in words)), np.uint64, len(words) + 1)


def _of_two(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    out = first * np.uint64(0x9E3779B97F4A7C15) + second
    out ^= out >> np.uint64(29)
    out *= np.uint64(0xBF58476D1CE4E5B9)
    return out ^ (out >> np.uint64(32))


def _often_met(counts: DataFrame, least: int, log2_bits: int) -> np.ndarray:
    """The bitmap of all hashes (``h``, ``c``) that are met ``least`` times."""
    often = counts.groupBy("h").agg(F.sum("c").alias("c")).filter(F.col("c") >= least)
    return bitmap(often.select(F.col("h").cast("long").alias("h")), "h", log2_bits)


def _counted(hashes: np.ndarray, counts: np.ndarray) -> Iterator[pa.RecordBatch]:
    low = hashes.astype(np.uint32).view(np.int32)  # a bitmap looks at no more
    columns = {"h": pa.array(low), "c": pa.array(counts.astype(np.int64))}
    found = pa.RecordBatch.from_pydict(columns)
    for k in range(0, len(hashes), _BATCH_ROWS):
        yield found.slice(k, _BATCH_ROWS)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, np.ndarray, list[bytes]]]:
    for batch in batches:
        columns = (batch.column(c) for c in ("lang", "tokens", "words"))
        for lang, tokens, words in zip(*columns, strict=True):
            yield lang.as_py(), np.frombuffer(tokens.as_buffer(), np.int32), words.as_py()


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for lang, tokens, words in _rows(batches):
        counts = np.bincount(tokens, minlength=len(words) + 1)[1:]
        yield from _counted(_hashes(lang, words)[1:], counts)


def _pairs(tokens: np.ndarray, often: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the pairs of words that are both met often, and the pairs as numbers."""
    is_often = often[tokens]
    at = np.flatnonzero(is_often[:-1] & is_often[1:])
    return at, (tokens[at].astype(np.int64) << 32) | tokens[at + 1]


def _often(lang: str, words: list[bytes], bits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    hashes = _hashes(lang, words)
    often = in_bitmap(bits, hashes)
    often[0] = False
    return hashes, often


def _pair_counts(words_met: np.ndarray):
    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, tokens, words in _rows(batches):
            hashes, often = _often(lang, words, words_met)
            pairs, counts = np.unique(_pairs(tokens, often)[1], return_counts=True)
            yield from _counted(_of_two(hashes[pairs >> 32], hashes[pairs & (2**32 - 1)]), counts)

    return over


def _linked(
    tokens: np.ndarray, hashes: np.ndarray, often: np.ndarray, pairs_met: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Of each place whether the pair that begins there is often met, and the pair's hash."""
    at, pairs = _pairs(tokens, often)
    linked, of_pair = np.zeros(len(tokens), bool), np.zeros(len(tokens), np.uint64)
    of_pair[at] = _of_two(hashes[pairs >> 32], hashes[pairs & (2**32 - 1)])
    linked[at] = in_bitmap(pairs_met, of_pair[at])
    return linked, of_pair


def _triples(
    tokens: np.ndarray, hashes: np.ndarray, linked: np.ndarray, of_pair: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Places of the triples both pairs of which are often met, and the triples' hashes."""
    at = np.flatnonzero(linked[:-1] & linked[1:])
    return at, _of_two(of_pair[at], hashes[tokens[at + 2]]) if len(at) else of_pair[at]


def _triple_counts(words_met: np.ndarray, pairs_met: np.ndarray):
    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, tokens, words in _rows(batches):
            hashes, often = _often(lang, words, words_met)
            _, found = _triples(tokens, hashes, *_linked(tokens, hashes, often, pairs_met))
            yield from _counted(*np.unique(found, return_counts=True))

    return over


def longest_grams(
    tokens: np.ndarray, often: np.ndarray, linked: np.ndarray, tripled: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Of every place its longest gram, as rows of ``LONGEST`` numbers filled up with 0; counts.

    A gram goes on as long as its pairs and triples are often met, and so in the same piece, up
    to ``LONGEST``. ``linked`` and ``tripled`` say that of the pair and triple at each place.
    """
    width = LONGEST - 1
    alone = often[tokens] & ~linked
    single = np.bincount(tokens[alone], minlength=len(often))
    ids = np.flatnonzero(single)
    grams, counts = [np.zeros((len(ids), LONGEST), np.int32)], [single[ids]]
    grams[0][:, 0] = ids
    at = np.flatnonzero(linked)
    if len(at):
        padded = np.concatenate([tripled, np.zeros(width, bool)])
        following = np.concatenate([tokens, np.zeros(LONGEST, np.int32)])
        goes_on = np.ones(len(at), bool)
        key = following[at].astype(np.int64)
        wide = np.zeros((len(at), LONGEST), np.int32)
        wide[:, 0] = following[at]
        for k in range(1, LONGEST):
            if k > 1:
                goes_on &= padded[at + k - 2]
            wide[:, k] = np.where(goes_on, following[at + k], 0)
            # ranks of the distinct grams so far keep the key within 64 bits
            key = np.unique((key << 32) | wide[:, k], return_inverse=True)[1]
        _, first, times = np.unique(key, return_index=True, return_counts=True)
        grams.append(wide[first])
        counts.append(times)
    return np.concatenate(grams), np.concatenate(counts)


def _edge_counts(words_met: np.ndarray, pairs_met: np.ndarray, triples_met: np.ndarray):
    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, tokens, words in _rows(batches):
            hashes, often = _often(lang, words, words_met)
            linked, of_pair = _linked(tokens, hashes, often, pairs_met)
            at, triples = _triples(tokens, hashes, linked, of_pair)
            tripled = np.zeros(len(tokens), bool)
            tripled[at] = in_bitmap(triples_met, triples)
            grams, counts = longest_grams(tokens, often, linked, tripled)
            for k in range(0, len(grams), 50_000):
                part = grams[k : k + 50_000]
                text = [
                    b" ".join([words[i - 1] for i in gram if i]).decode() for gram in part.tolist()
                ]
                yield pa.RecordBatch.from_pydict(
                    {
                        "lang": pa.array([lang] * len(part)),
                        "gram": pa.array(text),
                        "size": pa.array((part > 0).sum(axis=1), pa.int32()),
                        "c": pa.array(counts[k : k + 50_000], pa.int64()),
                    }
                )

    return over


def _words(gram: str, first: int | str, size: int | str) -> Column:
    """Words of a gram by place, joined by one space."""
    return F.expr(f"array_join(slice(split({gram}, ' '), {first}, {size}), ' ')")


def compacted(edges: DataFrame) -> DataFrame:
    """Maximal unary paths of the edges (lang, gram, c): lang, ``words`` and the weight ``c``.

    An edge leads from the node of its first four words to that of its last four. A node is
    passed through if it has one edge in and one out and both have the same weight, so that
    nothing begins or ends there; edges joined by such nodes are one path. Places on paths are
    found by pointer doubling, each round written, so a path of any length takes as many rounds
    as its length has binary digits. Edges on a cycle without a beginning stay by themselves.
    """
    node = LONGEST - 1
    marked = edges.select(
        "lang", "gram", "c", _words("gram", 1, str(node)).alias("from"),
        _words("gram", 2, str(node)).alias("to"),
    )
    into = marked.groupBy("lang", F.col("to").alias("node")).agg(
        F.count(F.lit(1)).alias("n_in"), F.first("gram").alias("before"), F.first("c").alias("c_in")
    )
    out = marked.groupBy("lang", F.col("from").alias("node")).agg(
        F.count(F.lit(1)).alias("n_out"), F.first("gram").alias("after"), F.first("c").alias("c_out")
    )
    through = into.join(out, ["lang", "node"]).filter(
        "n_in = 1 and n_out = 1 and c_in = c_out and before <> after"
    )
    links = through.select("lang", F.col("after").alias("gram"), "before")
    state = written(
        edges.join(links, ["lang", "gram"], "left").select(
            "lang", "gram", "c", F.coalesce("before", "gram").alias("head"),
            F.when(F.col("before").isNotNull(), 1).otherwise(0).cast("long").alias("steps"),
        ),
        "collocation-links",
    )
    total = state.filter("steps > 0").count()
    for _ in range(total.bit_length()):
        ahead = state.select(
            "lang", F.col("gram").alias("head"), F.col("head").alias("further"),
            F.col("steps").alias("more"),
        ).filter("more > 0")
        moved = state.join(ahead, ["lang", "head"], "left")
        state = written(
            moved.select(
                "lang", "gram", "c", F.coalesce("further", "head").alias("head"),
                (F.col("steps") + F.coalesce("more", F.lit(0))).alias("steps"),
                F.col("more").isNotNull().alias("moves"),
            ),
            "collocation-links",
        )
        settled = state.filter("moves").isEmpty()
        state = state.drop("moves")
        if settled:
            break
    # the head of a path has no steps to go; heads of edges on a cycle are on it too
    heads = state.filter("steps = 0").select("lang", F.col("gram").alias("head"), F.lit(True).alias("is_head"))
    placed = state.join(heads, ["lang", "head"], "left")
    path = F.when(F.col("is_head"), F.col("head")).otherwise(F.col("gram"))
    steps = F.when(F.col("is_head"), F.col("steps")).otherwise(0)
    last = F.element_at(F.split("gram", " "), -1)
    return (
        placed.select("lang", path.alias("path"), "c", F.struct(steps.alias("at"), last.alias("word")).alias("x"))
        .groupBy("lang", "path")
        .agg(F.first("c").alias("c"), F.sort_array(F.collect_list("x")).alias("x"))
        .select(
            "lang", "c",
            F.concat(
                F.slice(F.split("path", " "), 1, node), F.transform("x", lambda x: x["word"])
            ).alias("words"),
        )
    )


def phrase_graph(
    docs: DataFrame, least: int = 100, log2_bits: int = 26
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Totals (lang, n), compacted paths (lang, words, c) and shorter ends (lang, gram, c).

    1. Texts become numbers of words in chunks of 4 MB, written once with their words.
    2. Words, then pairs of such words, then triples of such pairs, met less than ``least``
       times are found by hashes of 32 bits; what is passed to the tasks are bitmaps of
       ``2 ** log2_bits`` bits (``log2_bits`` is 32 at most), whatever the corpus. No phrase
       that is met ``least`` times holds such a word, pair or triple, so pieces end there too;
       words that share a hash, and hashes that share a slot, only leave more to count.
    3. Every place gives its longest gram: five words, an edge between the nodes of four words
       that overlap in it, or fewer at the end of a piece. Equal grams are added up, by their
       words, first within a chunk.
    4. Paths of edges without a branch are compacted.
    """
    lang = F.coalesce(F.col("lang").cast("string"), F.lit(NO_LANG)).alias("lang")
    texts = docs.select(lang, F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text"))
    with settings_during(docs.sparkSession, _SETTINGS):
        chunks = written(texts.mapInArrow(_chunks, _CHUNK), "collocation-chunks", **_PAGES)
        totals = chunks.groupBy("lang").agg(F.sum("n_words").alias("n"))
        counted = "h int, c long"
        words_met = _often_met(chunks.mapInArrow(_word_counts, counted), least, log2_bits)
        pairs = chunks.mapInArrow(_pair_counts(words_met), counted)
        pairs_met = _often_met(pairs, least, log2_bits)
        triples = chunks.mapInArrow(_triple_counts(words_met, pairs_met), counted)
        triples_met = _often_met(triples, least, log2_bits)
        grams = chunks.mapInArrow(
            _edge_counts(words_met, pairs_met, triples_met), "lang string, gram string, size int, c long"
        )
        summed = written(
            grams.groupBy("lang", "gram", "size").agg(F.sum("c").alias("c")), "collocation-grams"
        )
        edges = summed.filter(F.col("size") == LONGEST).drop("size")
        paths = written(compacted(edges), "collocation-paths")
    return totals, paths, summed.filter(F.col("size") < LONGEST).drop("size")


def gram_counts(paths: DataFrame, ends: DataFrame, least: int = 100) -> DataFrame:
    """lang, gram, size and f of all grams of up to five words met ``least`` times or more.

    A gram occurs as often as it begins a longest gram: the flow through its place on the
    paths, and what ends there. Along a path all five-word edges have the path's weight.
    """
    starts = paths.select(
        "lang", "c", "words", F.explode(F.expr(f"sequence(1, size(words) - {LONGEST - 1})")).alias("at")
    ).select("lang", "c", F.slice("words", F.col("at"), LONGEST).alias("w"))
    whole = ends.select("lang", "c", F.split("gram", " ").alias("w"))
    prefixes = starts.union(whole).select(
        "lang", "c", "w", F.explode(F.expr("sequence(1, size(w))")).alias("size")
    )
    gram = F.array_join(F.slice("w", 1, F.col("size")), " ").alias("gram")
    return (
        prefixes.select("lang", gram, "size", "c")
        .groupBy("lang", "gram", "size")
        .agg(F.sum("c").alias("f"))
        .filter(F.col("f") >= least)
    )


def with_score(cuts: DataFrame) -> DataFrame:
    """``score``: floor(1000 * a * n / (l * r)) in decimals, as the products pass 64 bits."""
    wide = {c: F.col(c).cast("decimal(19,0)") for c in ("a", "n", "l", "r")}
    above = (F.lit(1000).cast("decimal(4,0)") * wide["a"] * wide["n"]).cast("decimal(38,0)")
    below = (wide["l"] * wide["r"]).cast("decimal(38,0)")
    return (
        cuts.withColumns({"__above": above, "__below": below})
        .withColumn("score", F.expr("__above div __below").cast("long"))
        .drop("__above", "__below")
    )


def collocations(
    docs: DataFrame, least: int = 100, top: int = 2000, log2_bits: int = 26
) -> DataFrame:
    """The first ``top`` phrases of each language by their weakest cut.

    Texts (A-Z in lower case) fall into pieces at ``.,;:!?`` and line ends, pieces into words at
    spaces and tabs. Phrases of two to five words that occur ``least`` times within pieces,
    overlaps included, are candidates. A cut into two parts scores
    ``floor(1000 * a * n / (l * r))`` with the counts of the phrase, of all words and of both
    parts; the lowest cut counts, the first of equal ones. A candidate inside a longer one that
    occurs as often is dropped.

    Returns lang, rank (from 1), phrase, a, l, r, n and score, by score and a descending, then
    phrase ascending (by bytes). See ``phrase_graph`` and ``gram_counts`` for how phrases are
    counted; counts are exact whatever hashes collide. Phrases of a language are ranked in
    parts first, so that one task sees only the first ``top`` of each part.

    Null languages are ``und``; null and empty texts have no words; ids and other columns are not
    looked at; repeated rows count again. An empty table, or one without frequent phrases,
    gives no rows.
    """
    totals, paths, ends = phrase_graph(docs, least, log2_bits)
    with settings_during(docs.sparkSession, _SETTINGS):
        counts = written(gram_counts(paths, ends, least), "collocation-counts")
    phrases = counts.filter("size > 1")
    inner = phrases.select(
        "lang", "f", "gram", "size",
        F.explode(F.expr("sequence(2, size - 1)")).alias("k"),
    ).filter("k < size and k > 1").select(
        "lang", "f", "gram", "k", F.explode(F.expr("sequence(1, size - k + 1)")).alias("at")
    ).select(
        "lang", _words("gram", "at", "k").alias("gram"), "f"
    )
    longest = inner.groupBy("lang", "gram").agg(F.max("f").alias("f_longer"))
    kept = phrases.join(longest, ["lang", "gram"], "left").filter(
        "f_longer is null or f_longer < f"
    )
    cuts = kept.select(
        "lang", "gram", F.col("f").alias("a"), "size",
        F.explode(F.expr("sequence(1, size - 1)")).alias("k"),
    ).select(
        "lang", "gram", "a", "k", _words("gram", 1, "k").alias("first"),
        _words("gram", "k + 1", "size - k").alias("rest"),
    )
    left = counts.select("lang", F.col("gram").alias("first"), F.col("f").alias("l"))
    right = counts.select("lang", F.col("gram").alias("rest"), F.col("f").alias("r"))
    joined = cuts.join(left, ["lang", "first"]).join(right, ["lang", "rest"]).join(totals, "lang")
    scored = (
        with_score(joined)
        .groupBy("lang", "gram", "a", "n")
        .agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
        .select("lang", F.col("gram").alias("phrase"), "a", "cut.l", "cut.r", "n", "cut.score")
    )
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    part = F.pmod(F.xxhash64("phrase"), F.lit(_RANK_PARTS))
    in_part = F.row_number().over(Window.partitionBy("lang", part).orderBy(*order))
    first = scored.withColumn("__place", in_part).filter(F.col("__place") <= top).drop("__place")
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")
    return (
        first.withColumn("rank", rank)
        .filter(F.col("rank") <= top)
        .select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
    )
