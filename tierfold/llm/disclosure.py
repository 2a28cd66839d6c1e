"""Personal data, and the terms around it that give it away. [native]"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierfold.llm.common import SPACE, WORD, ascii_lower, keeps_columns, written

# Loops are possessive where nothing can follow that they could give back, which keeps the
# matching free of recursion and of repeated tries on long runs. A match may begin inside a
# run of its own characters only where another match ended. Numbers begin with their digit
# and look back after it, as most places of a text have none and are passed at once.
EMAIL = (
    r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
)
IP = r"[0-9](?<![0-9][0-9])[0-9]*+\.[0-9]++\.[0-9]++\.[0-9]++"
IP_PART = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
# whole runs of digits with single separators, of 12 to 19 digits
CARD = (
    r"[0-9](?<![0-9][0-9])(?<![0-9][\x20-][0-9])(?:[\x20-]?[0-9]){11,18}(?![\x20-]?[0-9])"
)
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
KINDS = ("email", "ip", "card", "phone", "term")
CONTEXT_WORDS = 10
CONTEXT_CHARS = (160, 2_560, 40_960)  # looked at in turn until they hold that many words
_SPAN = "struct<start:int,end:int,value:string>"


def spans_of(text: Column, pattern: str) -> Column:
    """Start, end (code points, exclusive) and text of the leftmost non-overlapping matches.

    Matches and the pieces between them give the places by their lengths.
    """
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    between = F.slice(F.split(text, pattern, -1), 1, F.size(found))
    start = F.expr(f"cast(named_struct('at', 0, 'out', array()) as struct<at:int,out:array<{_SPAN}>>)")

    def add(acc: Column, x: Column) -> Column:
        first = acc["at"] + x["before"]
        end = first + F.length(x["value"])
        span = F.struct(first.alias("start"), end.alias("end"), x["value"].alias("value"))
        return F.struct(end.alias("at"), F.concat(acc["out"], F.array(span)).alias("out"))

    pairs = F.zip_with(
        found, between, lambda v, b: F.struct(v.alias("value"), F.length(b).alias("before"))
    )
    return F.when(F.size(found) == 0, F.expr(f"cast(array() as array<{_SPAN}>)")).otherwise(
        F.aggregate(pairs, start, add, lambda acc: acc["out"])
    )


def passes_luhn(number: Column) -> Column:
    """Whether the digits of a number with separators pass the Luhn check."""
    digits = F.reverse(F.regexp_replace(number, "[^0-9]", ""))
    total = F.aggregate(
        F.sequence(F.lit(1), F.length(digits)),
        F.lit(0),
        lambda s, i: s
        + F.when(i % 2 == 1, digits.substr(i, F.lit(1)).cast("int")).otherwise(
            F.element_at(
                F.array(*map(F.lit, (0, 2, 4, 6, 8, 1, 3, 5, 7, 9))),
                digits.substr(i, F.lit(1)).cast("int") + 1,
            )
        ),
    )
    return total % 10 == 0


def base_spans(text: Column) -> dict[str, Column]:
    """Spans of each base kind that pass its check."""
    nothing = F.expr(f"cast(array() as array<{_SPAN}>)")

    def digits(x: Column) -> Column:
        return F.length(F.regexp_replace(x["value"], "[^0-9]", ""))

    return {
        "email": F.when(F.contains(text, F.lit("@")), spans_of(text, EMAIL)).otherwise(nothing),
        "ip": F.filter(
            spans_of(text, IP), lambda x: x["value"].rlike(rf"^{IP_PART}(?:\.{IP_PART}){{3}}$")
        ),
        "card": F.filter(spans_of(text, CARD), lambda x: passes_luhn(x["value"])),
        "phone": F.when(
            F.contains(text, F.lit("+")),
            F.filter(spans_of(text, PHONE), lambda x: digits(x).between(9, 15)),
        ).otherwise(nothing),
    }


def _around(text: Column, span: Column) -> Column:
    """The ten words on either side of a span (fewer at the ends of the text), with their places.

    Only as much of the text is split as is needed to find them; where the last of
    ``CONTEXT_CHARS`` is too little, as between very long words, all of that side.
    """

    def placed(part: Column, at: Column) -> Column:
        return F.transform(
            spans_of(part, WORD),
            lambda w: F.struct(
                (w["start"] + at).alias("start"), (w["end"] + at).alias("end"),
                ascii_lower(w["value"]).alias("term"),
            ),
        )

    def once(value: Column, use: Callable[[Column], Column]) -> Column:
        """``use`` of a value that is computed once, however often ``use`` names it."""
        return F.transform(F.array(value), use)[0]

    # a word cut by the edge of the part, or one that touches the span, is not a whole word
    def before(left_at: Column) -> Column:
        left = text.substr(left_at + 1, span["start"] - left_at)
        whole = F.filter(
            placed(left, left_at),
            lambda w: ((w["start"] > left_at) | (left_at == 0)) & (w["end"] < span["start"]),
        )
        first = lambda w: F.greatest(F.size(w) - CONTEXT_WORDS + 1, F.lit(1))
        return once(whole, lambda w: F.slice(w, first(w), CONTEXT_WORDS))

    def after(right_to: Column) -> Column:
        right = text.substr(span["end"] + 1, right_to - span["end"])
        whole = F.filter(
            placed(right, span["end"]),
            lambda w: (w["start"] > span["end"])
            & ((w["end"] < right_to) | (right_to == F.length(text))),
        )
        return F.slice(whole, 1, CONTEXT_WORDS)

    near_left, near_right = before(F.lit(0)), after(F.length(text))
    for chars in reversed(CONTEXT_CHARS):
        left_at = F.greatest(span["start"] - chars, F.lit(0))
        right_to = F.least(span["end"] + chars, F.length(text))
        to_left = lambda w, at=left_at: F.when((at == 0) | (F.size(w) == CONTEXT_WORDS), w)
        to_right = lambda w, at=right_to: F.when(
            (at == F.length(text)) | (F.size(w) == CONTEXT_WORDS), w
        )
        near_left = F.coalesce(once(before(left_at), lambda w: to_left(w)), near_left)
        near_right = F.coalesce(once(after(right_to), lambda w: to_right(w)), near_right)
    return F.concat(near_left, near_right)


def mentions(docs: DataFrame, keep: list[str]) -> DataFrame:
    """``keep`` of every row with its base spans, a row number, and the words around each span."""
    text = F.coalesce(F.col("text"), F.lit(""))
    plain = docs.select(*keep, text.alias("__text"), F.xxhash64("text").alias("__content"))
    spans = plain.withColumns({f"__{k}": v for k, v in base_spans(F.col("__text")).items()})

    def ranked(k: int, kind: str) -> Column:
        return F.transform(
            f"__{kind}",
            lambda x: F.struct(
                x["start"].alias("start"), F.lit(k).alias("rank"), x["end"].alias("end"),
                F.concat(F.lit(f"{kind} "), ascii_lower(x["value"])).alias("entity"),
            ),
        )

    kinds = [ranked(k, kind) for k, kind in enumerate(KINDS[:4])]
    return (
        spans.withColumn("__spans", F.array_sort(F.concat(*kinds)))
        .withColumn(
            "__near",
            F.transform(
                "__spans",
                lambda x: F.struct(
                    x["entity"].alias("entity"), _around(F.col("__text"), x).alias("words")
                ),
            ),
        )
        .withColumn("__row", F.monotonically_increasing_id())
        .drop(*(f"__{k}" for k in KINDS[:4]))
    )


def disclosing_terms(
    found: DataFrame, docs: DataFrame, threshold: float = 0.8, min_texts: int = 2
) -> DataFrame:
    """(entity, term) where the term gives away at least ``threshold`` of the entity.

    Over all rows: df(e), df(t) rows with the entity or the term, c(e, t) rows with the term
    near the entity. The share given away is PMI(e, t) over the entity's own information,
    log(n c / (df(e) df(t))) / log(n / df(e)); 1 if the term occurs near that entity alone. A
    pair must be seen in ``min_texts`` different texts, or its term must also stand in another
    text than the pair: an entity of a single text takes part with the terms that the rest of
    the corpus supports, its share falling as they become common. A term of one text, however
    often that is copied, makes no evidence. Every count is summed partly before its shuffle.
    """
    near = found.select("__row", "__content", F.explode("__near").alias("x")).select(
        "__row", "__content", "x.entity", F.explode("x.words.term").alias("term")
    )
    pairs = (
        near.distinct()
        .groupBy("entity", "term", "__content").agg(F.count(F.lit(1)).alias("n"))
        .groupBy("entity", "term")
        .agg(F.sum("n").alias("c"), F.count(F.lit(1)).alias("texts"))
    )
    entities = (
        found.select(F.explode(F.array_distinct("__spans.entity")).alias("entity"))
        .groupBy("entity").agg(F.count(F.lit(1)).alias("of_entity"))
    )
    words = F.split(ascii_lower(F.col("text")), SPACE)
    terms = (
        docs.select(
            F.explode(F.array_distinct(words)).alias("term"), F.xxhash64("text").alias("content")
        )
        .groupBy("term").agg(
            F.count(F.lit(1)).alias("of_term"),
            (F.min("content") < F.max("content")).alias("elsewhere"),
        )
    )
    n = docs.count()
    known = F.log(n / F.col("of_entity"))
    pmi = F.log(F.col("c") * n / (F.col("of_entity") * F.col("of_term")))
    return (
        pairs.join(entities, "entity").join(terms, "term")
        .filter((known > 0) & ((F.col("texts") >= min_texts) | F.col("elsewhere")))
        .withColumn("share", pmi / known)
        .filter(F.col("share") >= threshold)
        .select("entity", "term", "share")
    )


def with_term_spans(
    found: DataFrame, docs: DataFrame, threshold: float = 0.8, min_texts: int = 2
) -> DataFrame:
    """``found`` with ``__all``: base spans and the disclosing terms near them, by place.

    A term span that touches a base span is left to the base span. ``share`` is 1 for base
    spans, and for a term the largest share it gives away of an entity near it.
    """
    given = disclosing_terms(found, docs, threshold, min_texts)
    near = found.select("__row", F.explode("__near").alias("x")).select(
        "__row", "x.entity", F.explode("x.words").alias("w")
    )
    terms = (
        near.select("__row", "entity", "w.*").join(given, ["entity", "term"])
        .groupBy("__row", "start", "end").agg(F.max("share").alias("share"))
        .groupBy("__row")  # at most the words around the spans of one row
        .agg(
            F.collect_list(
                F.struct("start", F.lit(len(KINDS) - 1).alias("rank"), "end", "share")
            ).alias("__terms")
        )
    )
    kind = "array<struct<start:int,rank:int,end:int,share:double>>"
    base = F.transform(
        "__spans",
        lambda x: F.struct(x["start"], x["rank"], x["end"], F.lit(1.0).alias("share")),
    ).cast(kind)
    free = F.filter(
        F.coalesce(F.col("__terms").cast(kind), F.expr(f"cast(array() as {kind})")),
        lambda t: ~F.exists(
            "__spans", lambda x: (x["start"] < t["end"]) & (t["start"] < x["end"])
        ),
    )
    return found.join(terms, "__row", "left").withColumn("__all", F.array_sort(F.concat(base, free)))


def span_list(spans: Column) -> Column:
    """kind:start:end by start, then kind, joined by commas."""
    kinds = F.array(*map(F.lit, KINDS))
    return F.array_join(
        F.transform(
            spans,
            lambda x: F.concat_ws(":", F.element_at(kinds, x["rank"] + 1), x["start"], x["end"]),
        ),
        ",",
    )


def personal_data(docs: DataFrame, threshold: float = 0.8, min_texts: int = 2) -> DataFrame:
    """Base spans of every row of ``docs`` (doc_id, text) and the terms that disclose them.

    Returns doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans (base and ``term``) and
    n_term. A null or empty text has no spans; rows repeating an id or a text get the same; an
    empty table gives no rows; other columns are not looked at.
    """
    found = written(mentions(docs, ["doc_id"]).drop("__text"), "pii-mentions")

    def count(k: int) -> Column:
        return F.size(F.filter("__all", lambda x: x["rank"] == k)).cast("long")

    return with_term_spans(found, docs, threshold, min_texts).select(
        "doc_id",
        *(count(k).alias(f"n_{kind}") for k, kind in enumerate(KINDS[:4])),
        F.sha2(span_list(F.filter("__all", lambda x: x["rank"] < 4)), 256).alias("base_sha256"),
        span_list(F.col("__all")).alias("spans"),
        count(4).alias("n_term"),
    )


@keeps_columns
def sanitised(
    docs: DataFrame, threshold: float = 0.8, remove_from: float = 1.0, min_texts: int = 2
) -> DataFrame:
    """``docs`` with personal data and disclosing terms taken out of the text.

    Base spans become ``[EMAIL]``, ``[IP]``, ``[CARD]`` or ``[PHONE]``. A term that gives away
    at least ``remove_from`` of an entity is removed, one above the threshold is generalised
    to ``[TERM]``. Where spans overlap the first one's mark stands for all. Rows without
    personal data pass unchanged and are not shuffled, null and empty texts among them; columns
    and their order stay. An empty table gives an empty one.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    some = F.lit(False)
    for spans in base_spans(text).values():
        some = some | (F.size(spans) > 0)
    found = written(mentions(docs.filter(some), docs.columns), "pii-mentions")
    marks = F.array(*(F.lit(f"[{k.upper()}]") for k in KINDS))
    start = F.expr("named_struct('at', 0, 'out', '')")

    def add(acc: Column, x: Column) -> Column:
        gone = (x["rank"] == 4) & (x["share"] >= remove_from)
        mark = F.when(gone, "").otherwise(F.element_at(marks, x["rank"] + 1))
        piece = F.col("__text").substr(acc["at"] + 1, x["start"] - acc["at"])
        inside = x["start"] < acc["at"]
        return F.struct(
            F.greatest(acc["at"], x["end"]).alias("at"),
            F.when(inside, acc["out"]).otherwise(F.concat(acc["out"], piece, mark)).alias("out"),
        )

    def close(acc: Column) -> Column:
        return F.concat(acc["out"], F.col("__text").substr(acc["at"] + 1, F.length("__text")))

    changed = with_term_spans(found, docs, threshold, min_texts).withColumn(
        "text", F.aggregate("__all", start, add, close)
    )
    return docs.filter(~some).union(changed.select(*docs.columns))
