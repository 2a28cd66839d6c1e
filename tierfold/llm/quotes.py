"""Quotation linking and reply-ordered conversations. [native]"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tierfold.llm.common import SPACE, ascii_lower, written
from tierfold.llm.shards import with_prefix_sums

MARKS = r"^[\x20\t]*+(?:>[\x20\t]*+)++"
ATTRIBUTION = r"(?i)^.*\b(?:wrote|a écrit|schrieb|escribió)\b.*:\s*$"
TURN_BLOCK = 4096  # turns of one conversation that are looked through together
NO_TURN = -(2**62)  # where a turn is null: before all others
_PASSAGE = "array<struct<level:int,text:string>>"


def quote_lines(text: Column) -> Column:
    """Level (number of quote marks), content without marks, and the line as it is."""

    def parsed(line: Column) -> Column:
        marks = F.regexp_extract(line, MARKS, 0)
        level = F.length(marks) - F.length(F.replace(marks, F.lit(">"), F.lit("")))
        return F.struct(
            level.alias("level"),
            line.substr(F.length(marks) + 1, F.length(line)).alias("content"),
            line.alias("line"),
        )

    return F.transform(F.split(text, "\n", -1), parsed)


def normalised(passage: Column) -> Column:
    return F.trim(F.regexp_replace(ascii_lower(passage), SPACE, " "))


def _passages(lines: Column) -> Column:
    """Normalised passages: runs of lines of one level that are not blank, and single lines."""
    levels = F.array_distinct(F.transform(lines, lambda x: x["level"]))

    def of_level(level: Column) -> Column:
        own = F.array_join(
            F.transform(lines, lambda x: F.when(x["level"] == level, x["content"]).otherwise("")),
            "\n",
        )
        runs = F.split(own, r"\n[\x20\t\r]*(?=\n)", -1)

        parts = F.concat(runs, F.split(own, "\n", -1))
        return F.transform(
            parts, lambda x: F.struct(level.alias("level"), normalised(x).alias("text"))
        )

    every = F.array_distinct(F.flatten(F.transform(levels, of_level)))
    return F.filter(every, lambda x: x["text"] != "").cast(_PASSAGE)


def _body(lines: Column) -> Column:
    """Lines without quote marks, without a line that introduces a quote."""

    def stays(line: Column, i: Column) -> Column:
        after = F.get(lines, i + 1)["level"]
        introduces = line["line"].rlike(ATTRIBUTION) & (F.coalesce(after, F.lit(0)) > 0)
        return (line["level"] == 0) & ~introduces

    kept = F.transform(F.filter(lines, stays), lambda x: x["line"])
    return F.regexp_replace(F.array_join(kept, "\n"), r"^\n+|\n+$", "")


def latest_before(own: DataFrame, asked: DataFrame) -> DataFrame:
    """For each asked (conv, hash, turn) the latest earlier turn with that hash of its own.

    Turns are looked through in blocks: first within a block, then from the last own turn of
    each earlier block, so that a passage found in very many turns of one conversation is spread
    over many tasks. No pairs of turns are made.
    """
    events = (
        own.select("conv", "hash", "turn", F.lit(True).alias("own"), F.lit(False).alias("asked"))
        .union(asked.select("conv", "hash", "turn", F.lit(False), F.lit(True)))
        .groupBy("conv", "hash", "turn")
        .agg(F.max("own").alias("own"), F.max("asked").alias("asked"))
        .withColumn("block", F.floor(F.col("turn") / TURN_BLOCK))
    )
    own_turn = F.when(F.col("own"), F.col("turn"))
    inside = Window.partitionBy("conv", "hash", "block").orderBy("turn").rowsBetween(
        Window.unboundedPreceding, -1
    )
    across = Window.partitionBy("conv", "hash").orderBy("block").rowsBetween(
        Window.unboundedPreceding, -1
    )
    blocks = (
        events.groupBy("conv", "hash", "block").agg(F.max(own_turn).alias("last"))
        .select("conv", "hash", "block", F.last("last", ignorenulls=True).over(across).alias("old"))
    )
    near = events.withColumn("near", F.last(own_turn, ignorenulls=True).over(inside)).filter("asked")
    return (
        near.join(blocks, ["conv", "hash", "block"])
        .select("conv", "hash", "turn", F.coalesce("near", "old").alias("found"))
        .filter("found is not null")
    )


def _roots(replies: DataFrame) -> DataFrame:
    """``root`` of every (conv, turn) that answers another: the first of its chain of answers.

    Every round looks up the answer's answer, so a chain of n takes log2(n) rounds; each round
    is written to the shared folder.
    """
    now = written(replies.select("conv", "turn", F.col("reply").alias("root")), "reply-roots")
    while True:
        above = now.select("conv", F.col("turn").alias("root"), F.col("root").alias("higher"))
        after = written(
            now.join(above, ["conv", "root"], "left").select(
                "conv", "turn", F.coalesce("higher", "root").alias("root"),
                F.col("higher").isNotNull().alias("moved"),
            ),
            "reply-roots",
        )
        now = after.drop("moved")
        if after.filter("moved").isEmpty():
            return now


def reply_ordered(conversations: DataFrame) -> DataFrame:
    """Messages (conv_id, turn, role, text) without their quotes, in the order of replies.

    A line with n quote marks in front is quoted text of level n. Quoted passages (runs of
    lines of a level, and single lines, in lower case with single spaces, by 64-bit hash) are
    joined to the latest earlier message of the conversation that has the passage as text of
    its own. A message answers the one that most characters of its first-level passages come
    from, of equal ones the latest; messages that answer each other form a thread, which begins
    at ``thread`` (a turn). ``place`` numbers the messages of a conversation by thread, then
    turn.

    Returns conv_id, turn, role, body (text without quoted lines and the line that introduces
    them), quote_level (deepest), quoted_lines, linked_passages, reply_to (a turn or null),
    thread and place. Null and empty texts have an empty body; a null turn stands before all
    others, null conv_ids are one conversation; messages that share a turn are one place to
    answer and stand side by side; an empty table gives no rows. Other columns are not looked at.
    """
    lines = quote_lines(F.coalesce(F.col("text"), F.lit("")))
    messages = written(
        conversations.select(
            F.monotonically_increasing_id().alias("row"), "conv_id", "turn", "role",
            F.coalesce(F.xxhash64("conv_id"), F.lit(0)).alias("conv"),
            F.coalesce("turn", F.lit(NO_TURN)).alias("at"), lines.alias("lines"),
        )
        .select(
            "row", "conv_id", "turn", "role", "conv", "at", _body(F.col("lines")).alias("body"),
            F.array_max(F.transform("lines", lambda x: x["level"])).alias("quote_level"),
            F.size(F.filter("lines", lambda x: x["level"] > 0)).alias("quoted_lines"),
            _passages(F.col("lines")).alias("passages"),
        ),
        "quote-messages",
    )
    passages = messages.select(
        "row", "conv", F.col("at").alias("turn"), F.explode("passages").alias("p")
    ).select(
        "row", "conv", "turn", "p.level", F.length("p.text").alias("chars"),
        F.xxhash64("p.text").alias("hash"),
    )
    asked = written(passages.filter("level > 0"), "quote-asked")
    own = passages.filter("level = 0").join(
        asked.select("conv", "hash").distinct(), ["conv", "hash"], "left_semi"
    )
    links = asked.join(latest_before(own, asked), ["conv", "hash", "turn"])
    counted = links.groupBy("row").agg(F.count(F.lit(1)).alias("linked_passages"))
    best = (
        links.filter("level = 1").groupBy("row", "conv", "turn", "found")
        .agg(F.sum("chars").alias("chars"))
        .groupBy("row", "conv", "turn")
        .agg(F.max(F.struct("chars", "found"))["found"].alias("reply"))
    )
    best = written(best, "quote-replies")
    replies = best.groupBy("conv", "turn").agg(F.max("reply").alias("reply"))
    roots = _roots(replies).withColumnRenamed("turn", "at")
    placed = (
        messages.drop("passages")
        .join(counted, "row", "left").join(best.select("row", "reply"), "row", "left")
        .join(roots, ["conv", "at"], "left")
        .withColumn("root", F.coalesce("root", "at"))
    )
    keys = placed.select("row", "conv", "root", "at", F.lit(1).cast("long").alias("one"))
    ordered, _ = with_prefix_sums(keys, ["conv", "root", "at", "row"], "one")
    ordered = written(ordered.select("row", "conv", "global_row"), "quote-order")
    first = ordered.groupBy("conv").agg(F.min("global_row").alias("first"))
    places = ordered.join(first, "conv").select(
        "row", (F.col("global_row") - F.col("first")).alias("place")
    )

    def turn(column: str) -> Column:
        return F.when(F.col(column) != NO_TURN, F.col(column))

    return placed.join(places, "row").select(
        "conv_id", "turn", "role", "body", "quote_level", "quoted_lines",
        F.coalesce("linked_passages", F.lit(0)).cast("long").alias("linked_passages"),
        turn("reply").alias("reply_to"), turn("root").alias("thread"), "place",
    )
