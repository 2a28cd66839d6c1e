"""From raw documents to training pieces, in five stages.

Every stage reads what the one before it kept, decides on all of it, and is written to the
shared folder before the next begins, so a lost executor repeats no finished stage.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierfold.llm.common import table, written
from tierfold.llm.decontaminate import without_contaminated
from tierfold.llm.disclosure import sanitised
from tierfold.llm.line_frequency import apply_line_rules
from tierfold.llm.nbest import encoded
from tierfold.llm.simhash import deduplicated


def _counted(docs: DataFrame) -> DataFrame:
    return docs.withColumn("n_chars", F.length("text").cast("long"))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the rules or are depleted go; frequent lines leave the others."""
    return _counted(apply_line_rules(docs))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every SimHash group stays: three-word shingles, at most two bits apart."""
    return deduplicated(docs, radius=2, shingle=3)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of the benchmark go."""
    return without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def sanitise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data, and terms that disclose it, leave the texts; all documents stay."""
    return _counted(sanitised(docs))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The four best segmentations of every text."""
    return encoded(docs, 4)


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminate),
    ("sanitise", sanitise),
    ("encode", encode),
]

#: SQL can express neither SimHash components nor the segmentations.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
