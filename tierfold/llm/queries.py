"""One thin query for each operator, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierfold.llm.archive import archived_pages
from tierfold.llm.collocations import collocations
from tierfold.llm.common import table
from tierfold.llm.decontaminate import contaminated_passages
from tierfold.llm.disclosure import personal_data
from tierfold.llm.likelihood import lattice_scores
from tierfold.llm.line_frequency import line_verdicts
from tierfold.llm.merkle import manifest
from tierfold.llm.nbest import encoded
from tierfold.llm.phrases import without_repeats
from tierfold.llm.quotes import reply_ordered
from tierfold.llm.shards import byte_shards
from tierfold.llm.simhash import fingerprint_hex, near_duplicates
from tierfold.llm.tokens import token_counts


def op1_quotation_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reply_ordered(table(spark, sf_dir, "conversations"))


def op2_lattice_likelihood(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lattice_scores(table(spark, sf_dir, "documents"))


def op3_content_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archived_pages(table(spark, sf_dir, "pages")).reconstructed(contents=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def op4_line_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_verdicts(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "words_left",
    )


def op5_qgram_lemma(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return contaminated_passages(docs, items)


def op6_byte_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_shards(table(spark, sf_dir, "documents"), 40).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op7_simhash_tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents")).select(
        "doc_id", fingerprint_hex(F.col("fp")).alias("fingerprint"), "component_id"
    )


def op8_disclosure(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data(table(spark, sf_dir, "documents"))


def op9_nbest_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encoded(table(spark, sf_dir, "documents"), 4)


def op10_repeated_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return without_repeats(table(spark, sf_dir, "documents"), 20)


def op11_word_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"), least=100, top=2000)


def op12_array_merging(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"), limit=1024)


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["doc_id", "source", "lang", "n_chars", "text"]
    seventh = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    one_more = {"n_chars": F.col("n_chars").cast("decimal(20,0)") + 1}
    return manifest(table(spark, sf_dir, "documents"), columns, seventh, one_more).proofs.select(
        "doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quotation_links": op1_quotation_links,
    "op2_lattice_likelihood": op2_lattice_likelihood,
    "op3_content_archive": op3_content_archive,
    "op4_line_frequency": op4_line_frequency,
    "op5_qgram_lemma": op5_qgram_lemma,
    "op6_byte_shards": op6_byte_shards,
    "op7_simhash_tiles": op7_simhash_tiles,
    "op8_disclosure": op8_disclosure,
    "op9_nbest_pieces": op9_nbest_pieces,
    "op10_repeated_phrases": op10_repeated_phrases,
    "op11_word_graph": op11_word_graph,
    "op12_array_merging": op12_array_merging,
    "op13_merkle_manifest": op13_merkle_manifest,
}

ORACLE_SQL: dict[str, str] = {}
