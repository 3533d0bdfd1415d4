"""Registered queries of this subpackage: (spark, sf_dir) -> DataFrame over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opsflow.llm import (
    content_chunks, conversation_repair, exact_dedup, near_dedup, pareto_mix, piece_lattice, quality_rules, ranked_search, secret_scan,
    token_count, toxicity, warc, winnow,
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_pareto_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that a mix by target weights takes of each document."""
    return pareto_mix.mix(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken", "source", "copies", "expected")


def tokenizer_file(name: str) -> str:
    """Path of a public tokenizer's file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Byte-level BPE token counts, long texts spliced from overlapping chunks."""
    with open(tokenizer_file("byte_bpe_50k.json"), encoding="utf-8") as f:
        return token_count.token_counts(table(spark, sf_dir, "documents"), f.read())


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of each document by its nearest labelled examples."""
    return toxicity.score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_content_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Passages that repeat across documents, by content-defined chunks."""
    return content_chunks.repeated_passages(table(spark, sf_dir, "documents"))


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secret candidates of each document, told apart by corpus-wide ownership."""
    return secret_scan.digest_columns(secret_scan.scan(table(spark, sf_dir, "documents")))


def op6_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Winnowed fingerprints of each document and of its edited text."""
    return winnow.fingerprints(table(spark, sf_dir, "documents"))


def op7_warc_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages written to WARC archives and read back."""
    return warc.archive_round_trip(table(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Copies of equal text, by a two-pass Bloom filter."""
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents"))


def op9_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of near copies, by a multi-index Hamming join of MinHash signatures."""
    return near_dedup.near_groups(table(spark, sf_dir, "documents")).drop("th")


def op10_piece_lattice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Piece ids of each document, decoded again."""
    return piece_lattice.encode(table(spark, sf_dir, "documents"), piece_lattice.piece_table(tokenizer_file("piece_bpe_32k.model")))


def op11_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality counts of each document and the verdict of rules with bounded false rejection."""
    judged = quality_rules.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
                         F.array_join("failed", ",").alias("failed_rules"))


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 50 best documents of each benchmark item, by the Best Position Algorithm."""
    return ranked_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("iid")


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cheapest repair of each damaged conversation."""
    turns = table(spark, sf_dir, "conversations")
    return conversation_repair.repair(conversation_repair.damaged(turns), turns)


QUERIES = {f.__name__: f for f in (
    op1_pareto_mix, op2_token_counts, op3_toxicity, op4_content_chunks, op5_secret_scan, op6_winnowing, op7_warc_round_trip,
    op8_exact_dedup, op9_near_dedup, op10_piece_lattice, op11_quality_rules, op12_ranked_search, op13_conversation_repair)}
