"""Training-data pipeline over ``documents``.

Stages, each over all rows that its predecessor kept: toxic documents go, of
exact copies one stays, of near copies (five-word shingles, Jaccard similarity 0.8
or more) one stays, sources are mixed to their
target weights (a document may then occur up to three times), and what is left
is encoded to pieces and decoded again. Every stage is written as Parquet in
the shared folder before the next reads it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from opsflow.llm import exact_dedup, near_dedup, pareto_mix, piece_lattice, toxicity
from opsflow.llm.common import lean, written
from opsflow.llm.queries import table, tokenizer_file


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    lean(spark)
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


def exact_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    lean(spark)
    return exact_dedup.drop_copies(docs)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    lean(spark)
    return near_dedup.drop_near_copies(docs, percent=80)


def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    lean(spark)
    return pareto_mix.mixed_rows(docs)


def piece_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    lean(spark)
    return piece_lattice.encode(docs, piece_lattice.piece_table(tokenizer_file("piece_bpe_32k.model")), pack_chars=2 << 20)


STAGES = [
    ("toxicity", toxicity_stage),
    ("exact_dedup", exact_dedup_stage),
    ("near_dedup", near_dedup_stage),
    ("mix", mix_stage),
    ("pieces", piece_stage),
]

# Nearest examples, order sampling and piece lattices have no SQL form; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
