"""From raw documents to token ids: five stages, each written as Parquet before the next one reads it."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millpond.llm import bpe, decontamination, language_id, secret_scan, simhash
from millpond.llm.queries import WORDS
from millpond.session import materialise


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents whose language the models accept, learned from the documents' own labels."""
    model = language_id.train(docs.select("text", "lang"))
    return language_id.accepted(docs, model)


def one_per_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, of each group of near-duplicates."""
    return simhash.one_per_group(docs)


def without_benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that hold no benchmark item."""
    return decontamination.without_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets masked."""
    return secret_scan.without_secrets(docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids, decoded): what a trainer reads."""
    coded = bpe.encode(docs, public_tokenizers.path(WORDS))
    return coded.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), "ids", "decoded")


STAGES = [
    ("language_id", known_language),
    ("simhash_near_dedup", one_per_group),
    ("benchmark_decontamination", without_benchmarks),
    ("secret_scan", without_secrets),
    ("bpe_encoding", encoded),
]
#: Kneser-Ney models, components, tilings and merge queues are not SQL; a brute-force version tests run().
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows for the table ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return docs
