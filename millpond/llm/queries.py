"""The registered queries of this subpackage, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millpond.llm import (
    bpe,
    centroid_clustering,
    chat_format,
    decontamination,
    embedding_dedup,
    language_id,
    secret_scan,
    sharding,
    simhash,
    substring_dedup,
    suffix_dedup,
    token_counts,
    whitening,
)

PIECES = "piece_bpe_32k.model"
WORDS = "word_bpe_49k.json"
TOKEN_LIMIT = 4096


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False))
    model = language_id.train(docs.filter(~held & F.col("doc_id").isNotNull()).select("text", "lang"))
    found = language_id.identify(docs, model)
    return found.select("doc_id", held.alias("held_out"), "lang_pred", "score", "cross_entropy", "rejected")


def op2_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = _table(spark, sf_dir, "conversations")
    return chat_format.parse(chat_format.transcripts(turns), chat_format.train(turns))


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = token_counts.count_tokens(_table(spark, sf_dir, "documents"), public_tokenizers.path(PIECES))
    return counted.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


def op4_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(_table(spark, sf_dir, "embeddings"))


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contaminated(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = bpe.encode(_table(spark, sf_dir, "documents"), public_tokenizers.path(WORDS))
    return coded.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = secret_scan.train(secret_scan.labelled_samples(docs))
    return secret_scan.report(secret_scan.scan(docs, model))


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.repeated_passages(_table(spark, sf_dir, "documents"))


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(_table(spark, sf_dir, "documents"))
    return found.withColumn("fingerprint", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")))


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_dedup.without_repeats(_table(spark, sf_dir, "documents"), passage=suffix_dedup.PASSAGE)
    digest = F.sha2("kept", 256).alias("kept_sha256")
    more = [(F.col("n_removed") > 0).alias("has_repeats"), "has_passage"]
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", digest, *more)


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(_table(spark, sf_dir, "embeddings"))


def op12_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.shard_documents(_table(spark, sf_dir, "documents"))
    return placed.select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")


def op13_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroid_clustering.cluster(_table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_language_id,
        op2_chat_format,
        op3_token_counts,
        op4_embedding_dedup,
        op5_decontamination,
        op6_bpe,
        op7_secret_scan,
        op8_substring_dedup,
        op9_simhash,
        op10_suffix_dedup,
        op11_whitening,
        op12_sharding,
        op13_centroid_clustering,
    )
}
ORACLE: dict[str, str] = {}
