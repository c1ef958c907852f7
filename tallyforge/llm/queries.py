"""The registered queries of the training-data operators, each over its whole table, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import bpe, chat, chat_query, exact_dedup, packing, quality, quality_sql, secret_scan, secret_sql, sharding, simhash, suffix_dedup, suffix_sql, toxicity
from .common import documents


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(documents(spark, sf_dir), documents(spark, sf_dir, "labels"))


def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return bpe.round_trip(documents(spark, sf_dir), tokenizer_path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN, stored=True)


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(documents(spark, sf_dir))


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_by_bytes(documents(spark, sf_dir))


def op5_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.formatted(chat_query.with_calls(documents(spark, sf_dir, "conversations")), chat_query.SCHEMAS)


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(documents(spark, sf_dir))


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.duplicate_groups(documents(spark, sf_dir))


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.report(documents(spark, sf_dir))


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(documents(spark, sf_dir))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir), tokenizer_path("word_bpe_49k.json"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_toxicity,
        op2_byte_bpe,
        op3_suffix_dedup,
        op4_sharding,
        op5_chat_format,
        op6_quality_rules,
        op7_exact_dedup,
        op8_secret_scan,
        op9_simhash,
        op10_packing,
    )
}

ORACLE_SQL: dict[str, str] = {
    "op3_suffix_dedup": suffix_sql.SQL,
    "op8_secret_scan": secret_sql.SQL,
    "op5_chat_format": chat_query.SQL,
    "op6_quality_rules": quality_sql.SQL,
    "op7_exact_dedup": """
        WITH t AS (
            SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS text_sha256
            FROM documents
        )
        SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
               doc_id = max(doc_id) OVER g AS kept, text_sha256
        FROM t WINDOW g AS (PARTITION BY text_sha256)
    """,
}
