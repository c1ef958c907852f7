"""The corpus pipeline: quality rules, exact and near duplicates, secrets, packing.

Each stage works on all rows that its predecessor kept; its result is written as Parquet and read
again as the next stage's documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallyforge.llm import exact_dedup, packing, quality, secret_scan, simhash
from tallyforge.llm.common import documents, freed, held, written
from tallyforge.llm.queries import tokenizer_path


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules reject go."""
    return quality.keep_good(docs)


def exact_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the one with the largest doc_id stays."""
    return exact_dedup.deduplicate(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of near-duplicates the one with the least doc_id stays."""
    return simhash.keep_one(docs)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced in the texts; no document goes."""
    return secret_scan.redact(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece of a packed sequence."""
    return packing.pack(docs, tokenizer_path("word_bpe_49k.json"))


STAGES = [
    ("quality rules", quality_rules),
    ("exact dedup", exact_duplicates),
    ("simhash near-dedup", near_duplicates),
    ("secret scans", secrets),
    ("packing", pack),
]

#: No SQL: fingerprints need XXH64 and sequences a tokenizer.  Tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = documents(spark, sf_dir), held()
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"), "snappy")
        freed(spark, before, docs)  # the stages' own tables, and their predecessors' documents
    return STAGES[-1][1](spark, docs, sf_dir)
