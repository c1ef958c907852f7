"""What the training-data operators share: written tables, joins that bear skew and small text rules.

Intermediate tables are stored by ``scratch.written`` in the shared folder.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..scratch import clean, delete, discard, held, written  # noqa: F401

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"

#: Bytes of one Arrow batch handed to a Python worker; bounds a worker's memory whatever the row size.
BATCH_BYTES = 8 << 20
#: Keys of more than 1/HEAVY of all rows, and of more than LEAST_HOT, are dealt to SALTS tasks in ``salted_join``.
HEAVY, LEAST_HOT, SALTS = 1000, 1000, 64
#: Row numbers of dropped documents that may be broadcast (8 bytes each).
MOST_BROADCAST = 1_000_000


def frequent_keys(rows: DataFrame, keys: list[str]) -> list[int]:
    """Hashes of the keys that hold more than 1/HEAVY of the rows, and LEAST_HOT at least; fewer than HEAVY of them.

    A Misra-Gries pass names candidates, at most HEAVY, and a count of their rows verifies them.
    """
    key = F.xxhash64(*keys).alias("_key")
    named = rows.select(key).freqItems(["_key"], 1 / HEAVY).first()[0] or []
    counts = rows.select(F.when(key.isin(named), key).alias("_key")).groupBy("_key").count().collect() if named else []
    least = max(LEAST_HOT, sum(r["count"] for r in counts) / HEAVY)
    return [r["_key"] for r in counts if r["_key"] is not None and r["count"] > least]


def salted_join(left: DataFrame, right: DataFrame, keys: list[str], spread: list[str], how: str = "inner", hot: list[int] | None = None) -> DataFrame:
    """``left`` (read from files, since it is read more than once) joined with ``right``, which holds at most one row for each key, none of them null.

    Rows of ``left`` whose keys are frequent there (``hot``, by default ``frequent_keys``) are dealt to
    SALTS tasks by a hash of the columns ``spread``, to each of which the row of ``right`` goes.  All other
    rows are joined as they are.  ``right`` has a row for each of many keys, so it is sorted and merged,
    never broadcast.
    """
    hot = frequent_keys(left, keys) if hot is None else hot
    if not hot:
        return left.join(right.hint("merge"), keys, how)
    is_hot = F.xxhash64(*keys).isin(hot)
    left = left.withColumn("_salt", F.when(is_hot, F.pmod(F.xxhash64(*spread), F.lit(SALTS))).otherwise(0).cast("int"))
    right = right.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.when(is_hot, SALTS - 1).otherwise(0))))
    return left.join(right.hint("merge"), [*keys, "_salt"], how).drop("_salt")


def without(rows: DataFrame, losers: DataFrame) -> DataFrame:
    """``rows`` but those whose _row is among ``losers`` (written).

    Up to MOST_BROADCAST losers are broadcast and no text moves; beyond it both sides are sorted and joined.
    """
    few = losers.count() <= MOST_BROADCAST
    return rows.join(F.broadcast(losers) if few else losers.hint("merge"), "_row", "left_anti")


def freed(spark: SparkSession, before: list[str], kept: DataFrame) -> None:
    """Deletes what was written since ``before`` (``held``) but for ``kept``, once nothing else of it is read."""
    for path in held():
        if path not in before and path != kept._stored:
            delete(spark, path)


def bounded_batches(spark: SparkSession) -> None:
    """Python workers get batches of at most BATCH_BYTES; holds for the session, since plans run later."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def documents(spark: SparkSession, sf_dir: str, table: str = "documents") -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def stored_bytes(docs: DataFrame) -> int:
    """Size of the input as its files have it, from the plan's statistics; what has none is summed up."""
    size = int(docs._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    return size if size < 1 << 60 else docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0


def block_size(total: int, least: int, most: int, root: float) -> int:
    """Bytes of a block: in proportion to the root of the input, so that cells (blocks x buckets) grow as the input does."""
    return int(min(most, max(least, root * total**0.5)))


def ascii_lower(text: Column) -> Column:
    """Lower-cases A-Z and nothing else."""
    return F.translate(text, UPPER, LOWER)


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
