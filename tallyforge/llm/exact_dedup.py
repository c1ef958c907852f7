"""Exact duplicates by a heavy-hitter split (DataFrame functions only).

1. A Misra-Gries pass (``freqItems``) over 64-bit digests names every digest that may hold more than
   ``SUPPORT`` of the rows.  It returns at most 1/SUPPORT candidates, whatever the input size.
2. An exact count over the candidates' rows verifies them and picks each group's winner.  Map-side
   combine leaves one row per candidate and task to shuffle.
3. The winners, at most 1/SUPPORT rows, are broadcast: rows of frequent texts are settled map-side.
4. All other rows are shuffled by their digest; no group there holds more than SUPPORT of the rows.

Two texts are equal if they are identical after lower-casing A-Z; groups are by SHA-256 of that
form.  A null text counts as empty.  Of equal texts the row with the largest doc_id stays, a null
doc_id ranking lowest; of rows that repeat a doc_id too, the last as stored is kept (see also
``deduplicate``).  Empty tables give empty results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import ascii_lower, text_or_empty, without, written

#: Share of rows above which a text is settled by broadcast; also bounds the broadcast to 1/SUPPORT rows.
SUPPORT = 1e-4


def digest(column: str = "text") -> Column:
    """Lowercase hex SHA-256 of the normalised text."""
    return F.sha2(ascii_lower(text_or_empty(column)).cast("binary"), 256)


def _frequent(rows: DataFrame, sha: str, rank: Column, support: float) -> DataFrame:
    """(sha, keep, group_size) of the texts that the Misra-Gries pass names; at most about 1/support rows."""
    short = rows.select(F.xxhash64(sha).alias("_short"))
    named = short.freqItems(["_short"], support).select(F.explode("_short_freqItems").alias("_short"))
    return (
        rows.withColumn("_short", F.xxhash64(sha))
        .join(F.broadcast(named), "_short", "left_semi")
        .groupBy(sha)
        .agg(F.max(rank).alias("_keep"), F.count(F.lit(1)).alias("_size"))
        .filter("_size > 1")
    )


def _settled(rows: DataFrame, sha: str, rank: Column, support: float) -> DataFrame:
    """``rows`` (written) with _keep, the greatest ``rank`` of their text, and _size; ``rank`` ends with _row."""
    winners = written(_frequent(rows, sha, rank, support), "exact-winners")
    frequent = rows.join(F.broadcast(winners), sha)
    group = Window.partitionBy(sha)
    ordinary = rows.join(F.broadcast(winners), sha, "left_anti")
    ordinary = ordinary.withColumns({"_keep": F.max(rank).over(group), "_size": F.count(F.lit(1)).over(group)})
    return frequent.unionByName(ordinary)


def duplicate_groups(docs: DataFrame, support: float = SUPPORT) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256."""
    slim = docs.select("doc_id", digest().alias("text_sha256"))
    slim = written(slim.withColumn("_row", F.monotonically_increasing_id()), "exact-digests")
    return _settled(slim, "text_sha256", F.struct("doc_id", "_row"), support).select(
        "doc_id",
        F.col("_keep.doc_id").alias("keep_id"),
        F.col("_size").alias("group_size"),
        (F.col("_row") == F.col("_keep._row")).alias("kept"),
        "text_sha256",
    )


def deduplicate(docs: DataFrame, support: float = SUPPORT) -> DataFrame:
    """``docs`` with one row of each group of equal texts; columns unchanged.

    Of rows that repeat a doc_id too, but differ in case, the one whose text has the greatest hash stays;
    of rows with the same doc_id and text the last as stored.  Only digests are shuffled: the rows that go
    are dropped by their row number (``without``).
    """
    # Renamed, so that the documents' columns cannot clash with the operator's own.
    rows = docs.select(*(F.col(c).alias(f"_own_{c}") for c in docs.columns), F.unhex(digest()).alias("_sha"), F.xxhash64("text").alias("_tie"))
    rows = written(rows.withColumn("_row", F.monotonically_increasing_id()), "exact-rows")
    keys = rows.select("_sha", "_own_doc_id", "_tie", "_row")
    losers = _settled(keys, "_sha", F.struct("_own_doc_id", "_tie", "_row"), support).filter("_row <> _keep._row").select("_row")
    left = without(rows, written(losers, "exact-losers"))
    return left.select(*(F.col(f"_own_{c}").alias(c) for c in docs.columns))
