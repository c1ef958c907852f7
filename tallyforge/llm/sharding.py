"""Sharding by sampled splitters (DataFrame and SQL functions only).

Law ``bytes``: sixteen shards of near-equal size, where a document weighs its UTF-8 bytes plus one.

1. Every row gets the key (hash of its text, hash of its doc_id); equal texts are neighbours.
2. Rows are drawn with a chance in proportion to their size; quantiles of the drawn keys are the
   splitters of about 16 ranges a shard, so that a frequent text is spread over several ranges.
3. Ranges that come out over twice their share are subdivided by a hash of the row number.
4. Ranges are laid end to end by their exact sizes, and rows inside a range in key order.  A row goes
   to the shard in which its middle falls, so a shard is off by half its first and last document at most.

The splitters are at most MAX_RANGES rows and are broadcast; ranges bound what one task sorts.
A null text has size 1 and the checksum of the empty text.  Repeated rows count each; empty tables
give empty results.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import text_or_empty, written

SHARDS = 16
RANGES_PER_SHARD = 16
#: Bytes of text that a range stands for in large inputs; a range's sorted rows hold some 50 bytes a document.
RANGE_BYTES = 256 << 20
MAX_RANGES = 8192
DRAWS_PER_RANGE = 16
#: Bits of the key that find the few splitters a row is compared with.
PREFIX_BITS = 10


def _splitters(rows: DataFrame, total: int, ranges: int) -> list[tuple[int, int]]:
    """Quantile keys of a size-weighted draw of about ranges * DRAWS_PER_RANGE rows."""
    draws = ranges * DRAWS_PER_RANGE
    chance = F.pmod(F.xxhash64("_h", "_t", "_row"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    copies = F.floor(F.col("size") * F.lit(draws / total) + chance).cast("int")
    drawn = rows.select("_h", "_t", copies.alias("_n")).filter("_n > 0").collect()
    keys = sorted((r["_h"], r["_t"]) for r in drawn for _ in range(r["_n"]))
    return sorted({keys[len(keys) * i // ranges] for i in range(1, ranges)}) if keys else []


def _with_range(rows: DataFrame, splitters: list[tuple[int, int]]) -> DataFrame:
    """Adds _range, the number of splitters at or below the row's key."""
    spark, shift = rows.sparkSession, 64 - PREFIX_BITS
    if not splitters:
        return rows.withColumn("_range", F.lit(0))
    near: dict[int, list[tuple[int, int]]] = {}
    for h, t in splitters:
        near.setdefault(h >> shift, []).append((h, t))
    half, below, lines = 1 << (PREFIX_BITS - 1), 0, []
    for prefix in range(-half, half):
        own = near.get(prefix, [])
        cells = ", ".join(f"named_struct('h', {_long(h)}, 't', {_long(t)})" for h, t in own)
        lines.append(f"({prefix}L, {below}, {f'array({cells})' if own else 'cast(array() as array<struct<h:bigint,t:bigint>>)'})")
        below += len(own)
    table = spark.sql(f"SELECT * FROM VALUES {', '.join(lines)} AS s(_prefix, _below, _near)")
    key = F.struct(F.col("_h").alias("h"), F.col("_t").alias("t"))
    return (
        rows.withColumn("_prefix", F.shiftright("_h", shift))
        .join(F.broadcast(table), "_prefix")
        .withColumn("_range", F.col("_below") + F.size(F.filter("_near", lambda s: s <= key)))
        .drop("_prefix", "_below", "_near")
    )


def _long(value: int) -> str:
    return f"{value}L" if value > -(1 << 63) else "(-9223372036854775807L - 1L)"


def shard_by_bytes(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard; one row per document."""
    text = text_or_empty()
    slim = written(
        docs.select(
            "doc_id",
            (F.octet_length(text) + 1).cast("long").alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"),
            F.xxhash64(text).alias("_h"),
            F.xxhash64("doc_id").alias("_t"),
            F.monotonically_increasing_id().alias("_row"),
        ),
        "shard-rows",
    )
    total = slim.agg(F.sum("size")).first()[0] or 1
    ranges = min(MAX_RANGES, max(RANGES_PER_SHARD * shards, total // RANGE_BYTES))
    ranged = _with_range(slim, _splitters(slim, total, ranges))
    share = 2 * total / ranges
    parts = ranged.groupBy("_range").agg(F.ceil(F.sum("size") / F.lit(share)).cast("int").alias("_parts"))
    # At most MAX_RANGES rows.
    ranged = written(
        ranged.join(F.broadcast(parts), "_range").withColumn("_part", F.pmod(F.xxhash64("_row"), F.col("_parts")).cast("int")).drop("_parts"),
        "shard-ranges",
    )
    end = Window.orderBy("_range", "_part").rowsBetween(Window.unboundedPreceding, -1)
    # One row for each range and part: at most 1.5 * MAX_RANGES, since parts beyond the first need half a range each.
    bases = (
        ranged.groupBy("_range", "_part")
        .agg(F.sum("size").alias("_bytes"), F.count(F.lit(1)).alias("_rows"))
        .select("_range", "_part", F.coalesce(F.sum("_bytes").over(end), F.lit(0)).alias("_byte0"), F.coalesce(F.sum("_rows").over(end), F.lit(0)).alias("_row0"))
    )
    inside = Window.partitionBy("_range", "_part").orderBy("_h", "_t", "_row")
    placed = ranged.select(
        "*",
        (F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size")).alias("_before"),
        (F.row_number().over(inside) - 1).alias("_index"),
    ).join(F.broadcast(bases), ["_range", "_part"])
    placed = written(
        placed.select(
            "doc_id", "size", "text_crc32",
            F.least(F.lit(shards - 1), F.expr("((_byte0 + _before) * 2 + size) * %d DIV %d" % (shards, 2 * total))).cast("int").alias("shard"),
            (F.col("_row0") + F.col("_index")).alias("_position"),
        ),
        "shard-places",
    )
    # One row for each shard.
    starts = placed.groupBy("shard").agg(F.min("_position").alias("_start"))
    return placed.join(F.broadcast(starts), "shard").select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
        (F.col("_position") - F.col("_start")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
