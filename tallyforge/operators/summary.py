"""What a count amounts to: tally, summary, reconciliation, coverage, gallery.

``in scope`` means: done, and of a configured party.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import Config
from ..functions.text import relative_delta

TOLERANCE = 0.15
GALLERY_NAMES, GALLERY_PER_NAME = 12, 9
TABLE_ROWS, NOTE_NAMES = 40, 4


def counts_by(rows: DataFrame, *columns: str) -> DataFrame:
    return rows.groupBy(*columns).agg(F.count(F.lit(1)).alias("n"))


def in_scope(images: DataFrame, results: DataFrame, cfg: Config) -> DataFrame:
    """box, seq and party of images with their results; both filters reach the scan."""
    done = images.filter((F.col("status") == "done") & F.col("party").isin(*cfg.party_labels))
    return done.select("path", "box", "seq", "party").join(results, "path")


def tally(scoped: DataFrame) -> DataFrame:
    """name, total, by_party (a map): named reads that are not quarantined."""
    named = scoped.filter((F.col("candidate") != "") & (F.coalesce("quarantined", F.lit(0)) == 0))
    per_party = named.groupBy(F.col("candidate").alias("name"), "party").agg(F.count(F.lit(1)).alias("n"))
    return per_party.groupBy("name").agg(F.sum("n").alias("total"), F.map_from_entries(F.array_sort(F.collect_list(F.struct("party", "n")))).alias("by_party"))


def in_order(tallied: DataFrame) -> DataFrame:
    """By total and name."""
    return tallied.orderBy(F.desc("total"), "name")


def ranked(tallied: DataFrame) -> DataFrame:
    """rank by total and name; the window is over one row per name."""
    return tallied.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("total"), "name")))


def first_names(tallied: DataFrame, shown: int = TABLE_ROWS) -> DataFrame:
    """The first names with their rank: a top-k, so that ranking looks at ``shown`` rows only."""
    return ranked(in_order(tallied).limit(shown))


def tail(tallied: DataFrame, shown: int = TABLE_ROWS) -> DataFrame:
    """names and votes beyond the table's rows: all of them less the first."""
    both = lambda rows: rows.agg(F.count(F.lit(1)).alias("names"), F.coalesce(F.sum("total"), F.lit(0)).alias("votes"))
    first = both(in_order(tallied).limit(shown)).toDF("_names", "_votes")
    # Each side is one row.
    return both(tallied).crossJoin(first).select((F.col("names") - F.col("_names")).alias("names"), (F.col("votes") - F.col("_votes")).alias("votes"))


def top_names(tallied: DataFrame, target: str, shown: int = NOTE_NAMES) -> DataFrame:
    """The first names by total, then without the target: shown or shown - 1 of them."""
    return in_order(tallied).limit(shown).filter(F.col("name") != target)


def party_counts(tallied: DataFrame) -> DataFrame:
    """name and its counts by party as a text, the largest first."""
    entries = F.transform(F.map_entries("by_party"), lambda e: F.struct((-e["value"]).alias("n"), e["key"].alias("party")))
    texts = F.transform(F.array_sort(entries), lambda e: F.concat(e["party"], F.lit(" "), F.format_number(-e["n"], 0)))
    return tallied.select("name", F.array_join(texts, ", ").alias("parties"))


def summary(images: DataFrame, results: DataFrame, review: DataFrame, cfg: Config) -> DataFrame:
    """One row with the counts of the whole run, in one pass over each table."""
    t = cfg.target.term
    joined = images.filter("status = 'done'").select("path", "party").join(results.select("path", "match", "candidate", "quarantined"), "path")
    scoped = F.col("party").isin(*cfg.party_labels)
    named = F.coalesce(F.col("candidate") != "", F.lit(False))
    first = cfg.party_labels[0]
    kept = scoped & named & (F.coalesce("quarantined", F.lit(0)) == 0)
    reads = joined.agg(
        F.count_if(scoped).alias("marked_read"),
        F.count_if(F.col("party") == "other").alias("out_of_scope_other"),
        F.count_if(scoped & (F.col("match") == t)).alias("target_total"),
        F.count_if((F.col("party") == first) & (F.col("match") == t)).alias("target_first_party"),
        (F.count_if(scoped & named) - F.count_if(scoped & (F.col("match") == t))).alias("other_names"),
        F.count_if(scoped & (F.col("match") == "review")).alias("ambiguous"),
        F.countDistinct(F.when(kept, F.col("candidate"))).alias("distinct_candidates"),
        F.count_if(scoped & ~named).alias("blank_writeins"),
    )
    status = images.agg(
        F.count(F.lit(1)).alias("images_total"),
        F.count_if(F.col("status") == "skip_no_governor").alias("skip_no_governor"),
        F.count_if(F.col("status") == "skip_blank").alias("skip_blank"),
    )
    held = results.agg(F.count_if(F.col("quarantined") == 1).alias("quarantined_all"))
    queue = review.agg(F.count(F.lit(1)).alias("review_total"))
    # Each side is one row.
    return reads.crossJoin(status).crossJoin(held).crossJoin(queue)


def filled_by_party(scoped: DataFrame) -> DataFrame:
    return scoped.filter(F.col("vision_oval") == "filled").groupBy("party").agg(F.count(F.lit(1)).alias("ours"))


def reconcile(ours: DataFrame, official: DataFrame, tolerance: float = TOLERANCE) -> DataFrame:
    """official: party, official -> party, ours, official, delta, ok; a party without a total is skipped (ok null)."""
    joined = official.join(ours, "party", "left").select("party", F.coalesce("ours", F.lit(0)).alias("ours"), "official")
    delta = relative_delta(F.col("ours"), F.col("official"))
    return joined.withColumn("delta", delta).withColumn("ok", F.abs("delta") <= F.lit(tolerance))


def reconciled(checks: DataFrame) -> DataFrame:
    """ok: whether every party with a total is within tolerance; true without any."""
    return checks.agg(F.coalesce(F.bool_and("ok"), F.lit(True)).alias("ok"))


def missing(expected: DataFrame, present: DataFrame, key: str) -> DataFrame:
    """Distinct keys that are expected and not present, in order."""
    return expected.select(key).distinct().join(present.select(key), key, "left_anti").orderBy(key)


def coverage(expected: DataFrame, present: DataFrame, key: str) -> DataFrame:
    """on_disk, ingested, missing: numbers of distinct keys."""
    both = expected.select(key, F.lit(True).alias("_e")).distinct().join(present.select(key, F.lit(True).alias("_p")).distinct(), key, "full")
    return both.agg(F.count_if("_e").alias("on_disk"), F.count_if("_p").alias("ingested"), F.count_if(F.col("_e") & F.col("_p").isNull()).alias("missing"))


def gallery(scoped: DataFrame, tallied: DataFrame, cfg: Config, files: DataFrame | None = None, names: int = GALLERY_NAMES, per_name: int = GALLERY_PER_NAME) -> DataFrame:
    """name, rank, box, seq, party, text, crop_path: the surest crops of the target and the next names.

    Crops that are not among ``files`` are dropped after the ranking, so a gallery may be short.
    """
    others = tallied.filter(F.col("name") != cfg.target.term).orderBy(F.desc("total"), "name").limit(names - 1).select("name")
    spark = scoped.sparkSession
    shown = others.union(spark.range(1).select(F.lit(cfg.target.term).alias("name")))
    rows = scoped.filter(F.col("crop_path").isNotNull()).withColumn("name", F.col("candidate")).join(F.broadcast(shown), "name")  # at most ``names`` rows
    order = Window.partitionBy("name").orderBy(F.desc_nulls_last("vision_conf"), "path")
    top = rows.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= per_name)
    if files is not None:
        top = top.join(files.select("crop_path"), "crop_path", "left_semi")
    return top.select("name", "rank", "box", "seq", "party", F.col("vision_text").alias("text"), "crop_path")


def first_of(items: Column, better: Column, tie: Column) -> Column:
    """Aggregate: the item with the greatest ``better``, the least ``tie`` among equals."""
    return F.min_by(items, F.struct(-better, tie))
