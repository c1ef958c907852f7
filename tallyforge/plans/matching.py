"""Queries over reads: similarity, folding, matching, tallies and reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import similarity
from ..functions.text import bar_width, html_escape, normalize, signed_percent, thousands, title_case
from ..operators import stages, summary
from ..scratch import written
from ..telemetry import gauges
from . import bindings as B
from .register import registry, table

QUERIES, ORACLE_SQL, query = registry()
TARGET = B.CONFIG.target.term


def _results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdicts with quarantine; similarity is worked out once, the rest reads what it gave."""
    rows = written(stages.matched(B.reads(spark, sf_dir), B.CONFIG), "matched")
    held = _held(spark, sf_dir, rows).select("path", F.lit(1).alias("_held"))
    return rows.join(held, "path", "left").withColumn("quarantined", F.coalesce("_held", F.lit(0))).drop("_held")


def _held(spark: SparkSession, sf_dir: str, rows: DataFrame) -> DataFrame:
    return stages.quarantined(B.images(spark, sf_dir), rows, B.regions(spark, sf_dir), B.CONFIG, *B.QUARANTINE)


def _scoped(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _results(spark, sf_dir).drop("box", "seq", "party", "status", "layout")
    return summary.in_scope(B.images(spark, sf_dir), rows, B.CONFIG)


_SCOPED = f"scoped AS (SELECT *, CASE WHEN path IN (SELECT path FROM held) THEN 1 ELSE 0 END AS quarantined FROM matched WHERE status = 'done' AND party IN ('Democratic', 'Republican'))"
_TALLY = f"tally AS (SELECT candidate AS name, party, count(*) AS n FROM scoped WHERE candidate <> '' AND quarantined = 0 GROUP BY ALL), totals AS (SELECT name, CAST(sum(n) AS BIGINT) AS total FROM tally GROUP BY name)"


def _summary_sql(select: str, more: str = "") -> str:
    return B.match_sql(select, f"{B.QUARANTINED}, {_SCOPED}, {_TALLY}" + (f", {more}" if more else ""))


@query(f"SELECT p_partkey, {B.NORM.format('vision_text')} AS norm FROM (SELECT p_partkey, {B.NOISE} AS vision_text FROM part)")
def normalize_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").selectExpr("p_partkey", f"{B.NOISE} AS vision_text").select("p_partkey", normalize(F.col("vision_text")).alias("norm"))


@query(f"""SELECT p_partkey, levenshtein(norm, '{TARGET}') AS distance, len(list_filter(string_split(norm, ' '), lambda w: length(w) >= 4 AND levenshtein(w, '{TARGET}') <= 1)) > 0 AS one_edit
FROM (SELECT p_partkey, {B.NORM.format('t')} AS norm FROM (SELECT p_partkey, {B.NOISE} AS t FROM part))""")
def edit_distance(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = normalize_text(spark, sf_dir)
    return rows.select("p_partkey", F.levenshtein("norm", F.lit(TARGET)).cast("long").alias("distance"), similarity.one_edit(F.split("norm", " "), TARGET).alias("one_edit"))


@query(B.match_sql("SELECT norm, round(score, 9) AS score FROM scores"))
def target_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    norms = normalize_text(spark, sf_dir).select("norm")
    return similarity.target_scores(norms, TARGET).select("norm", F.round("score", 9).alias("score"))


@query(B.match_sql("SELECT norms.norm, coalesce(folds.name, norms.norm) AS candidate FROM norms LEFT JOIN folds ON folds.norm = norms.norm"))
def fold_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similarity.folded_names(normalize_text(spark, sf_dir).select("norm"), B.CONFIG)


@query(B.match_sql("SELECT path, match, round(score, 9) AS match_score, candidate, reason FROM matched"))
def match_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stages.matched(B.reads(spark, sf_dir), B.CONFIG).select("path", "match", F.round("match_score", 9).alias("match_score"), "candidate", "reason")


@query(B.match_sql("SELECT match, count(*) AS n FROM matched WHERE vision_text IS NOT NULL GROUP BY match"))
def rescore_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every read again, whatever its status, and how the verdicts fall."""
    return summary.counts_by(stages.matched(B.reads(spark, sf_dir).filter("vision_text IS NOT NULL"), B.CONFIG), "match")


@query(B.match_sql("SELECT path, layout, vision_text FROM held", B.QUARANTINED))
def modal_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _held(spark, sf_dir, written(stages.matched(B.reads(spark, sf_dir), B.CONFIG), "matched"))


@query(_summary_sql("SELECT name, total, party, n FROM tally JOIN totals USING (name)"))
def tally_by_party(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = summary.tally(_scoped(spark, sf_dir))
    return found.select("name", "total", F.explode("by_party").alias("party", "n"))


@query(_summary_sql("SELECT name, total, string_agg(party || ' ' || format('{:,}', n), ', ' ORDER BY n DESC, party) AS parties FROM tally JOIN totals USING (name) GROUP BY name, total"))
def manifest_tally(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All names of the manifest, each with its counts by party as the report shows them."""
    found = summary.tally(_scoped(spark, sf_dir))
    return found.select("name", "total").join(summary.party_counts(found), "name")


@query(_summary_sql("""SELECT 'images.by_status' AS name, status AS label, count(*) AS value FROM matched GROUP BY status
UNION ALL SELECT 'match.by_result', match, count(*) FROM matched GROUP BY match UNION ALL SELECT 'review.queue.size', NULL, count(*) FROM matched WHERE reason IS NOT NULL"""))
def state_gauges(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _results(spark, sf_dir)
    return gauges(B.images(spark, sf_dir), rows, rows.filter("reason IS NOT NULL"))


@query(_summary_sql("""SELECT count(*) FILTER (s) AS marked_read, count(*) FILTER (d AND party = 'other') AS out_of_scope_other, count(*) FILTER (s AND match = 'widget') AS target_total,
count(*) FILTER (d AND party = 'Democratic' AND match = 'widget') AS target_first_party, count(*) FILTER (s AND candidate <> '') - count(*) FILTER (s AND match = 'widget') AS other_names,
count(*) FILTER (s AND match = 'review') AS ambiguous, (SELECT count(*) FROM totals) AS distinct_candidates, count(*) FILTER (s AND candidate = '') AS blank_writeins,
count(*) AS images_total, CAST(0 AS BIGINT) AS skip_no_governor, CAST(0 AS BIGINT) AS skip_blank, (SELECT count(*) FROM held) AS quarantined_all, count(*) FILTER (reason IS NOT NULL) AS review_total
FROM (SELECT *, status = 'done' AS d, status = 'done' AND party IN ('Democratic', 'Republican') AS s FROM matched)"""))
def summary_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _results(spark, sf_dir)
    return summary.summary(B.images(spark, sf_dir), rows, rows.filter("reason IS NOT NULL"), B.CONFIG)


@query(_summary_sql("SELECT name, total, row_number() OVER (ORDER BY total DESC, name) AS rank FROM totals"))
def rank_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summary.ranked(summary.tally(_scoped(spark, sf_dir))).select("name", "total", F.col("rank").cast("long").alias("rank"))


@query(_summary_sql("SELECT count(*) AS names, CAST(coalesce(sum(total), 0) AS BIGINT) AS votes FROM (SELECT total, row_number() OVER (ORDER BY total DESC, name) AS r FROM totals) WHERE r > 40"))
def rank_and_tail(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summary.tail(summary.tally(_scoped(spark, sf_dir)))


@query(_summary_sql("SELECT name, total FROM (SELECT * FROM totals ORDER BY total DESC, name LIMIT 4) WHERE name <> 'widget'"))
def note_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summary.top_names(summary.tally(_scoped(spark, sf_dir)), TARGET).select("name", "total")


_GALLERY = """SELECT name, rank, box, seq, party, vision_text AS text, crop_path FROM (
SELECT candidate AS name, row_number() OVER (PARTITION BY candidate ORDER BY vision_conf DESC, path) AS rank, box, seq, party, vision_text, crop_path FROM scoped
WHERE crop_path IS NOT NULL AND candidate IN (SELECT 'widget' UNION ALL (SELECT name FROM totals WHERE name <> 'widget' ORDER BY total DESC, name LIMIT 11))) WHERE rank <= 9"""


@query(_summary_sql(_GALLERY))
def gallery_topn(spark: SparkSession, sf_dir: str) -> DataFrame:
    scoped = _scoped(spark, sf_dir)
    return summary.gallery(scoped, summary.tally(scoped), B.CONFIG).withColumn("rank", F.col("rank").cast("long"))


@query(_summary_sql(_GALLERY + " AND crop_path NOT LIKE '%7.png'"))
def gallery_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The gallery where some crops are gone from the disk: it gets shorter, no other crop moves up."""
    scoped = _scoped(spark, sf_dir)
    there = B.reads(spark, sf_dir).filter("crop_path NOT LIKE '%7.png'").select("crop_path")
    return summary.gallery(scoped, summary.tally(scoped), B.CONFIG, there).withColumn("rank", F.col("rank").cast("long"))


@query(B.match_sql("""SELECT path, reason, vision_text, round(match_score, 9) AS match_score, crop_path FROM (
SELECT path, 'mislocated_region' AS reason, vision_text, CAST(0 AS DOUBLE) AS match_score, CAST(NULL AS VARCHAR) AS crop_path FROM held
UNION ALL SELECT path, reason, vision_text, score, crop_path FROM matched WHERE reason IS NOT NULL AND status = 'done' AND path NOT IN (SELECT path FROM held)
UNION ALL SELECT path, 'unvalidated_region', NULL, NULL, crop_path FROM matched WHERE status <> 'done' AND path NOT IN (SELECT path FROM held))""", B.QUARANTINED))
def review_upsert_delete(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages start in the queue; matching the done ones and the quarantine leave this."""
    rows = written(stages.matched(B.reads(spark, sf_dir), B.CONFIG), "matched")
    start = rows.select("path", F.lit("unvalidated_region").alias("reason"), F.lit(None).cast("string").alias("vision_text"), F.lit(None).cast("double").alias("match_score"), "crop_path")
    after = stages.review_after(start, rows.filter("status = 'done'"), _held(spark, sf_dir, rows))
    return after.withColumn("match_score", F.round("match_score", 9))


@query(_summary_sql("""SELECT party, coalesce(ours, 0) AS ours, official, round((coalesce(ours, 0) - official) / official, 9) AS delta, abs((coalesce(ours, 0) - official) / official) <= CAST(0.15 AS DOUBLE) AS ok
FROM (VALUES ('Democratic', CAST(250 AS BIGINT)), ('Republican', CAST(163 AS BIGINT))) AS f(party, official)
LEFT JOIN (SELECT party, count(*) AS ours FROM scoped WHERE vision_oval = 'filled' GROUP BY party) USING (party)"""))
def reconcile_filled(spark: SparkSession, sf_dir: str) -> DataFrame:
    official = spark.sql("SELECT * FROM VALUES ('Democratic', 250L), ('Republican', 163L) AS t(party, official)")
    ours = summary.filled_by_party(_scoped(spark, sf_dir))
    return summary.reconcile(ours, official).withColumn("delta", F.round("delta", 9))


@query(_summary_sql("""SELECT name, array_to_string(list_transform(string_split(name, ' '), lambda w: upper(w[1]) || w[2:]), ' ') AS title, round(greatest(CAST(100 * total AS DOUBLE) / (SELECT sum(total) FROM totals), CAST(0.6 AS DOUBLE)), 2) AS width,
format('{:,}', total * 1000) AS shown, replace(replace(replace('<' || name || ' & "co">', '&', '&amp;'), '<', '&lt;'), '>', '&gt;').replace('"', '&quot;') AS safe,
printf('%+.1f%%', 100 * CAST((total - 63) / 63 AS DOUBLE)) AS change FROM totals"""))
def report_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = summary.tally(_scoped(spark, sf_dir)).select("name", "total")
    whole = found.agg(F.sum("total").alias("_all"))  # one row
    return found.crossJoin(whole).select(
        "name", title_case(F.col("name")).alias("title"), bar_width(F.col("total"), F.col("_all")).alias("width"),
        thousands(F.col("total") * 1000).alias("shown"),
        html_escape(F.concat(F.lit("<"), F.col("name"), F.lit(' & "co">'))).alias("safe"),
        signed_percent((F.col("total") - 63) / 63).alias("change"),
    )
