"""Stages of the count, each from frames to frames; a run writes what a stage returns and goes on.

Worker failures are values: rows whose ``err`` is not null get status error and the run continues.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import schema as S
from ..config import Config, Mark
from ..functions import similarity
from ..functions.text import crop_path, layout_key, normalize, page_kind, party_label, style_code

LOCATE_TRIES = 6


def classify(pages: DataFrame, cfg: Config) -> DataFrame:
    """pages: path, header, style_text, width, height, err -> path and the classified columns.

    Only ballot fronts go on; all other kinds end here.
    """
    low = F.lower(F.coalesce("header", F.lit("")))
    kind = page_kind(F.col("header"), F.col("height"), cfg)
    front = kind == "ballot_front"
    style = F.coalesce(style_code(F.col("style_text"), cfg.classify), style_code(F.col("header"), cfg.classify))
    rows = pages.select(
        "path", "width", "height", "err",
        kind.alias("page_kind"),
        F.when(front, party_label(low, cfg)).alias("party"),
        F.when(front, style).alias("style"),
    )
    bad = F.col("err").isNotNull()
    return rows.select(
        "path", "width", "height",
        *(F.when(~bad, F.col(c)).alias(c) for c in ("page_kind", "party", "style")),
        F.when(~bad, layout_key(F.col("party"), F.col("style"), cfg.classify)).alias("layout"),
        F.when(bad, S.ERROR).when(F.col("page_kind") == "ballot_front", S.CLASSIFIED).otherwise(S.SKIP_NO_CONTEST).alias("status"),
        F.when(bad, F.concat(F.lit("classify: "), F.col("err"))).alias("err"),
    )


def samples(classified: DataFrame, regions: DataFrame, tries: int = LOCATE_TRIES) -> DataFrame:
    """The first images, by path, of each layout that has no region yet."""
    new = classified.filter(F.col("layout").isNotNull()).join(regions.select("layout"), "layout", "left_anti")
    order = Window.partitionBy("layout").orderBy("path")
    return new.withColumn("attempt", F.row_number().over(order)).filter(F.col("attempt") <= tries)


def chosen_attempts(attempts: DataFrame) -> DataFrame:
    """attempts: layout, attempt, found (whether anything was located), valid -> layout, attempt, valid.

    The first valid attempt, else the last that found anything; layouts without any drop out.
    """
    picked = attempts.groupBy("layout").agg(
        F.coalesce(F.min(F.when(F.col("found") & F.col("valid"), F.col("attempt"))), F.max(F.when(F.col("found"), F.col("attempt")))).alias("attempt")
    )
    return picked.filter("attempt is not null").join(attempts.select("layout", "attempt", "valid"), ["layout", "attempt"])


def located(classified: DataFrame, regions: DataFrame) -> DataFrame:
    """path, status: located where the layout has a region."""
    known = regions.select("layout", F.lit(True).alias("_known"))
    return classified.join(known, "layout", "left").select("path", F.when(F.col("_known"), S.LOCATED).otherwise(S.SKIP_NO_CONTEST).alias("status"))


def cache_use(classified: DataFrame, regions: DataFrame) -> DataFrame:
    """hits (images of layouts with a region before the run) and misses (layouts without)."""
    known = regions.select("layout", F.lit(True).alias("_known"))
    per = classified.filter("layout is not null").groupBy("layout").agg(F.count(F.lit(1)).alias("n")).join(known, "layout", "left")
    return per.agg(F.coalesce(F.sum(F.when(F.col("_known"), F.col("n"))), F.lit(0)).alias("hits"), F.count_if(F.col("_known").isNull()).alias("misses"))


def baselines(scored: DataFrame, group: list[str] | str = "layout", cfg: Mark = Mark()) -> DataFrame:
    """group, n, base_oval, base_line: exact interpolated percentiles of every scored row of the group."""
    group = [group] if isinstance(group, str) else group
    share = cfg.baseline_pctl / 100.0
    known = scored.filter(F.col("oval_fill_score").isNotNull())
    return known.groupBy(*group).agg(
        F.count(F.lit(1)).alias("n"),
        F.coalesce(F.percentile("oval_fill_score", F.lit(share)), F.lit(0.0)).alias("base_oval"),
        F.coalesce(F.percentile("line_ink_score", F.lit(share)), F.lit(0.0)).alias("base_line"),
    )


def is_marked(oval: Column, line: Column, base_oval: Column, base_line: Column, n: Column, cfg: Mark = Mark()) -> Column:
    """Ink above the layout's blank baseline or, with few samples, above fixed limits; all strictly."""
    against_base = (oval - base_oval > F.lit(cfg.oval_margin)) | (line - base_line > F.lit(cfg.line_margin))
    return F.when(n >= cfg.min_samples, against_base).otherwise((oval > F.lit(cfg.oval_abs)) | (line > F.lit(cfg.line_abs)))


def decide(images: DataFrame, results: DataFrame, regions: DataFrame, cfg: Config, crop_folder: str, box: str | None = None) -> DataFrame:
    """path, status, has_mark, crop_path, unvalidated for scored images, of one box if given.

    The baseline's population is every scored row of the layout, whatever its status or box.  Rows
    without a layout are not decided.
    """
    scored = images.filter("layout is not null").join(results.select("path", "oval_fill_score", "line_ink_score"), "path")
    base = baselines(scored, "layout", cfg.mark)
    here = scored.filter(F.col("status") == S.SCORED)
    if box is not None:
        here = here.filter(F.col("box") == box)
    rows = here.join(base, "layout").join(regions.select("layout", "valid"), "layout", "left")
    marked = is_marked(F.col("oval_fill_score"), F.col("line_ink_score"), F.col("base_oval"), F.col("base_line"), F.col("n"), cfg.mark)
    return rows.withColumn("_marked", F.coalesce(marked, F.lit(False))).select(
        "path",
        F.when(F.col("_marked"), S.MARKED).otherwise(S.SKIP_BLANK).alias("status"),
        F.col("_marked").cast("int").alias("has_mark"),
        F.when(F.col("_marked"), crop_path(crop_folder, F.col("box"), F.col("seq"))).alias("crop_path"),
        (F.col("_marked") & (F.coalesce("valid", F.lit(0)) == 0)).alias("unvalidated"),
    )


def matched(reads: DataFrame, cfg: Config) -> DataFrame:
    """reads with match, match_score, candidate and reason (null: nothing to review).

    Scores and folds are computed once for each distinct normalized text.
    """
    t = cfg.target
    own = [c for c in reads.columns if c not in ("match", "match_score", "candidate", "reason")]
    normed = reads.select(*own, normalize(F.col("vision_text")).alias("_norm"), F.coalesce("vision_conf", F.lit(0.0)).alias("_conf"))
    texts = normed.select("_norm").distinct()
    folds = similarity.folded_names(texts, cfg, "_norm").withColumnRenamed("candidate", "_folded")
    told = similarity.target_scores(texts, t.term, "_norm").join(folds, "_norm")
    out = normed.join(told, "_norm").withColumn("_match", similarity.match_gate(F.col("score"), F.col("_conf"), t))
    out = out.withColumn("_candidate", F.when(F.col("_match") == t.term, t.term).otherwise(F.col("_folded")))
    unknown = (F.col("_candidate") != "") & ~F.col("_candidate").isin(*cfg.names)
    reason = F.when((F.col("_match") == "review") | unknown, F.when(F.col("_conf") < F.lit(t.low_conf), "low_conf").when(unknown, "unknown_candidate").otherwise("fuzzy_band"))
    return out.select(*own, F.col("_match").alias("match"), F.col("score").alias("match_score"), F.col("_candidate").alias("candidate"), reason.alias("reason"))


def quarantined(images: DataFrame, results: DataFrame, regions: DataFrame, cfg: Config, min_count: int = 8, min_share: float = 0.5) -> DataFrame:
    """path, layout, vision_text of the reads of layouts whose region seems to lie on print.

    Such a layout's region never validated, and one transcription makes up at least ``min_count`` and
    ``min_share`` of its reads other than the target.  Reads of the target are never among them.
    """
    reads = (
        images.select("path", "layout")
        .join(results.select("path", "vision_text", "candidate", "match"), "path")
        .join(regions.filter("valid = 0").select("layout"), "layout")
        .filter((F.col("candidate") != "") & (F.col("match") != cfg.target.term))
    )
    shares = modal_share(reads.withColumn("_norm", normalize(F.col("vision_text"))), "layout", "_norm")
    bad = shares.filter((F.col("modal_n") >= min_count) & (F.col("modal_n") >= min_share * F.col("n"))).select("layout")
    return reads.join(bad, "layout", "left_semi").select("path", "layout", "vision_text")


def modal_share(rows: DataFrame, group: str, text: str) -> DataFrame:
    """group, n, modal_n, modal_text: the most common text, the least of equals."""
    counts = rows.groupBy(group, text).agg(F.count(F.lit(1)).alias("_n"))
    least = F.min_by(F.col(text), F.struct(-F.col("_n"), F.col(text)))
    return counts.groupBy(group).agg(F.sum("_n").alias("n"), F.max("_n").alias("modal_n"), least.alias("modal_text"))


def review_after(review: DataFrame, match_rows: DataFrame, quarantine_rows: DataFrame) -> DataFrame:
    """The review queue after matching and quarantine.

    Matching replaces or removes what marking left; quarantine replaces either.
    """
    rest = review.join(match_rows.select("path"), "path", "left_anti").select("path", "reason", "vision_text", "match_score", "crop_path")
    found = match_rows.filter("reason is not null").select("path", "reason", "vision_text", "match_score", "crop_path")
    flagged = quarantine_rows.select("path", F.lit("mislocated_region").alias("reason"), "vision_text", F.lit(0.0).alias("match_score"), F.lit(None).cast("string").alias("crop_path"))
    return rest.unionByName(found).join(flagged.select("path"), "path", "left_anti").unionByName(flagged)
