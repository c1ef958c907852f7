"""From scans to verdicts: each phase picks its images, reads their pixels and hands what it finds to the state.

``Work`` holds what phases need besides the state: an OCR engine (``text(png, psm)``, ``table(png, psm)``) and a
vision model (a callable from a crop's bytes to a reply).  Only folders of boxes with waiting images are
listed, and of those only waiting images are decoded further.  All phases take a box and a limit.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schema as S
from ..sources import images, scan
from ..sources.providers import read_with
from .run import Count

@dataclass(frozen=True)
class Work:
    root: str
    crops: str
    ocr: Any = None
    vision: Callable[[bytes], str] | None = None


def _pixels(count: Count, waiting: DataFrame) -> DataFrame | None:
    """path, width, height, channels, data, err of the waiting images; None without any.

    A box folder is named by the directory that its files lie in; boxes are few, so their folders are listed here.
    """
    folders = [r[0] for r in waiting.select(F.regexp_extract("path", "^(.*)/[^/]+$", 1)).distinct().collect()]
    if not folders:
        return None
    return images.load(count.spark, [f"{f}/*.[jJ][pP]*[gG]" for f in folders], keep_invalid=True).join(waiting.select("path"), "path", "left_semi")


def ingest(count: Count, work: Work, box: str | None = None, limit: int | None = None) -> None:
    count.ingest(scan.list_files(count.spark, work.root, count.cfg))


def classify(count: Count, work: Work, box: str | None = None, limit: int | None = None) -> None:
    pixels = _pixels(count, count.waiting(S.PENDING, box, limit))
    if pixels is not None:
        count.classify(images.read_bands(pixels, work.ocr, count.cfg))


def locate(count: Count, work: Work, box: str | None = None, limit: int | None = None) -> None:
    """At most six samples of each new layout are decoded; all other images only look their layout up."""
    if not count.waiting(S.CLASSIFIED, box, limit).limit(1).count():
        return
    samples = count.to_locate(box, limit)
    pixels = _pixels(count, samples)
    if pixels is None:
        found = count.spark.createDataFrame([], f"path string, found boolean, valid boolean, {images.REGION}")
    else:
        pages = images.read_words(pixels.filter("err IS NULL"), work.ocr, count.cfg)
        found = images.locate(pages, images.label_finder(work.ocr, count.cfg), images.strip_reader(work.ocr, count.cfg), count.cfg)
    count.locate(found, box, limit)


def mark(count: Count, work: Work, box: str | None = None, limit: int | None = None) -> None:
    todo = count.to_mark(box, limit)
    pixels = _pixels(count, todo)
    if pixels is None:
        return
    here = pixels.join(todo.drop("box", "layout"), "path")
    scores = images.score_ink(here.filter("err IS NULL"), count.cfg)
    bad = here.filter("err IS NOT NULL").select("path", F.lit(None).cast("double").alias("oval_fill_score"), F.lit(None).cast("double").alias("line_ink_score"), F.concat(F.lit("mark: "), "err").alias("err"))
    gone = todo.join(pixels.select("path"), "path", "left_anti").select("path", F.lit(None).cast("double").alias("oval_fill_score"), F.lit(None).cast("double").alias("line_ink_score"), F.lit("mark: the file is gone").alias("err"))
    count.mark(scores.unionByName(bad).unionByName(gone), work.crops, box, pixels.filter("err IS NULL").drop("err"))


def plain_path(path: Column) -> Column:
    """Local paths without their scheme."""
    return F.regexp_replace(path, "^file:/+", "/")


def crop_files(spark: SparkSession, folder: str) -> DataFrame:
    """crop_path, content of the crops on disk; contents are read only where they are used."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return spark.createDataFrame([], "crop_path string, content binary")
    return spark.read.format("binaryFile").load(folder).select(plain_path(F.col("path")).alias("crop_path"), "content")


def read(count: Count, work: Work, box: str | None = None, limit: int | None = None) -> None:
    todo = count.to_read(box, limit)
    if not todo.limit(1).count():
        return
    crops = todo.withColumn("crop_path", plain_path(F.col("crop_path"))).join(crop_files(count.spark, work.crops), "crop_path", "left")
    replies = read_with(crops.filter("content IS NOT NULL"), work.vision, count.cfg.vision.read_workers)
    none = lambda kind: F.lit(None).cast(kind)
    lost = crops.filter("content IS NULL").select("path", none("string").alias("reply"), none("double").alias("latency_ms"), F.lit("read: the crop is gone").alias("err"), none("double").alias("began"))
    count.read(replies.unionByName(lost))


def match(count: Count, work: Work, box: str | None = None, limit: int | None = None) -> None:
    count.match(box=box)


PHASES = {f.__name__: f for f in (ingest, classify, locate, mark, read, match)}


def run(count: Count, work: Work, phase: str = "all", box: str | None = None, limit: int | None = None) -> None:
    """One phase, or all of them in order."""
    for name in PHASES if phase == "all" else (phase,):
        PHASES[name](count, work, box, limit)
    count.recorder.gauges(count.table("images"), count.table("results"), count.table("review"))
