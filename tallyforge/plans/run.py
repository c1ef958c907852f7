"""A resumable run: state on disk, phases that move images on by status.

Each phase reads the current tables, derives the next ones from what it was given, and saves the tables that
changed.  ``commits/<n>.json`` names the folder of each table in generation n; it appears by a rename once
all folders are whole, and nothing that a commit names is ever deleted or written again, so a run that
dies anywhere goes on from the last generation that was saved whole.  Repeating a phase with nothing new
changes nothing.  A second writer finds its generation taken and fails instead of losing the first one's rows.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schema as S
from ..config import Config
from ..operators import stages, state, summary
from ..sources.files import write_crops
from ..sources.images import cut
from ..sources.providers import parse_reply
from ..sources.scan import manifest
from ..telemetry import Recorder, inflight, latency

TABLES = {"images": S.IMAGES, "results": S.RESULTS, "regions": S.REGIONS, "review": S.REVIEW}


class Count:
    def __init__(self, spark: SparkSession, folder: str, cfg: Config, recorder: Recorder | None = None):
        self.spark, self.folder, self.cfg = spark, folder.rstrip("/"), cfg
        self.recorder = recorder or Recorder(cfg.telemetry)

    def _path(self, name: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}")

    def _fs(self):
        return self._path("").getFileSystem(self.spark._jsc.hadoopConfiguration())

    def generation(self) -> int:
        """The last generation that was committed; 0 before the first."""
        fs, commits = self._fs(), self._path("commits")
        names = [e.getPath().getName() for e in fs.listStatus(commits)] if fs.exists(commits) else []
        return max((int(n[:-5]) for n in names if re.fullmatch(r"\d+\.json", n)), default=0)

    def folders(self, at: int | None = None) -> dict[str, str]:
        """The folder of each table in a generation, the last by default."""
        at = self.generation() if at is None else at
        return json.loads("".join(r[0] for r in self.spark.read.text(f"{self.folder}/commits/{at}.json").collect())) if at else {}

    def table(self, name: str, at: int | None = None) -> DataFrame:
        folder = self.folders(at).get(name)
        if folder is None:
            return self.spark.createDataFrame([], TABLES[name])
        return S.conformed(self.spark.read.parquet(f"{self.folder}/{folder}"), TABLES[name])

    def _commit(self, at: int, folders: dict[str, str]) -> None:
        fs, path, new = self._fs(), self._path(f"commits/{at}.json"), self._path(f"commits/{uuid.uuid4().hex}.new")
        out = fs.create(new, False)
        out.write(json.dumps(folders).encode())
        out.close()
        if fs.exists(path) or not fs.rename(new, path):
            fs.delete(new, False)
            raise RuntimeError(f"generation {at} was saved by another run")

    def save(self, **frames: DataFrame) -> None:
        """The next generation: the given tables, and the others as they are."""
        at = self.generation()
        folders = self.folders(at)
        for name, frame in frames.items():
            folders[name] = f"{name}/{at + 1}-{uuid.uuid4().hex[:8]}"
            S.conformed(frame, TABLES[name]).write.parquet(f"{self.folder}/{folders[name]}")
        self._commit(at + 1, folders)

    @contextmanager
    def _once(self, frame: DataFrame) -> Iterator[DataFrame]:
        """``frame`` worked out once, for what is read several times in a phase."""
        path = f"work/{uuid.uuid4().hex}"
        frame.write.parquet(f"{self.folder}/{path}")
        try:
            yield self.spark.read.schema(frame.schema).parquet(f"{self.folder}/{path}")
        finally:
            self._fs().delete(self._path(path), True)

    def _moved(self, delta: DataFrame) -> DataFrame:
        return state.update(self.table("images"), delta.withColumn("updated_at", F.unix_micros(F.current_timestamp()) / 1e6), "path")

    def waiting(self, status: str, box: str | None = None, limit: int | None = None) -> DataFrame:
        """path, box, layout of the images that a phase has to do, of one box or the first by path if asked."""
        return state.select_status(self.table("images"), status, box, limit).select("path", "box", "layout")

    def ingest(self, paths: DataFrame) -> int:
        """Takes in new scans; returns how many."""
        with self.recorder.stage("ingest"):
            images, added = state.insert_if_absent(self.table("images"), manifest(paths, self.cfg), "path")
            before = self.table("images").count()
            self.save(images=images)
            return self.table("images").count() - before

    def classify(self, pages: DataFrame) -> None:
        """pages: path, header, style_text, width, height, err of pending images."""
        with self.recorder.stage("classify"):
            pending = self.waiting(S.PENDING).select("path")
            with self._once(stages.classify(pages.join(pending, "path", "left_semi"), self.cfg)) as done:
                self.save(images=self._moved(done))
                self.recorder.images("classify", done.count())

    def to_locate(self, box: str | None = None, limit: int | None = None) -> DataFrame:
        """The samples that locating should try: path, layout, attempt."""
        return stages.samples(self.waiting(S.CLASSIFIED, box, limit), self.table("regions")).select("path", "layout", "attempt")

    def locate(self, found: DataFrame, box: str | None = None, limit: int | None = None) -> None:
        """found: path, found, valid and the region of the samples of ``to_locate``."""
        with self.recorder.stage("locate"):
            sides = [c for c in S.REGIONS.fieldNames() if c[-1] in "01" and c[-2] in "xy"]
            classified = self.waiting(S.CLASSIFIED, box, limit)
            used = stages.cache_use(classified, self.table("regions")).first()
            with self._once(self.to_locate(box, limit).join(found, "path")) as attempts:
                chosen = stages.chosen_attempts(attempts).select("layout", "attempt")
                new = attempts.join(chosen, ["layout", "attempt"]).select("layout", *sides, F.col("path").alias("calibrated_from"), F.lit("ocr_auto").alias("method"), F.col("valid").cast("int").alias("valid"))
                regions = self.table("regions").unionByName(S.conformed(new, S.REGIONS))
                self.save(regions=regions, images=self._moved(stages.located(classified, regions)))
            self.recorder.cache(used["hits"], used["misses"])
            self.recorder.images("locate", classified.count())

    def to_mark(self, box: str | None = None, limit: int | None = None) -> DataFrame:
        """path and the region of the located images."""
        return self.waiting(S.LOCATED, box, limit).join(self.table("regions").drop("updated_at", "calibrated_from", "method", "valid"), "layout")

    def _crops(self, decided: DataFrame, pixels: DataFrame) -> DataFrame:
        """path, crop_path, content, err of the marked rows; rows without an image have an err."""
        marked = decided.filter("has_mark = 1").select("path", "crop_path").join(self.table("images").select("path", "layout"), "path")
        marked = marked.join(self.table("regions").select("layout", "x0", "y0", "x1", "y1"), "layout")
        crops = cut(pixels.join(marked, "path"))
        lost = marked.join(pixels.select("path"), "path", "left_anti")
        return crops.unionByName(lost.select("path", "crop_path", F.lit(None).cast("binary").alias("content"), F.lit("mark: no image to crop").alias("err")))

    def mark(self, scores: DataFrame, crop_folder: str, box: str | None = None, pixels: DataFrame | None = None) -> None:
        """scores: path, oval_fill_score, line_ink_score, err of located images; pixels: those images (``images.load``).

        The crops of marked images are written before their status is; a marked image that cannot be
        cropped is an error.  Without pixels (scores from a table) only the crops' paths are kept.
        """
        with self.recorder.stage("mark"):
            with self._once(scores.join(self.waiting(S.LOCATED, box).select("path"), "path", "left_semi")) as here:
                good = here.filter("err IS NULL").select("path", "oval_fill_score", "line_ink_score")
                bad = here.filter("err IS NOT NULL").select("path", F.lit(S.ERROR).alias("status"), "err")
                self.save(results=state.upsert(self.table("results"), good, "path"), images=state.update(self._moved(good.select("path", F.lit(S.SCORED).alias("status"))), bad, "path"))
                self.recorder.images("mark", here.count())
            with self._once(stages.decide(self.table("images"), self.table("results"), self.table("regions"), self.cfg, crop_folder, box)) as decided:
                crops = self._crops(decided, pixels) if pixels is not None else self.spark.createDataFrame([], "path string, crop_path string, content binary, err string")
                with self._once(crops) as crops:
                    write_crops(crops.filter("err IS NULL"))
                    failed = crops.filter("err IS NOT NULL").select("path", F.lit(S.ERROR).alias("status"), "err")
                    decided = decided.join(failed.select("path"), "path", "left_anti")
                    results = state.update(self.table("results"), decided.select("path", "has_mark", "crop_path"), "path")
                    fresh = decided.filter("unvalidated").select("path", F.lit("unvalidated_region").alias("reason"), "crop_path")
                    review = state.delete(self.table("review"), fresh, "path").unionByName(S.conformed(fresh, S.REVIEW))
                    self.save(images=state.update(self._moved(decided.select("path", "status")), failed, "path"), results=results, review=review)

    def to_read(self, box: str | None = None, limit: int | None = None) -> DataFrame:
        """path, crop_path of the marked images."""
        return self.waiting(S.MARKED, box, limit).select("path").join(self.table("results").select("path", "crop_path"), "path")

    def read(self, replies: DataFrame, model: str | None = None) -> None:
        """replies: path, reply, err of marked images, and latency_ms, began where they were measured."""
        with self.recorder.stage("read"):
            with self._once(replies.join(self.waiting(S.MARKED).select("path"), "path", "left_semi")) as here:
                told = here.withColumn("r", parse_reply(F.col("reply"))).withColumn("err", F.coalesce("err", "r.err"))
                good = told.filter("err IS NULL").select("path", F.col("r.text").alias("vision_text"), F.col("r.oval").alias("vision_oval"), F.col("r.conf").alias("vision_conf"), F.lit(model or self.cfg.vision.model).alias("vision_model"))
                moved = told.select("path", F.when(F.col("err").isNull(), S.READ).otherwise(S.ERROR).alias("status"), "err")
                self.save(results=state.update(self.table("results"), good, "path"), images=self._moved(moved))
                self.recorder.images("read", here.count())
                if "latency_ms" in here.columns:
                    self.recorder.latency(latency(here).first().asDict())
                if "began" in here.columns:
                    self.recorder.record("vision.inflight", inflight(here).first()["most"])

    def match(self, rescore: bool = False, min_count: int = 8, min_share: float = 0.5, box: str | None = None) -> None:
        """Reads to verdicts; ``rescore`` takes every read again and leaves statuses alone."""
        with self.recorder.stage("match"):
            images, results = self.table("images"), self.table("results")
            if rescore:
                reads = results.filter("vision_text IS NOT NULL")
                if box is not None:
                    reads = reads.join(images.filter(F.col("box") == box).select("path"), "path", "left_semi")
            else:
                reads = results.join(self.waiting(S.READ, box).select("path"), "path", "left_semi")
            # Similarity is worked out once; verdicts, review, quarantine and statuses all read what it gave.
            with self._once(stages.matched(reads.select("path", "vision_text", "vision_conf", "crop_path"), self.cfg)) as done:
                results = state.set_all(state.update(results, done.select("path", "match", "match_score", "candidate"), "path"), quarantined=0)
                with self._once(stages.quarantined(images, results, self.table("regions"), self.cfg, min_count, min_share)) as held:
                    frames = {"results": state.set_where(results, held, "path", quarantined=1), "review": stages.review_after(self.table("review"), done, held)}
                    if not rescore:
                        frames["images"] = self._moved(done.select("path", F.lit(S.DONE).alias("status")))
                    self.save(**frames)
                self.recorder.images("match", done.count())

    def retry(self, status: str = S.PENDING) -> None:
        """Failed images go back to ``status``."""
        self.save(images=state.retry_errors(self.table("images"), status))

    def scoped(self) -> DataFrame:
        return summary.in_scope(self.table("images"), self.table("results"), self.cfg)

    def check(self, official: DataFrame) -> bool:
        checks = summary.reconcile(summary.filled_by_party(self.scoped()), official)
        return bool(summary.reconciled(checks).first()["ok"])
