"""The command line: python -m tallyforge <what> [--state folder] [--box AB-1] [--limit n] ..."""

from __future__ import annotations

import argparse
import json
import os
import sys
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import SparkSession

from . import telemetry
from .config import Config, load
from .operators import summary
from .plans import phases, report
from .plans.run import Count
from .sources import files, scan
from .sources.providers import CommandOcr, HttpVision
from .streaming.watch import watch

ACTIONS = (*phases.PHASES, "all", "watch", "rescore", "retry", "status", "coverage", "reconcile", "manifest", "report", "export")


def arguments(given: list[str]) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="tallyforge", description="Counts marked pages of scanned documents.")
    parser.add_argument("what", choices=ACTIONS, nargs="?", default="all")
    parser.add_argument("--config", help="settings (TOML)")
    parser.add_argument("--state", default="state", help="folder of the count's tables")
    parser.add_argument("--root", help="folder of the box folders")
    parser.add_argument("--crops", help="folder of the crops (default: <state>/crops)")
    parser.add_argument("--box", help="only this box")
    parser.add_argument("--limit", type=int, default=0, help="at most so many images")
    parser.add_argument("--read-workers", type=int, help="concurrent requests to the vision model")
    parser.add_argument("--official", help="official totals (JSON)")
    parser.add_argument("--every", type=int, default=60, help="seconds between two looks of watch; 0: look once")
    parser.add_argument("--out", help="file or folder to write")
    parser.add_argument("--title", default="Count")
    return parser.parse_args(given)


def _settings(args: argparse.Namespace) -> Config:
    cfg = load(args.config)
    if args.root:
        cfg = replace(cfg, images_root=args.root)
    if args.read_workers:
        cfg = replace(cfg, vision=replace(cfg.vision, read_workers=args.read_workers))
    return cfg


def statuses(count: Count) -> dict[str, int]:
    return {r["status"]: r["n"] for r in summary.counts_by(count.table("images"), "status").collect()}


def coverage(count: Count) -> dict:
    """Boxes on disk, ingested and missing, and the first five that are missing."""
    boxes = scan.list_boxes(count.spark, count.cfg.images_root, count.cfg)
    images = count.table("images")
    if boxes is None:
        return {"on_disk": None, "ingested": images.select("box").distinct().count(), "missing": None, "first": []}
    return {**summary.coverage(boxes, images, "box").first().asDict(), "first": [r["box"] for r in summary.missing(boxes, images, "box").limit(5).collect()]}


def reconcile(count: Count, official: str | None, say: Callable) -> bool:
    checks = summary.reconcile(summary.filled_by_party(count.scoped()), files.official_totals(count.spark, official))
    for r in checks.orderBy("party").collect():
        say(f"{r['party']}: ours {r['ours']}, official {r['official']}" + ("" if r["delta"] is None else f", {r['delta']:+.1%}" + ("" if r["ok"] else " OUT OF TOLERANCE")))
    return bool(summary.reconciled(checks).first()["ok"])


def main(given: list[str], spark: SparkSession | None = None, ocr=None, vision: Callable | None = None, say: Callable = print) -> int:
    """Returns 1 where reconciliation failed."""
    args = arguments(given)
    cfg = _settings(args)
    spark = spark or SparkSession.builder.appName("tallyforge").getOrCreate()
    recorder = telemetry.recorder(cfg.telemetry)
    count = Count(spark, args.state, cfg, recorder)
    work = phases.Work(cfg.images_root, args.crops or os.path.abspath(f"{args.state}/crops"), ocr or CommandOcr(), vision or HttpVision(cfg))
    limit, ok = args.limit or None, True
    try:
        if args.what in (*phases.PHASES, "all"):
            phases.run(count, work, args.what, args.box, limit)
        elif args.what == "watch":
            watch(spark, cfg.images_root, f"{args.state}/arrived", f"{args.state}/arrivals", cfg, f"{args.every} seconds" if args.every else None).awaitTermination()
        elif args.what == "rescore":
            count.match(rescore=True, box=args.box)
        elif args.what == "retry":
            count.retry()
        elif args.what == "export":
            files.write_tables(count.table("results"), count.table("review"), args.out or f"{args.state}/tables")
        elif args.what in ("manifest", "report"):
            there = phases.crop_files(spark, work.crops).select("crop_path")
            found = report.collect(count, files.official_totals(spark, args.official), scan.list_boxes(spark, cfg.images_root, cfg), there)
            if args.what == "manifest":
                report.write_manifest(found, args.out or "manifest.json")
            else:
                with open(args.out or "report.html", "w", encoding="utf-8") as f:
                    f.write(report.render(found, args.title))
        if args.what in ("ingest", "all", "coverage"):
            say("coverage:", json.dumps(coverage(count)))
        say("status:", json.dumps(statuses(count), sort_keys=True))
        # A run over all boxes is a whole tally: it is held against the official totals.
        if args.what == "reconcile" or args.what in ("match", "all") and not args.box:
            ok = reconcile(count, args.official, say)
    finally:
        recorder.close()
    return 0 if ok else 1


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
