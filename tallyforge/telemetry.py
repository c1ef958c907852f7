"""Optional measurements: off by default, and a failure here never reaches the count.

A ``Recorder`` hands each measurement to its exporters, callables of (name, value, labels).  ``recorder``
sets up what the settings name: lines on the log, and the OpenTelemetry protocol over HTTP with JSON
bodies, which needs no library.  ``Recorder.close`` sends what is still held.
"""

from __future__ import annotations

import contextlib
import json
import logging
import os
import time
import urllib.request
from collections.abc import Callable, Iterator, Mapping

from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F

from .config import Telemetry

log = logging.getLogger("tallyforge")

# Kinds of the measurements, as the protocol names them.
SUMS = ("images.processed", "locate.cache")
UNITS = {"stage.duration": "s", "vision.read.latency": "ms"}


def parse_headers(text: str | None) -> dict[str, str] | None:
    """k=v pairs parted by commas; null without any."""
    pairs = dict(p.split("=", 1) for p in (text or "").split(",") if "=" in p)
    return {k.strip(): v.strip() for k, v in pairs.items()} or None


def gauges(images: DataFrame, results: DataFrame, review: DataFrame) -> DataFrame:
    """name, label, value: images by status, matches by result, size of the review queue."""
    by = lambda df, name, column: df.filter(F.col(column).isNotNull()).groupBy(F.lit(name).alias("name"), F.col(column).alias("label")).agg(F.count(F.lit(1)).alias("value"))
    queue = review.agg(F.lit("review.queue.size").alias("name"), F.lit(None).cast("string").alias("label"), F.count(F.lit(1)).alias("value"))
    return by(images, "images.by_status", "status").unionByName(by(results, "match.by_result", "match")).unionByName(queue)


def latency(reads: DataFrame) -> DataFrame:
    """n and quantiles of the vision model's latency."""
    return reads.agg(F.count("latency_ms").alias("n"), *(F.percentile_approx("latency_ms", q).alias(f"p{round(100 * q)}") for q in (0.5, 0.95, 0.99)))


def inflight(reads: DataFrame) -> DataFrame:
    """most: reads under way at once, from their beginnings (``began``, in seconds) and latencies; 0 for none.

    Beginnings and ends are added up within each second first, so the running sum goes over seconds.
    """
    ends = F.col("began") + F.coalesce("latency_ms", F.lit(0.0)) / 1000
    steps = reads.select(F.explode(F.array(F.struct(F.col("began").alias("at"), F.lit(1).alias("step")), F.struct(ends.alias("at"), F.lit(-1).alias("step")))).alias("s")).select("s.*").filter("at is not null")
    order = Window.partitionBy("second").orderBy("at", F.col("step").desc())
    within = steps.withColumn("second", F.floor("at")).withColumn("up", F.sum("step").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    seconds = within.groupBy("second").agg(F.max("up").alias("top"), F.sum("step").alias("net"))
    before = F.coalesce(F.sum("net").over(Window.orderBy("second").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return seconds.select((before + F.col("top")).alias("most")).agg(F.coalesce(F.max("most"), F.lit(0)).alias("most"))


def counted(df: DataFrame, stage: str) -> tuple[DataFrame, Observation]:
    """The frame, and an observation that holds its row count once an action has run it."""
    seen = Observation(f"rows {stage}")
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen


class OtlpExporter:
    """Measurements held and posted to <endpoint>/v1/metrics, at the interval and on ``flush``."""

    def __init__(self, cfg: Telemetry, environ: Mapping[str, str] = os.environ, post: Callable | None = None):
        base = (cfg.endpoint or environ.get("OTEL_EXPORTER_OTLP_ENDPOINT") or "http://localhost:4318").rstrip("/")
        self.url, self.headers, self.service = f"{base}/v1/metrics", {"Content-Type": "application/json", **(parse_headers(cfg.headers) or {})}, cfg.service_name
        self.every, self.sent, self.held, self.totals = cfg.export_interval_ms / 1000, time.monotonic(), {}, {}
        self.post = post or self._post

    def _post(self, url: str, body: bytes, headers: dict[str, str]) -> None:
        with urllib.request.urlopen(urllib.request.Request(url, body, headers), timeout=10):
            pass

    def __call__(self, name: str, value: float, labels: dict) -> None:
        key = (name, tuple(sorted(labels.items())))
        if name in SUMS:
            value = self.totals[key] = self.totals.get(key, 0) + value
        self.held[key] = (value, time.time_ns())
        if time.monotonic() - self.sent >= self.every:
            self.flush()

    def body(self) -> dict:
        metrics: dict[str, list] = {}
        for (name, labels), (value, at) in self.held.items():
            attributes = [{"key": k, "value": {"stringValue": str(v)}} for k, v in labels]
            metrics.setdefault(name, []).append({"asDouble": float(value), "timeUnixNano": str(at), "attributes": attributes})
        shape = lambda name, points: {"sum": {"dataPoints": points, "aggregationTemporality": 2, "isMonotonic": True}} if name in SUMS else {"gauge": {"dataPoints": points}}
        found = [{"name": f"tally.{name}", "unit": UNITS.get(name, "1"), **shape(name, points)} for name, points in metrics.items()]
        resource = {"attributes": [{"key": "service.name", "value": {"stringValue": self.service}}]}
        return {"resourceMetrics": [{"resource": resource, "scopeMetrics": [{"scope": {"name": "tallyforge"}, "metrics": found}]}]}

    def flush(self) -> None:
        self.sent = time.monotonic()
        if self.held:
            self.post(self.url, json.dumps(self.body()).encode(), self.headers)
            self.held = {}


class Recorder:
    """Measurements of a run; exporters are callables (name, value, labels), some with ``flush``."""

    def __init__(self, cfg: Telemetry, exporters: tuple[Callable, ...] = ()):
        self.cfg, self.exporters, self.seconds = cfg, exporters, {}

    def record(self, name: str, value: float, **labels) -> None:
        if not self.cfg.enabled:
            return
        for export in self.exporters:
            self._safely(export, name, value, labels)
        if self.cfg.console:
            log.info("%s %s %s", name, value, labels)

    @staticmethod
    def _safely(call: Callable, *args) -> None:
        try:
            call(*args)
        except Exception:  # noqa: BLE001  measuring never stops the count
            log.debug("measuring failed", exc_info=True)

    def images(self, stage: str, n: int) -> None:
        self.record("images.processed", n, stage=stage)

    def cache(self, hits: int, misses: int) -> None:
        self.record("locate.cache", hits, result="hit")
        self.record("locate.cache", misses, result="miss")

    def latency(self, found: dict) -> None:
        for quantile, ms in found.items():
            if quantile != "n" and ms is not None:
                self.record("vision.read.latency", ms, quantile=quantile)

    def gauges(self, images: DataFrame, results: DataFrame, review: DataFrame) -> None:
        """The state of a count; nothing is worked out while measuring is off."""
        if self.cfg.enabled:
            self._safely(lambda: [self.record(r["name"], r["value"], label=r["label"] or "") for r in gauges(images, results, review).collect()])

    @contextlib.contextmanager
    def stage(self, name: str) -> Iterator[None]:
        began = time.monotonic()
        try:
            yield
        finally:
            self.seconds[name] = time.monotonic() - began
            self.record("stage.duration", self.seconds[name], stage=name)

    def close(self) -> None:
        """Sends what exporters still hold."""
        for export in self.exporters:
            if hasattr(export, "flush"):
                self._safely(export.flush)


def recorder(cfg: Telemetry, environ: Mapping[str, str] = os.environ) -> Recorder:
    """A recorder with the exporters that the settings name."""
    return Recorder(cfg, (OtlpExporter(cfg, environ),) if cfg.enabled and cfg.otlp else ())
