"""OCR and vision models behind one small interface.

A provider is a callable from a list of requests to a list of replies, run over Arrow batches on the
executors with bounded concurrency.  ``TableProvider`` answers from a table of known replies, which is
what tests and reruns use; ``HttpVision`` calls a model server; ``CommandOcr`` runs a local engine.
"""

from __future__ import annotations

import base64
import json
import subprocess
import time
import urllib.request
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import Config


def parse_reply(reply: Column) -> Column:
    """struct<text, oval, conf, err> of a model's reply.

    What is not JSON is kept as the text, unsure and with confidence 0.  JSON that is no object, or
    whose confidence is no number, is an error.  A null text is blank.
    """
    raw = F.trim(reply)
    parsed = F.try_parse_json(raw)
    is_json = parsed.isNotNull() & (raw != "")
    kind = F.schema_of_variant(parsed)
    is_object = is_json & kind.startswith("OBJECT")

    def cell(path: str, default: str) -> Column:
        value = F.try_variant_get(parsed, path, "string")
        return F.coalesce(F.trim(value), F.lit(default))

    conf_raw = F.try_variant_get(parsed, "$.confidence", "string")
    conf = F.when(F.coalesce(conf_raw, F.lit("")) == "", 0.0).when(conf_raw.isin("true", "false"), conf_raw.cast("boolean").cast("double")).otherwise(conf_raw.try_cast("double"))
    bad = (is_json & ~is_object) | (is_object & conf.isNull())
    return F.struct(
        F.when(is_object & ~bad, cell("$.text", "")).when(~is_json, raw).alias("text"),
        F.when(is_object & ~bad, F.lower(cell("$.oval", "unsure"))).when(~is_json, "unsure").alias("oval"),
        F.when(is_object & ~bad, conf).when(~is_json, 0.0).alias("conf"),
        F.when(bad, F.lit("read: reply is not an object with a numeric confidence")).alias("err"),
    )


def read_with(crops: DataFrame, provider: Callable[[bytes], str], workers: int) -> DataFrame:
    """path, content -> path, reply, latency_ms, err, began (seconds since the epoch); at most ``workers`` requests at a time."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for path, content in zip(frame["path"], frame["content"]):
                began, clock = time.time(), time.monotonic()
                try:
                    out.append((path, provider(content), (time.monotonic() - clock) * 1000, None, began))
                except Exception as e:  # noqa: BLE001  a failed read is that row's error
                    out.append((path, None, None, f"read: {e}", began))
            yield pd.DataFrame(out, columns=["path", "reply", "latency_ms", "err", "began"])

    return crops.select("path", "content").repartition(workers).mapInPandas(run, "path string, reply string, latency_ms double, err string, began double")


def read_from_table(crops: DataFrame, replies: DataFrame) -> DataFrame:
    """The replies of a table (path, reply); crops without one are errors."""
    return crops.select("path").join(replies, "path", "left").withColumn("err", F.when(F.col("reply").isNull(), F.lit("read: no reply")))


@dataclass(frozen=True)
class HttpVision:
    """Asks a model server for one crop at a time."""

    config: Config
    timeout: float = 180.0

    def request(self, content: bytes) -> bytes:
        v = self.config.vision
        body = {"model": v.model, "prompt": self.config.prompt(), "images": [base64.b64encode(content).decode()], "stream": False, "format": "json", "options": {"temperature": v.temperature}}
        return json.dumps(body).encode()

    def __call__(self, content: bytes) -> str:
        request = urllib.request.Request(self.config.vision.url, self.request(content), {"Content-Type": "application/json"})
        with urllib.request.urlopen(request, timeout=self.timeout) as answer:
            return json.loads(answer.read()).get("response", "").strip()


@dataclass(frozen=True)
class CommandOcr:
    """Runs an OCR command on the bytes of a picture; its standard output is the reply."""

    command: tuple[str, ...] = ("tesseract", "-", "stdout")
    timeout: float = 180.0

    def __call__(self, content: bytes, *more: str) -> str:
        return subprocess.run([*self.command, *more], input=content, capture_output=True, timeout=self.timeout, check=False).stdout.decode("utf-8", "replace")

    def text(self, content: bytes, psm: int) -> str:
        return self(content, "--psm", str(psm))

    def table(self, content: bytes, psm: int) -> str:
        return self(content, "--psm", str(psm), "tsv")
