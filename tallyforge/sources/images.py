"""Gray images and the worker-side stages that need pixels.

Images are decoded by Spark's image source.  Locating and marking are map stages over Arrow batches;
a failure in one row becomes that row's ``err``.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schema as S
from ..config import Config
from ..functions import raster
from . import ocr


def load(spark: SparkSession, path: str | list[str], keep_invalid: bool = False) -> DataFrame:
    """path (as listed files have it), width, height, channels, data of the images that decode.

    With ``keep_invalid`` also err, and the rows of files that do not decode, whose other columns are null.
    """
    images = spark.read.format("image").option("dropInvalid", not keep_invalid).load(path)
    # The origin is an encoded URI (file:///a%20b for file:/a b); decoding would take a plus for a space.
    origin = F.url_decode(F.replace(F.col("image.origin"), F.lit("+"), F.lit("%2B")))
    rows = images.select(F.regexp_replace(origin, "^file:///", "file:/").alias("path"), F.col("image.width").alias("width"), F.col("image.height").alias("height"), F.col("image.nChannels").alias("channels"), F.col("image.data").alias("data"))
    if not keep_invalid:
        return rows
    bad = F.col("width") <= 0
    return rows.select("path", *(F.when(~bad, F.col(c)).alias(c) for c in ("width", "height", "channels", "data")), F.when(bad, "the image does not decode").alias("err"))


def enlarged(image: np.ndarray, times: int) -> np.ndarray:
    """Each pixel as a square of so many."""
    return image.repeat(times, axis=0).repeat(times, axis=1)


def read_bands(images: DataFrame, engine, cfg: Config) -> DataFrame:
    """images (``load`` with invalid ones) -> path, header, style_text, width, height, err: what classifying needs.

    ``engine.text(png, psm)`` gives what OCR reads on a picture; a failure is that row's error.
    """
    bands = ((cfg.classify.header_band, cfg.search.header_psm), (cfg.classify.style_band, cfg.search.style_psm))

    def one(row: dict) -> tuple:
        if row["err"] is not None:
            return (row["path"], None, None, None, None, row["err"])
        size = row["width"], row["height"]
        try:
            image = gray(row["data"], *size, row["channels"])
            texts = [engine.text(raster.png(raster.crop(image, raster.to_pixels(band, *size))), psm) for band, psm in bands]
            return (row["path"], *texts, *size, None)
        except Exception as e:  # noqa: BLE001  one bad page is a value, not a failed job
            return (row["path"], None, None, *size, str(e))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield pd.DataFrame([one(r) for r in _records(frame)], columns=["path", "header", "style_text", "width", "height", "err"]).astype({"width": "Int32", "height": "Int32"})

    return images.mapInPandas(run, "path string, header string, style_text string, width int, height int, err string")


def read_words(images: DataFrame, engine, cfg: Config) -> DataFrame:
    """images with words, the OCR rows of the whole page; an empty list where reading fails."""
    words = T.StructType([*images.schema.fields, T.StructField("words", S.WORDS)])

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            found = []
            for row in _records(frame):
                try:
                    found.append(ocr.read_tsv(engine.table(raster.png(gray(row["data"], row["width"], row["height"], row["channels"])), cfg.search.page_psm)))
                except Exception:  # noqa: BLE001  the next sample of the layout is tried
                    found.append([])
            yield frame.assign(words=found)

    return images.mapInPandas(run, words)


def label_finder(engine, cfg: Config) -> Callable:
    """What ``locate`` asks for the label's top: the window enlarged, its words, the topmost label."""

    def find(image: np.ndarray, window: raster.Box) -> int | None:
        part = enlarged(raster.crop(image, window), cfg.search.label_scale)
        return ocr.label_top_of(ocr.read_tsv(engine.table(raster.png(part), cfg.search.label_psm)), window[1], cfg.search)

    return find


def strip_reader(engine, cfg: Config) -> Callable:
    """What ``locate`` asks for the print under the line: the strip enlarged, as text."""
    return lambda image, box: engine.text(raster.png(enlarged(raster.crop(image, box), cfg.search.strip_scale)), cfg.search.label_psm)


def _records(frame: pd.DataFrame) -> list[dict]:
    """Rows with None for what is missing and whole sizes."""
    out = []
    for row in frame.to_dict("records"):
        row = {k: None if isinstance(v, float) and v != v else v for k, v in row.items()}
        out.append({k: int(v) if k in ("width", "height", "channels") and v is not None else v for k, v in row.items()})
    return out


def gray(data: bytes, width: int, height: int, channels: int) -> np.ndarray:
    """8-bit luma of a decoded image (blue, green, red order where it has colours)."""
    pixels = np.frombuffer(data, np.uint8).reshape(height, width, channels)
    if channels == 1:
        return pixels[:, :, 0]
    b, g, r = (pixels[:, :, i].astype(np.uint32) for i in range(3))
    return ((r * 299 + g * 587 + b * 114) // 1000).astype(np.uint8)


def _box(row, names: tuple[str, ...]) -> tuple[float, ...]:
    return tuple(row[n] for n in names)


def score_ink(images: DataFrame, cfg: Config) -> DataFrame:
    """images with their layout's region (x0..y1, ox0..oy1 in fractions) -> path, oval_fill_score, line_ink_score, err."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for row in frame.to_dict("records"):
                try:
                    image = gray(row["data"], row["width"], row["height"], row["channels"])
                    size = row["width"], row["height"]
                    region = raster.to_pixels(_box(row, ("x0", "y0", "x1", "y1")), *size)
                    oval = raster.to_pixels(_box(row, ("ox0", "oy0", "ox1", "oy1")), *size)
                    out.append((row["path"], *raster.ink_scores(image, region, oval, cfg.locate.dark, cfg.mark), None))
                except Exception as e:  # noqa: BLE001  one bad image is a value, not a failed job
                    out.append((row["path"], None, None, f"mark: {e}"))
            yield pd.DataFrame(out, columns=["path", "oval_fill_score", "line_ink_score", "err"])

    return images.mapInPandas(run, "path string, oval_fill_score double, line_ink_score double, err string")


def cut(images: DataFrame) -> DataFrame:
    """images with crop_path and their layout's region (x0..y1 in fractions) -> path, crop_path, content (PNG), err."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for row in frame.to_dict("records"):
                try:
                    size = row["width"], row["height"]
                    image = gray(row["data"], *size, row["channels"])
                    content = raster.png(raster.crop(image, raster.to_pixels(_box(row, ("x0", "y0", "x1", "y1")), *size)))
                    out.append((row["path"], row["crop_path"], content, None))
                except Exception as e:  # noqa: BLE001  one bad image is a value, not a failed job
                    out.append((row["path"], row["crop_path"], None, f"mark: {e}"))
            yield pd.DataFrame(out, columns=["path", "crop_path", "content", "err"])

    return images.mapInPandas(run, "path string, crop_path string, content binary, err string")


REGION = "x0 double, y0 double, x1 double, y1 double, ox0 double, oy0 double, ox1 double, oy1 double"


def locate(images: DataFrame, label_top: Callable, read_text: Callable, cfg: Config) -> DataFrame:
    """images with words (OCR rows of the page) -> path, found, valid and the region in fractions.

    ``label_top(gray, window)`` gives the label's top or None; ``read_text(gray, box)`` what is printed
    in a box.  A row whose kernels fail counts as nothing found.
    """
    names = [c.split()[0] for c in REGION.split(", ")]

    def one(row: dict) -> tuple:
        image = gray(row["data"], row["width"], row["height"], row["channels"])
        words = [dict(w) if not isinstance(w, dict) else w for w in row["words"]]
        header = find_header(words, cfg)
        window = header and raster.search_window(header, words, (row["width"], row["height"]), cfg)
        line = window and raster.find_line(image, header, words, label_top(image, window), cfg)
        if not line:
            return (False, False, *[None] * 8)
        loc, w, h = cfg.locate, row["width"], row["height"]
        region = (line.col_x0, line.y - loc.region_top_off, line.col_x1, line.y + loc.region_bot_off)
        oval = (line.start - loc.oval_left_off, line.y - loc.oval_top_off, line.start - loc.oval_right_off, line.y + loc.oval_bot_off)
        by = cfg.search
        valid = raster.label_seen(read_text(image, (region[0], region[3] - by.label_strip_above, region[2], region[3] + by.label_strip_below)))
        return (True, valid, *(v / (w, h)[i % 2] for i, v in enumerate(region + oval)))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for row in frame.to_dict("records"):
                try:
                    out.append((row["path"], *one(row)))
                except Exception:  # noqa: BLE001  the next sample of the layout is tried
                    out.append((row["path"], False, False, *[None] * 8))
            yield pd.DataFrame(out, columns=["path", "found", "valid", *names])

    return images.mapInPandas(run, f"path string, found boolean, valid boolean, {REGION}")


def find_header(words: list[dict], cfg: Config) -> dict | None:
    """The surest word that begins with the contest's token, the topmost of equals (``ocr.header_word`` in a worker)."""
    rank = {i: (w["conf"], -w["top"]) for i, w in enumerate(words) if w["conf"] > cfg.search.header_conf and w["text"].lower().startswith(cfg.contest.header_token)}
    return words[max(rank, key=rank.get)] if rank else None
