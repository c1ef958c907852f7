"""Rows of words from an OCR engine's tab-separated output, and picks among them.

The engine itself is a provider (see ``providers``); parsing is native.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import Contest, Search

_KINDS = {"left": "int", "top": "int", "width": "int", "height": "int", "conf": "double"}


def parse_tsv(pages: DataFrame, key: str, tsv: str = "tsv") -> DataFrame:
    """key, line, text, left, top, width, height, conf of each word.

    The first line names the columns.  Lines with another number of cells, without text, or with
    numbers that do not parse are dropped.
    """
    lines = pages.select(key, F.split(F.regexp_replace(tsv, "\r", ""), "\n").alias("_lines"))
    rows = lines.select(key, F.split(F.element_at("_lines", 1), "\t").alias("_head"), F.posexplode("_lines").alias("line", "_line")).filter("line > 0")
    cells = rows.withColumn("_cells", F.split("_line", "\t")).filter(F.size("_cells") == F.size("_head"))
    named = cells.withColumn("_m", F.map_from_arrays("_head", "_cells"))
    out = named.select(key, "line", F.trim(F.col("_m")["text"]).alias("text"), *(F.trim(F.col("_m")[c]).try_cast(kind).alias(c) for c, kind in _KINDS.items()))
    return out.filter((F.col("text") != "") & F.concat(*_KINDS).isNotNull())


def words_of(parsed: DataFrame, key: str) -> DataFrame:
    """key and its words as an array, in the order of their lines."""
    word = F.struct("text", *_KINDS)
    return parsed.groupBy(key).agg(F.transform(F.array_sort(F.collect_list(F.struct("line", word.alias("w")))), lambda x: x["w"]).alias("words"))


def header_word(words: DataFrame, key: str, contest: Contest = Contest(), by: Search = Search()) -> DataFrame:
    """key and the surest word that begins with the contest's token, the topmost, then first, of equals."""
    hits = words.filter(F.lower("text").startswith(contest.header_token) & (F.col("conf") > by.header_conf))
    return hits.groupBy(key).agg(F.min_by(F.struct("text", "left", "top", "conf"), F.struct(-F.col("conf"), "top", "line")).alias("header")).select(key, "header.*")


def next_contest_top(words: DataFrame, key: str, x0: Column, x1: Column, header_top: Column, contest: Contest = Contest(), by: Search = Search()) -> DataFrame:
    """key and the top of the next contest's heading in the same column."""
    hit = (F.lower("text") == contest.next_contest_token) & F.col("left").between(x0, x1) & (F.col("top") > header_top + by.next_below) & (F.col("conf") > by.next_conf)
    return words.groupBy(key).agg(F.min(F.when(hit, F.col("top"))).alias("next_top"))


def label_top(words: DataFrame, key: str, y0: Column, by: Search = Search()) -> DataFrame:
    """key and the top of the label, from words read at ``label_scale`` times the size."""
    text = F.regexp_replace(F.lower("text"), "[-.]", "")
    hit = (F.col("conf") > by.label_conf) & (F.contains(text, F.lit("write")) | text.isin(*by.labels))
    return words.groupBy(key).agg(F.min(F.when(hit, y0 + F.floor(F.col("top") / by.label_scale))).cast("int").alias("label_top"))


def region_valid(text: Column) -> Column:
    """Whether the text read under a line shows the label."""
    plain = F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), "[ -]", "")
    return F.contains(plain, F.lit("writ")) | F.contains(plain, F.lit("rite"))


def read_tsv(tsv: str) -> list[dict]:
    """The words of one page in a worker, by the rules of ``parse_tsv``."""
    head, *lines = tsv.replace("\r", "").split("\n")
    names, out = head.split("\t"), []
    for line in lines:
        cells = line.split("\t")
        if len(cells) != len(names):
            continue
        row = dict(zip(names, cells, strict=True))
        try:
            word = {"text": row["text"].strip(), **{c: int(row[c].strip()) for c in ("left", "top", "width", "height")}, "conf": float(row["conf"].strip())}
        except (KeyError, ValueError):
            continue
        if word["text"]:
            out.append(word)
    return out


def label_top_of(words: list[dict], y0: int, by: Search = Search()) -> int | None:
    """The same as ``label_top`` for one page in a worker."""
    plain = ((w["text"].lower().replace("-", "").replace(".", ""), w) for w in words if w["conf"] > by.label_conf)
    return min((y0 + w["top"] // by.label_scale for text, w in plain if "write" in text or text in by.labels), default=None)
