"""Column functions over names, texts and numbers; all run inside the JVM."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import Classify, Config, Filename, java_regex


def _empty_to_null(c: Column) -> Column:
    return F.when(c != "", c)


def file_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def parsed_parts(name: Column, pattern: str) -> Column:
    """struct<box, seq> from the groups of that name; nulls where the pattern, in any case, is not found."""
    index = re.compile(pattern).groupindex
    java = f"(?i){java_regex(pattern)}"
    return F.struct(*(_empty_to_null(F.regexp_extract(name, java, index[c])).alias(c) for c in ("box", "seq")))


def parse_name(path: Column, cfg: Filename = Filename()) -> Column:
    """struct<box, seq> from the file name."""
    return parsed_parts(file_name(path), cfg.pattern)


def style_code(text: Column, cfg: Classify = Classify()) -> Column:
    """The longest code in the text, one with a letter suffix first, the earliest of equals; null if none."""
    found = F.regexp_extract_all(text, F.lit(java_regex(cfg.style_regex)), F.lit(1))
    ranked = F.transform(found, lambda code, at: F.struct(F.when(code.rlike("[A-Za-z]"), 0).otherwise(1).alias("plain"), (-F.length(code)).alias("short"), at.alias("at"), code.alias("code")))
    return F.when(F.size(found) > 0, F.element_at(F.array_sort(ranked), 1)["code"])


def layout_key(party: Column, style: Column, cfg: Classify = Classify()) -> Column:
    """party|number of the style; null without a numbered style."""
    number = _empty_to_null(F.regexp_extract(style, java_regex(cfg.numeric_regex), 1))
    return F.when(number.isNotNull(), F.concat_ws("|", F.coalesce(_empty_to_null(party), F.lit("other")), number))


def normalize(text: Column) -> Column:
    """Lower case, everything but a-z and single spaces gone."""
    return F.trim(F.regexp_replace(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), "[^a-z ]+", " "), r"\s+", " "))


def tokens(norm: Column) -> Column:
    """The words of a normalized text; none for an empty one."""
    return F.filter(F.split(norm, " "), lambda w: w != "")


def contains_any(text: Column, parts: tuple[str, ...]) -> Column:
    return reduce(lambda a, b: a | b, (F.contains(text, F.lit(p)) for p in parts), F.lit(False))


def party_label(header: Column, cfg: Config) -> Column:
    """The first configured party named in a lower-case header, else "other"."""
    out = F.lit("other")
    for p in reversed(cfg.parties):
        out = F.when(F.contains(header, F.lit(p.match)), F.lit(p.label)).otherwise(out)
    return out


def page_kind(header: Column, height: Column, cfg: Config) -> Column:
    """target_card, ballot_front, ballot_back or unknown, by the first rule that holds."""
    low, tall = F.lower(F.coalesce(header, F.lit(""))), height > cfg.classify.target_card_max_h
    return (
        F.when(F.contains(low, F.lit("target card")) | (~tall & F.contains(low, F.lit("clear ballot"))), "target_card")
        .when(contains_any(low, cfg.contest.front_markers), "ballot_front")
        .when(tall, "ballot_back")
        .otherwise("unknown")
    )


def crop_path(folder: str, box: Column, seq: Column) -> Column:
    return F.format_string(f"{folder.replace('%', '%%')}/%s_%s.png", box, seq)


def relative_delta(ours: Column, official: Column) -> Column:
    """(ours - official) / official; null where official is null or 0."""
    return F.when(official != 0, (ours - official) / official)


def bar_width(n: Column, total: Column) -> Column:
    """Per cent of the total to two places, 0.6 at least; 0.6 for a total of 0."""
    return F.round(F.greatest(F.coalesce(F.try_divide(100.0 * n, total), F.lit(0.0)), F.lit(0.6)), 2)


def title_case(name: Column) -> Column:
    return F.initcap(name)


def html_escape(text: Column) -> Column:
    out = F.coalesce(text.cast("string"), F.lit(""))
    for raw, safe in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#x27;")):
        out = F.replace(out, F.lit(raw), F.lit(safe))
    return out


def thousands(n: Column) -> Column:
    return F.format_number(n, 0)


def signed_percent(x: Column) -> Column:
    return F.when(x.isNotNull(), F.format_string("%+.1f%%", 100 * x))
