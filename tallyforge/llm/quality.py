"""Quality rules with adaptive thresholds per language and source.

``measure`` counts, in one pass over the whole texts, words, symbols, repeated lines and repeated
three-word windows.  ``sketch`` keeps, per (lang, source) and ratio, a quantile sketch of logarithmic
buckets: counts per bucket add up, so sketches of any two parts merge by summing, and a quantile is
known within RELATIVE of its value.  ``thresholds`` reads the quartiles off and sets a fence beyond
which a document is an outlier, and ``judge`` joins the fences back.

A document is an outlier by

* marks: its share of ASCII marks and digits among characters, and its symbols per word, both lie above the
  median by SPREADS times the distance from median to upper quartile;
* word length: the mean lies as far from the median on either side (lower quartile below);
* repeated lines or words: more than TAIL beyond the group's 95th percentile (in units of its distance
  from the median), since most documents repeat nothing and quartiles are zero.

Spreads count as no less than chance would give a document of its length (``_noise``), and one repeated line
or one window said twice is never an outlier; nothing else is fixed.  An outlier of its group must be one of
its language as well: a group that consists mostly of junk, or of copies, does not condemn the rest.
Groups of fewer than LEAST documents take the fences of their language, or else of the whole table.

Words are runs without the six ASCII white-space characters.  A null text has none; null languages
and sources form groups of their own.  base_failed: under 50 words, or more than half of the words
in repeated windows.  Repeated rows count each; empty tables give empty results.
"""

from __future__ import annotations

import math
import operator
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import bounded_batches, written

SYMBOLS = "#*$%&|<>"
LEAST_WORDS = 50
MOST_REPEATED = 50  # per cent of the words
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
MARKS = bytes(c for c in range(0x21, 0x7F) if not chr(c).isalpha())
RULES = ["mark_share", "symbol_ratio", "word_length", "dup_line_ratio", "repeat_ratio"]
#: Styles differ more in the length of words than in marks.
SPREADS, TAIL = {"mark_share": 5.0, "symbol_ratio": 5.0, "word_length": 10.0}, 3.0
#: Standard deviation of the length of a word, in letters.
LETTERS = 2.5
FINEST = {"n_words": 100, "word_chars": 500}
#: Words of one window said twice.
ONE_REPEAT = 6
#: Of quantiles.
RELATIVE = 0.001
LEAST = 100
#: Rows of thresholds that may be broadcast; beyond, rows and thresholds are joined by salted shuffling.
MOST_BROADCAST = 50_000
SALTS = 32
_GROWTH = math.log((1 + RELATIVE) / (1 - RELATIVE))
_SPACES = b" \t\n\v\f\r"


def counts(text: bytes) -> tuple[int, ...]:
    """COUNTS of one text, its number of lines with a word, and of marks."""
    words = text.split()  # bytes part at exactly the six characters
    n = len(words)
    chars = sum(map(len, words))
    if not text.isascii():
        chars = len(text.decode()) - sum(map(text.count, (bytes((c,)) for c in _SPACES)))
    symbols = sum(text.count(c.encode()) for c in SYMBOLS)
    lines = [x for x in text.split(b"\n") if x.strip()]
    repeated = 0
    if n > 3:
        threes = list(zip(words, words[1:], words[2:]))
        if len(set(threes)) < len(threes):
            times, end = Counter(threes), 0
            for i, three in enumerate(threes):
                if times[three] > 1:
                    repeated += i + 3 - max(i, end)
                    end = i + 3
    return n, chars, symbols, len(lines) - len(set(lines)), repeated, len(lines), len(text) - len(text.translate(None, MARKS))


def measure(docs: DataFrame, keep: list[str]) -> DataFrame:
    """The columns ``keep`` of ``docs`` with COUNTS, n_lines and n_marks."""
    bounded_batches(docs.sparkSession)
    schema = docs.select(*keep).schema
    for c in [*COUNTS, "n_lines", "n_marks"]:
        schema = schema.add(c, "long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [counts(t or b"") for t in batch.column("_bytes").to_pylist()]
            own = [batch.column(c) for c in keep]
            yield pa.RecordBatch.from_arrays(own + [pa.array([x[i] for x in found], pa.int64()) for i in range(len(COUNTS) + 2)], names=schema.names)

    return docs.select(*keep, F.col("text").cast("binary").alias("_bytes")).mapInArrow(run, schema)


def _at_least_one(column: str) -> Column:
    return F.greatest(column, F.lit(1))


def _ratios() -> dict[str, Column]:
    words, lines = _at_least_one("n_words"), _at_least_one("n_lines")
    return {
        "mark_share": F.col("n_marks") / _at_least_one("word_chars"),
        "symbol_ratio": F.col("n_symbols") / words,
        "word_length": F.col("word_chars") / words,
        "dup_line_ratio": F.col("n_dup_lines") / lines,
        "repeat_ratio": F.col("n_repeat_words") / words,
    }


def _noise(rule: str, mid: Column) -> Column:
    """How far chance moves a ratio of a document of its length from ``mid``: counts vary with their root, and by one at least.

    Longer documents than FINEST words or characters are not judged more finely: they differ in style.
    """
    part = "word_chars" if rule == "mark_share" else "n_words"
    of = F.least(_at_least_one(part), F.lit(FINEST[part]))
    return F.lit(LETTERS) / F.sqrt(of) if rule == "word_length" else F.sqrt(mid / of) + 1.0 / of


def base_failed() -> Column:
    return (F.col("n_words") < LEAST_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * MOST_REPEATED)


def _level() -> Column:
    """Three groupings of each row: its own group, its language, the whole table."""
    return F.explode(F.array(*(F.struct(F.lit(i).alias("level"), lang.alias("g_lang"), source.alias("g_source")) for i, (lang, source) in enumerate(
        ((F.col("lang"), F.col("source")), (F.col("lang"), F.lit(None).cast("string")), (F.lit(None).cast("string"), F.lit(None).cast("string")))))))


def sketch(measured: DataFrame) -> DataFrame:
    """level, g_lang, g_source, rule, bucket, n: mergeable by summing n.  Zero has a bucket of its own."""
    one = F.explode(F.array(*(F.struct(F.lit(name).alias("rule"), ratio.alias("value")) for name, ratio in _ratios().items())))
    bucket = F.when(F.col("one.value") > 0, F.ceil(F.log("one.value") / F.lit(_GROWTH)).cast("int")).otherwise(F.lit(-(1 << 20)))
    own = measured.select("lang", "source", one.alias("one")).groupBy("lang", "source", F.col("one.rule").alias("rule"), bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("n"))
    return own.select(_level().alias("g"), "rule", "bucket", "n").groupBy("g.level", "g.g_lang", "g.g_source", "rule", "bucket").agg(F.sum("n").alias("n"))


#: What a group's fences are made of: medians, distances to the quartiles, and fences in the tail.
LIMITS = ["mark_share_mid", "mark_share_up", "symbol_ratio_mid", "symbol_ratio_up", "word_length_mid", "word_length_down", "word_length_up", "dup_line_ratio_tail", "repeat_ratio_tail"]


def thresholds(sketches: DataFrame) -> DataFrame:
    """level, g_lang, g_source, members and LIMITS."""
    group = Window.partitionBy("level", "g_lang", "g_source", "rule")
    ranked = sketches.withColumn("_to", F.sum("n").over(group.orderBy("bucket"))).withColumn("_of", F.sum("n").over(group))
    value = F.when(F.col("bucket") == -(1 << 20), 0.0).otherwise(2 * F.exp(F.col("bucket") * F.lit(_GROWTH)) / F.lit(1 + math.exp(_GROWTH)))
    at = [F.min(F.when(F.col("_to") >= F.col("_of") * q, value)).alias(f"_q{i}") for i, q in enumerate((0.25, 0.5, 0.75, 0.95))]
    found = ranked.groupBy("level", "g_lang", "g_source", "rule").agg(F.max("_of").alias("members"), *at)
    parts = {"mid": F.col("_q1"), "down": F.col("_q1") - F.col("_q0"), "up": F.col("_q2") - F.col("_q1"), "tail": F.col("_q3") + TAIL * (F.col("_q3") - F.col("_q1"))}
    limits = [F.max(F.when(F.col("rule") == c.rsplit("_", 1)[0], parts[c.rsplit("_", 1)[1]])).alias(c) for c in LIMITS]
    return found.groupBy("level", "g_lang", "g_source").agg(F.max("members").alias("members"), *limits)


def _outlier(of: str) -> list[Column]:
    """By which rules a document lies beyond the fences whose columns begin with ``of``."""
    ratios = _ratios()
    limit = lambda name: F.col(f"{of}_{name}")

    def beyond(rule: str, side: str) -> Column:
        away = ratios[rule] - limit(f"{rule}_mid")
        return (away if side == "up" else -away) > SPREADS[rule] * F.greatest(limit(f"{rule}_{side}"), _noise(rule, limit(f"{rule}_mid")))

    marks = beyond("mark_share", "up") & beyond("symbol_ratio", "up")
    length = beyond("word_length", "up") | beyond("word_length", "down")
    lines = F.col("n_dup_lines") > limit("dup_line_ratio_tail") * F.col("n_lines") + 1
    repeats = F.col("n_repeat_words") > limit("repeat_ratio_tail") * F.col("n_words") + ONE_REPEAT
    return [marks, length, lines, repeats]


def judge(measured: DataFrame, fences: DataFrame) -> DataFrame:
    """``measured`` with base_failed, kept and the level of the fences that decided."""
    fences = written(fences, "quality-fences")
    tagged = measured
    # A key for nulls keeps a null language apart from the language "".
    key = F.concat_ws("\x1f", F.coalesce(F.concat(F.lit("="), "lang"), F.lit("-")), F.coalesce(F.concat(F.lit("="), "source"), F.lit("-")))
    whole = fences.filter("level = 2")
    langs = fences.filter("level = 1")
    own = fences.filter("level = 0")
    f = own.alias("f").join(F.broadcast(langs.alias("l")) if _small(langs) else langs.alias("l"), F.expr("f.g_lang <=> l.g_lang")).join(F.broadcast(whole.alias("w")), F.expr("w.level = f.level + 2"))  # whole: one row
    picked = f.select(
        F.col("f.g_lang").alias("lang"), F.col("f.g_source").alias("source"),
        F.expr(f"CASE WHEN f.members >= {LEAST} THEN 0 WHEN l.members >= {LEAST} THEN 1 ELSE 2 END").alias("fence_level"),
        *(F.expr(f"CASE WHEN f.members >= {LEAST} THEN f.{c} WHEN l.members >= {LEAST} THEN l.{c} ELSE w.{c} END").alias(f"own_{c}") for c in LIMITS),
        *(F.expr(f"CASE WHEN l.members >= {LEAST} THEN l.{c} ELSE w.{c} END").alias(f"wide_{c}") for c in LIMITS),
    ).select(key.alias("_key"), "fence_level", *(f"{of}_{c}" for of in ("own", "wide") for c in LIMITS))
    if _small(own):
        joined = tagged.withColumn("_key", key).join(F.broadcast(picked), "_key", "left")
    else:
        salted = picked.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        joined = tagged.withColumn("_key", key).withColumn("_salt", F.pmod(F.xxhash64("doc_id", "n_words", "word_chars"), F.lit(SALTS)).cast("int")).join(salted, ["_key", "_salt"], "left").drop("_salt")
    # Each rule by itself: beyond the fence of the group and of the language.
    out = reduce(operator.or_, (a & b for a, b in zip(_outlier("own"), _outlier("wide"), strict=True)))
    judged = joined.withColumn("base_failed", base_failed()).withColumn("kept", ~F.col("base_failed") & ~F.coalesce(out, F.lit(False)))
    return judged.drop("_key", *(f"{of}_{c}" for of in ("own", "wide") for c in LIMITS))


def _small(fences: DataFrame) -> bool:
    return len(fences.limit(MOST_BROADCAST + 1).select("level").collect()) <= MOST_BROADCAST


def quality(docs: DataFrame) -> DataFrame:
    """doc_id, COUNTS, base_failed, kept, fence_level; one row per document."""
    measured = written(measure(docs, ["doc_id", "lang", "source"]), "quality-counts")
    judged = judge(measured, thresholds(sketch(measured)))
    return judged.select("doc_id", *COUNTS, "base_failed", "kept", "fence_level")


def keep_good(docs: DataFrame) -> DataFrame:
    """The documents that pass; columns unchanged."""
    columns = docs.columns
    plain = docs.select(*(F.col(c).alias(f"_own_{c}") for c in columns), "lang", "source", "text")
    measured = written(measure(plain, [f"_own_{c}" for c in columns] + ["lang", "source"]), "quality-counts")
    kept = judge(measured.withColumn("doc_id", F.col("_own_doc_id")), thresholds(sketch(measured))).filter("kept")
    return kept.select(*(F.col(f"_own_{c}").alias(c) for c in columns))
