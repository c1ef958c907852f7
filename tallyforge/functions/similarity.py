"""How alike texts are, and which known name a text stands for.

The similarity ratio is 2 M / T, where M counts the characters in common blocks: the longest common
block first (the earliest in the first text, then in the second), then the same on either side of it.
It depends on the order of its arguments.  It has no counterpart among the built-in functions and runs
as a pandas UDF, on distinct texts only.
"""

from __future__ import annotations

from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from ..config import Config, Target
from .text import normalize, tokens

ONE_EDIT, NAMED = 0.99, 0.95
LEAST_EDITED = 4


def ratio_of(a: str, b: str) -> float:
    return SequenceMatcher(None, a, b).ratio()


class Matchers:
    """Ratios to few second texts: what the library prepares of a second text is kept."""

    def __init__(self):
        self.known: dict[str, SequenceMatcher] = {}

    def best(self, many, b: str) -> float | None:
        """The greatest ratio of any of the texts to ``b``; texts whose upper bounds stay below it are not compared."""
        if (m := self.known.get(b)) is None:
            m = self.known[b] = SequenceMatcher(None, "", b)
        best = None
        for a in many:
            m.set_seq1(a)
            if best is None or m.real_quick_ratio() > best and m.quick_ratio() > best:
                best = max(m.ratio(), best or 0.0)
        return best


@F.pandas_udf(DoubleType())
def ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    matchers = Matchers()
    return pd.Series([None if x is None or y is None else matchers.best([x], y) for x, y in zip(a, b)], dtype="float64")


@F.pandas_udf(DoubleType())
def best_ratio(many: pd.Series, b: pd.Series) -> pd.Series:
    """The greatest ratio of any of the texts to ``b``; null for none."""
    matchers = Matchers()
    return pd.Series([matchers.best(xs, y) for xs, y in zip(many, b)], dtype="float64")


def reachable(a: Column, b: Column) -> Column:
    """An upper bound of the ratio, from the lengths alone."""
    return 2.0 * F.least(F.length(a), F.length(b)) / F.greatest(F.length(a) + F.length(b), F.lit(1))


def one_edit(candidates: Column, term: str) -> Column:
    """Whether one of the candidates, of four letters or more, is at most one edit from the term."""
    return F.exists(candidates, lambda c: (F.length(c) >= LEAST_EDITED) & (F.levenshtein(c, F.lit(term)) <= 1))


def target_scores(norms: DataFrame, term: str, column: str = "norm") -> DataFrame:
    """column, score: how well each distinct normalized text matches the term.

    Empty 0, containing the term 1, one edit away 0.99, else the best ratio of a word or the whole.
    """
    texts = norms.select(column).distinct()
    words = F.concat(tokens(F.col(column)), F.array(column))
    quick = F.when(F.col(column) == "", 0.0).when(F.contains(F.col(column), F.lit(term)), 1.0).when(one_edit(words, term), ONE_EDIT)
    ruled = texts.withColumn("score", quick)
    rest = ruled.filter("score is null").select(column, best_ratio(words, F.lit(term)).alias("score"))
    return ruled.filter("score is not null").unionByName(rest)


def match_gate(score: Column, conf: Column, target: Target) -> Column:
    """The target's term, review, or not_ and the term."""
    return (
        F.when((score >= F.lit(target.strict)) & (conf >= F.lit(target.low_conf)), target.term)
        .when(score >= F.lit(target.review_low), "review")
        .otherwise(f"not_{target.term}")
    )


def alias_rows(cfg: Config) -> list[tuple[str, str, int, bool, float]]:
    """name, alias, position, whether it is a surname, threshold; a surname is one word of a longer name."""
    rows = []
    for c in cfg.candidates:
        for alias in c.aliases:
            surname = len(c.name.split()) > 1 and len(alias.split()) == 1
            rows.append((c.name, alias, len(rows), surname, cfg.target.surname_fuzz if surname else cfg.target.canon_strict))
    return rows


def folded_names(norms: DataFrame, cfg: Config, column: str = "norm") -> DataFrame:
    """column, candidate: the known name that each distinct normalized text folds onto, else the text itself.

    Texts with a negation stay as they are.  The best alias at or above its threshold wins, the first
    in configured order among equals.
    """
    fuzzy = cfg.target.min_alias
    texts = norms.select(column).distinct()
    free = (F.col(column) != "") & ~F.arrays_overlap(F.split(column, " "), F.array(*map(F.lit, cfg.negations)))
    rows = alias_rows(cfg)
    if not rows:
        return texts.withColumn("candidate", F.col(column))
    alias = F.array(*(F.struct(*(F.lit(v).alias(k) for k, v in zip(("name", "alias", "at", "surname", "threshold"), r, strict=True))) for r in rows))
    pairs = texts.filter(free).select(column, F.explode(alias).alias("a")).select(column, "a.*")
    loose = F.col("surname") & (F.length("alias") >= fuzzy)
    words = F.when(loose, F.filter(tokens(F.col(column)), lambda w: F.length(w) >= fuzzy)).otherwise(F.array().cast("array<string>"))
    # Texts that cannot reach the threshold, by their lengths, never get to the Python worker.
    near = F.filter(F.concat(F.array(column), words), lambda w: reachable(w, F.col("alias")) >= F.col("threshold"))
    named = F.when(loose & F.contains(F.col(column), F.col("alias")), NAMED).otherwise(0.0)
    asked = pairs.select("*", near.alias("_near"), named.alias("_named")).filter((F.size("_near") > 0) | (F.col("_named") > 0))
    scored = asked.withColumn("_score", F.greatest(best_ratio("_near", F.col("alias")), "_named"))
    best = scored.filter("_score >= threshold and _score > 0").groupBy(column).agg(F.max_by("name", F.struct("_score", -F.col("at"))).alias("_name"))
    return texts.join(best, column, "left").select(column, F.coalesce("_name", column).alias("candidate"))


def with_norm(df: DataFrame, text: str = "vision_text") -> DataFrame:
    return df.withColumn("norm", normalize(F.col(text)))
