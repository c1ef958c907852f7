"""The given tables read as a count's tables, in Spark and, word for word, in SQL.

Every part stands for a scanned page: its name, damaged by rule, is what was read from it.  Orders
stand for images (status, layout = customer), line items for ink measurements.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import Candidate, Config, Target

CONFIG = Config(
    target=Target(term="widget"),
    candidates=(
        Candidate("widget", ("widget",)),
        Candidate("large gear", ("large gear", "gear")),
        Candidate("hot anvil", ("hot anvil", "heated anvil", "anvil")),
        Candidate("small plate", ("small plate", "plate")),
        Candidate("blue gizmo", ("blue gizmo",)),
    ),
)

NOISE = """CASE p_partkey % 8
  WHEN 0 THEN replace(p_name, 'i', 'e')
  WHEN 1 THEN replace(replace(p_name, 'i', 'e'), 't', '')
  WHEN 2 THEN 'not ' || p_name
  WHEN 3 THEN ''
  WHEN 4 THEN upper(p_name) || '!'
  ELSE p_name END"""
PARTY = "CASE p_partkey % 5 WHEN 0 THEN 'Democratic' WHEN 1 THEN 'Democratic' WHEN 4 THEN 'other' ELSE 'Republican' END"
OVAL = "CASE p_partkey % 3 WHEN 0 THEN 'filled' WHEN 1 THEN 'empty' ELSE 'unsure' END"
STATUS = "CASE p_partkey % 10 WHEN 9 THEN 'read' ELSE 'done' END"
PATH = "'scans/AB-' || CAST(p_size AS STRING) || '/AB-' || CAST(p_size AS STRING) || '+' || CAST(p_partkey AS STRING) || '.jpg'"


def _columns(number: str) -> str:
    return f"""{PATH} AS path, 'AB-' || CAST(p_size AS STRING) AS box, CAST(p_partkey AS STRING) AS seq, {STATUS} AS status, {PARTY} AS party,
    p_brand AS layout, {NOISE} AS vision_text, {OVAL} AS vision_oval, (p_partkey * 37 % 100) / {number} AS vision_conf,
    CASE WHEN p_partkey % 4 < 3 THEN 'crops/AB-' || CAST(p_size AS STRING) || '_' || CAST(p_partkey AS STRING) || '.png' END AS crop_path"""


#: A WITH item: the reads.
READS = f"reads AS (SELECT {_columns('100.0').replace('AS STRING', 'AS VARCHAR')} FROM part)"


def reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = spark.read.parquet(f"{sf_dir}/part.parquet")
    return part.selectExpr(*_split(_columns("100.0D")))


def _split(columns: str) -> list[str]:
    """The select list's items (no item holds a comma outside brackets)."""
    out, depth, item = [], 0, ""
    for c in columns:
        depth += (c == "(") - (c == ")")
        if c == "," and depth == 0:
            out.append(item)
            item = ""
        else:
            item += c
    return [*out, item]


def images(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reads(spark, sf_dir).select("path", "box", "seq", "status", "party", "layout")


def regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Layouts Brand#1 to Brand#25; those of even number never validated."""
    brands = spark.read.parquet(f"{sf_dir}/part.parquet").select(F.col("p_brand").alias("layout")).distinct()
    return brands.withColumn("valid", (F.regexp_extract("layout", "[0-9]+", 0).cast("int") % 2).cast("int"))


REGIONS = "regions AS (SELECT DISTINCT p_brand AS layout, CAST(regexp_extract(p_brand, '[0-9]+') AS INTEGER) % 2 AS valid FROM part)"

NORM = "trim(regexp_replace(regexp_replace(lower(coalesce({0}, '')), '[^a-z ]+', ' ', 'g'), '\\s+', ' ', 'g'))"

#: WITH items that give ratios(a, b, r) of the pairs (a, b).
RATIOS = """
blocks AS (
  SELECT a, b, 0 AS alo, length(a) AS ahi, 0 AS blo, length(b) AS bhi, CAST(NULL AS BIGINT) AS n FROM pairs
  UNION ALL
  SELECT a, b, p.alo, p.ahi, p.blo, p.bhi, p.n FROM (
    SELECT a, b, unnest([
        {'alo': alo, 'ahi': -m.i, 'blo': blo, 'bhi': -m.j, 'n': CAST(NULL AS BIGINT)},
        {'alo': m.n - m.i, 'ahi': ahi, 'blo': m.n - m.j, 'bhi': bhi, 'n': CAST(NULL AS BIGINT)},
        {'alo': 0, 'ahi': 0, 'blo': 0, 'bhi': 0, 'n': m.n}]) AS p
    FROM (
      SELECT a, b, alo, ahi, blo, bhi, list_max(flatten(list_transform(range(alo, ahi), lambda i: list_transform(range(blo, bhi), lambda j:
        {'n': len(list_filter(range(1, least(ahi - i, bhi - j) + 1), lambda k: substr(a, i + 1, k) = substr(b, j + 1, k))), 'i': -i, 'j': -j})))) AS m
      FROM blocks WHERE n IS NULL AND ahi > alo AND bhi > blo)
    WHERE m.n > 0)
),
ratios AS (
  SELECT a, b, CASE WHEN length(a) + length(b) = 0 THEN 1.0 ELSE CAST(2 * coalesce(sum(n), 0) AS DOUBLE) / (length(a) + length(b)) END AS r
  FROM blocks GROUP BY a, b
)"""


def _values(rows: list[tuple]) -> str:
    cell = lambda v: f"'{v}'" if isinstance(v, str) else str(v).lower() if isinstance(v, bool) else f"CAST({v} AS DOUBLE)" if isinstance(v, float) else str(v)
    return ", ".join(f"({', '.join(map(cell, r))})" for r in rows)


def match_sql(select: str, more: str = "") -> str:
    """SQL over matched(path, .., norm, score, match, candidate, reason); ``more``: further WITH items."""
    from ..functions.similarity import alias_rows

    t, names = CONFIG.target, ", ".join(f"'{n}'" for n in CONFIG.names)
    negations = ", ".join(f"'{n}'" for n in CONFIG.negations)
    return f"""
WITH RECURSIVE {READS}, {REGIONS},
norms AS (SELECT DISTINCT {NORM.format('vision_text')} AS norm FROM reads),
aliases(name, alias, pos, surname, threshold) AS (VALUES {_values(alias_rows(CONFIG))}),
words AS (SELECT DISTINCT norm, unnest(string_split(norm, ' ') || [norm]) AS word FROM norms WHERE norm <> ''),
pairs AS (
  SELECT DISTINCT a, b FROM (
    SELECT word AS a, '{t.term}' AS b FROM words
    UNION ALL SELECT norm, alias FROM norms, aliases WHERE norm <> ''
    UNION ALL SELECT word, alias FROM words, aliases WHERE surname AND length(alias) >= {t.min_alias} AND length(word) >= {t.min_alias})),
{RATIOS},
scores AS (
  SELECT n.norm, CASE WHEN n.norm = '' THEN 0.0 WHEN contains(n.norm, '{t.term}') THEN 1.0
    WHEN bool_or(length(w.word) >= 4 AND levenshtein(w.word, '{t.term}') <= 1) THEN CAST(0.99 AS DOUBLE) ELSE max(r.r) END AS score
  FROM norms n LEFT JOIN words w ON n.norm = w.norm LEFT JOIN ratios r ON r.a = w.word AND r.b = '{t.term}' GROUP BY n.norm),
alias_scores AS (
  SELECT n.norm, x.name, x.pos, x.threshold, greatest(max(r.r), max(CASE WHEN x.surname AND length(x.alias) >= {t.min_alias} AND contains(n.norm, x.alias) THEN CAST(0.95 AS DOUBLE) ELSE 0 END)) AS s
  FROM norms n CROSS JOIN aliases x
  JOIN words w ON w.norm = n.norm AND (w.word = n.norm OR x.surname AND length(x.alias) >= {t.min_alias} AND length(w.word) >= {t.min_alias})
  JOIN ratios r ON r.a = w.word AND r.b = x.alias
  WHERE NOT list_has_any(string_split(n.norm, ' '), [{negations}])
  GROUP BY n.norm, x.name, x.pos, x.threshold),
folds AS (SELECT norm, arg_min(name, (-s, pos)) AS name FROM alias_scores WHERE s >= threshold AND s > 0 GROUP BY norm),
gated AS (
  SELECT reads.*, scores.norm, score, CASE WHEN score >= CAST({t.strict} AS DOUBLE) AND vision_conf >= CAST({t.low_conf} AS DOUBLE) THEN '{t.term}'
      WHEN score >= CAST({t.review_low} AS DOUBLE) THEN 'review' ELSE 'not_{t.term}' END AS match,
    coalesce(folds.name, scores.norm) AS folded
  FROM reads JOIN scores ON scores.norm = {NORM.format('vision_text')} LEFT JOIN folds ON folds.norm = scores.norm),
named AS (SELECT *, CASE WHEN match = '{t.term}' THEN '{t.term}' ELSE folded END AS candidate FROM gated),
matched AS (
  SELECT *, CASE WHEN match = 'review' OR candidate <> '' AND candidate NOT IN ({names}) THEN
    CASE WHEN vision_conf < CAST({t.low_conf} AS DOUBLE) THEN 'low_conf' WHEN candidate <> '' AND candidate NOT IN ({names}) THEN 'unknown_candidate' ELSE 'fuzzy_band' END END AS reason
  FROM named){', ' + more if more else ''}
{select}"""


#: A WITH item: paths that the quarantine holds (after ``matched``), with thresholds that these tables meet.
QUARANTINE = (3, 0.02)
QUARANTINED = f"""
suspects AS (SELECT m.path, m.layout, m.vision_text, m.norm FROM matched m JOIN regions g ON g.layout = m.layout WHERE g.valid = 0 AND m.candidate <> '' AND m.match <> '{CONFIG.target.term}'),
modal AS (SELECT layout, max(k) AS modal_n, sum(k) AS n FROM (SELECT layout, norm, count(*) AS k FROM suspects GROUP BY ALL) GROUP BY layout),
held AS (SELECT s.path, s.layout, s.vision_text FROM suspects s JOIN modal USING (layout) WHERE modal_n >= {QUARANTINE[0]} AND modal_n >= CAST({QUARANTINE[1]} AS DOUBLE) * n)"""
