"""Queries over pages, OCR words, replies and pixels."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import Config
from ..functions import geometry, raster
from ..functions.text import crop_path, layout_key, page_kind as kind_of, party_label, style_code
from ..operators import stages
from ..sources import ocr, scan
from ..sources.providers import parse_reply
from . import bindings as B
from .register import registry, table

QUERIES, ORACLE_SQL, query = registry()

_PAGES = Config(contest=Config().contest.__class__(front_markers=("the ", " de ")), parties=(B.CONFIG.parties[0].__class__("first", "und"), B.CONFIG.parties[0].__class__("second", "les")))


@query("""SELECT doc_id, CASE WHEN contains(lower(text), 'target card') OR n_chars <= 2450 AND contains(lower(text), 'clear ballot') THEN 'target_card'
WHEN contains(lower(text), 'the ') OR contains(lower(text), ' de ') THEN 'ballot_front' WHEN n_chars > 2450 THEN 'ballot_back' ELSE 'unknown' END AS page_kind,
CASE WHEN contains(lower(text), 'und') THEN 'first' WHEN contains(lower(text), 'les') THEN 'second' ELSE 'other' END AS party FROM documents""")
def page_kind(spark: SparkSession, sf_dir: str) -> DataFrame:
    low = F.lower("text")
    return table(spark, sf_dir, "documents").select("doc_id", kind_of(F.col("text"), F.col("n_chars"), _PAGES).alias("page_kind"), party_label(low, _PAGES).alias("party"))


_STYLE = "'Nr ' || CAST(1000 + p_partkey % 9000 AS STRING) || '-' || CAST(p_size AS STRING) || CASE p_partkey % 3 WHEN 0 THEN '-WS' WHEN 1 THEN '-ABCD' ELSE '' END || ' and ' || CAST(2000 + p_partkey % 7 AS STRING) || '-1' || CASE p_partkey % 4 WHEN 0 THEN '-A' ELSE '' END || CASE WHEN p_partkey % 11 = 0 THEN '9' ELSE '' END"
_STYLE_SQL = _STYLE.replace("AS STRING", "AS VARCHAR")


@query(f"""WITH t AS (SELECT p_partkey, {B.PARTY} AS party, CASE WHEN p_partkey % 13 = 0 THEN 'none' ELSE {_STYLE_SQL} END AS text FROM part),
s AS (SELECT p_partkey, party, regexp_extract_all(text, '\\b(\\d{{4}}-\\d{{1,2}}(?:-[A-Z]{{1,3}})?)\\b', 1) AS found FROM t),
x AS (SELECT p_partkey, party, list_min(list_transform(found, lambda c, i: {{'plain': CASE WHEN regexp_matches(c, '[A-Za-z]') THEN 0 ELSE 1 END, 'short': -length(c), 'pos': i, 'code': c}})).code AS style FROM s)
SELECT p_partkey, style, CASE WHEN regexp_matches(style, '\\d{{4}}-\\d{{1,2}}') THEN party || '|' || regexp_extract(style, '(\\d{{4}}-\\d{{1,2}})', 1) END AS layout FROM x""")
def style_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "part").selectExpr("p_partkey", f"{B.PARTY} AS party", f"CASE WHEN p_partkey % 13 = 0 THEN 'none' ELSE {_STYLE} END AS text")
    return rows.withColumn("style", style_code(F.col("text"))).select("p_partkey", "style", layout_key(F.col("party"), F.col("style")).alias("layout"))


_HEADER = "CASE p_partkey % 4 WHEN 0 THEN 'OFFICIAL Primary ' || CASE p_partkey % 3 WHEN 0 THEN 'Democratic' ELSE 'nonpartisan' END WHEN 1 THEN 'Clear Ballot' WHEN 2 THEN 'Target Card' ELSE 'x' END"


@query(f"""WITH t AS (SELECT {B.PATH.replace('AS STRING', 'AS VARCHAR')} AS path, {_HEADER} AS header, {_STYLE_SQL} AS st, p_size * 100 AS height, CASE WHEN p_partkey % 50 = 7 THEN 'broken' END AS err FROM part),
k AS (SELECT *, lower(header) AS low FROM t),
c AS (SELECT path, err, CASE WHEN contains(low, 'target card') OR height <= 2450 AND contains(low, 'clear ballot') THEN 'target_card' WHEN contains(low, 'official primary') THEN 'ballot_front' WHEN height > 2450 THEN 'ballot_back' ELSE 'unknown' END AS kind, low FROM k)
SELECT path, CASE WHEN err IS NULL THEN kind END AS page_kind, CASE WHEN err IS NULL AND kind = 'ballot_front' THEN CASE WHEN contains(low, 'democratic') THEN 'Democratic' ELSE 'other' END END AS party,
CASE WHEN err IS NOT NULL THEN 'error' WHEN kind = 'ballot_front' THEN 'classified' ELSE 'skip_no_governor' END AS status, 'classify: ' || err AS err FROM c""")
def classify_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "part").selectExpr(f"{B.PATH} AS path", f"{_HEADER} AS header", f"{_STYLE} AS style_text", "1000 AS width", "p_size * 100 AS height", "CASE WHEN p_partkey % 50 = 7 THEN 'broken' END AS err")
    return stages.classify(pages, Config()).select("path", "page_kind", "party", "status", "err")


@query(f"""WITH p AS (SELECT {B.PATH.replace('AS STRING', 'AS VARCHAR')} || CASE p_partkey % 9 WHEN 0 THEN '.part' WHEN 1 THEN 'x' ELSE '' END AS path FROM part)
SELECT path, regexp_extract(path, '(AB-\\d+)\\+(\\d+)\\.jpe?g$', 1) AS box, regexp_extract(path, '(AB-\\d+)\\+(\\d+)\\.jpe?g$', 2) AS seq, 'pending' AS status FROM p WHERE path LIKE '%.jpg'""")
def manifest_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = table(spark, sf_dir, "part").selectExpr(f"{B.PATH} || CASE p_partkey % 9 WHEN 0 THEN '.part' WHEN 1 THEN 'x' ELSE '' END AS path")
    return scan.manifest(paths, Config()).select("path", "box", "seq", "status")


@query("SELECT event_id, trim(props) AS raw, coalesce(CAST(json_extract_string(props, '$.k') AS DOUBLE), 0) AS conf, 'unsure' AS oval, '' AS text, CAST(NULL AS VARCHAR) AS err FROM events")
def json_reply(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Replies whose confidence is the event's number."""
    rows = table(spark, sf_dir, "events").select("event_id", F.trim("props").alias("raw"), parse_reply(F.replace("props", F.lit('"k"'), F.lit('"confidence"'))).alias("r"))
    return rows.select("event_id", "raw", "r.conf", "r.oval", "r.text", "r.err")


_CASES = [
    ("a", '{"text": " Tina ", "oval": "FILLED", "confidence": "0.9"}'), ("b", "not json"), ("c", "{}"), ("d", "[1]"),
    ("e", '{"text": null, "confidence": null}'), ("f", '{"confidence": "high"}'), ("g", ""), ("h", '{"text": 7, "oval": true, "confidence": 1}'),
]


@query("""SELECT * FROM (VALUES ('a', 'Tina', 'filled', 0.9, NULL), ('b', 'not json', 'unsure', 0.0, NULL), ('c', '', 'unsure', 0.0, NULL),
('d', NULL, NULL, NULL, 'read: reply is not an object with a numeric confidence'), ('e', '', 'unsure', 0.0, NULL),
('f', NULL, NULL, NULL, 'read: reply is not an object with a numeric confidence'), ('g', '', 'unsure', 0.0, NULL), ('h', '7', 'true', 1.0, NULL)) AS t(id, text, oval, conf, err)""".replace("0.9,", "CAST(0.9 AS DOUBLE),"))
def json_reply_cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each way in which a reply can be odd."""
    cells = ", ".join(f"('{i}', '{t}')" for i, t in _CASES)
    return spark.sql(f"SELECT * FROM VALUES {cells} AS t(id, reply)").select("id", parse_reply(F.col("reply")).alias("r")).select("id", "r.*")


_TSV = "'text\tleft\ttop\twidth\theight\tconf\nGovernor' || CAST(doc_id AS STRING) || '\t' || CAST(doc_id % 40 AS STRING) || '\t' || CAST(n_chars % 300 AS STRING) || '\t9\t9\t' || CAST(30 + n_chars % 60 AS STRING) || '\ngovern\t5\t' || CAST(doc_id % 90 AS STRING) || '\t9\t9\t' || CAST(30 + doc_id % 60 AS STRING) || '\nVote\t7\t' || CAST(400 + n_chars % 200 AS STRING) || '\t9\t9\t' || CAST(doc_id % 70 AS STRING) || '\nWrite-In.\t7\t' || CAST(n_chars % 501 AS STRING) || '\t9\t9\t' || CAST(doc_id % 50 AS STRING) || '\nbad\tx\t1\t1\t1\t1\nshort\t1\n \t1\t1\t1\t1\t1'"
_WORDS = """w AS (SELECT doc_id, 1 AS line, 'Governor' || doc_id AS text, CAST(doc_id % 40 AS INTEGER) AS "left", CAST(n_chars % 300 AS INTEGER) AS top, CAST(30 + n_chars % 60 AS DOUBLE) AS conf FROM documents
UNION ALL SELECT doc_id, 2, 'govern', 5, CAST(doc_id % 90 AS INTEGER), CAST(30 + doc_id % 60 AS DOUBLE) FROM documents
UNION ALL SELECT doc_id, 3, 'Vote', 7, CAST(400 + n_chars % 200 AS INTEGER), CAST(doc_id % 70 AS DOUBLE) FROM documents
UNION ALL SELECT doc_id, 4, 'Write-In.', 7, CAST(n_chars % 501 AS INTEGER), CAST(doc_id % 50 AS DOUBLE) FROM documents)"""


def _words(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ocr.parse_tsv(table(spark, sf_dir, "documents").selectExpr("doc_id", f"{_TSV} AS tsv"), "doc_id")


@query(f"WITH {_WORDS} SELECT doc_id, line, text, \"left\", top, 9 AS width, 9 AS height, conf FROM w")
def ocr_tsv(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _words(spark, sf_dir)


@query(f"""WITH {_WORDS}, h AS (SELECT doc_id, arg_min({{'text': text, 'left': "left", 'top': top, 'conf': conf}}, (-conf, top, line)) AS h FROM w WHERE lower(text) LIKE 'govern%' AND conf > 40 GROUP BY 1)
SELECT doc_id, h.text AS text, h."left" AS "left", h.top AS top, h.conf AS conf FROM h""")
def ocr_word_pick(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ocr.header_word(_words(spark, sf_dir), "doc_id")


@query(f"""WITH {_WORDS} SELECT doc_id, min(top) FILTER (lower(text) = 'vote' AND "left" BETWEEN 0 AND 30 AND top > 460 AND conf > 30) AS next_top,
CAST(min(100 + top // 2) FILTER (conf > 20 AND contains(replace(replace(lower(text), '-', ''), '.', ''), 'write')) AS INTEGER) AS label_top FROM w GROUP BY doc_id""")
def ocr_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = _words(spark, sf_dir)
    return ocr.next_contest_top(words, "doc_id", F.lit(0), F.lit(30), F.lit(400)).join(ocr.label_top(words, "doc_id", F.lit(100)), "doc_id")


@query("SELECT doc_id, regexp_matches(replace(replace(lower(text), ' ', ''), '-', ''), 'writ|rite') AS valid FROM documents")
def region_validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", ocr.region_valid(F.col("text")).alias("valid"))


@query("SELECT vec_id, CAST(len(list_filter(embedding, lambda v: v < -0.05)) AS DOUBLE) / len(embedding) AS density FROM embeddings")
def ink_density(spark: SparkSession, sf_dir: str) -> DataFrame:
    dark = F.lit(-0.05).cast("float")
    return table(spark, sf_dir, "embeddings").select("vec_id", raster.ink_density(F.col("embedding"), dark).alias("density"))


@query("""WITH t AS (SELECT vec_id, unnest(range(len(embedding))) AS pos, unnest(embedding) AS v FROM embeddings), d AS (SELECT vec_id, pos FROM t WHERE v < -0.05),
n AS (SELECT *, CASE WHEN pos - lag(pos) OVER (PARTITION BY vec_id ORDER BY pos) > 3 THEN 1 ELSE 0 END AS new FROM d), i AS (SELECT *, sum(new) OVER (PARTITION BY vec_id ORDER BY pos) AS island FROM n),
s AS (SELECT vec_id, min(pos) AS start, max(pos) - min(pos) + 1 AS len FROM i GROUP BY vec_id, island), b AS (SELECT vec_id, arg_max({'s': start, 'l': len}, (len, -start)) AS b FROM s GROUP BY vec_id)
SELECT e.vec_id, CAST(coalesce(b.b.s, 0) AS INTEGER) AS start, CAST(coalesce(b.b.l, 0) AS INTEGER) AS length FROM embeddings e LEFT JOIN b USING (vec_id)""")
def longest_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select("vec_id", F.transform("embedding", lambda v: v < F.lit(-0.05).cast("float")).alias("mask"))
    return raster.dark_runs(rows, "vec_id", "mask", 2)


@query("""WITH b AS (SELECT p_partkey, p_size * 50 AS w, p_size * 80 AS h, (p_partkey % 50) / 200.0 AS x0, (p_partkey % 30) / 300.0 AS y0 FROM part)
SELECT p_partkey, CAST(trunc(CAST(x0 AS DOUBLE) * w) AS INTEGER) AS left_px, CAST(trunc(CAST(y0 AS DOUBLE) * h) AS INTEGER) AS top_px,
CAST(p_partkey % 100 - 60 AS INTEGER) AS region_top, CAST(p_size - 54 AS INTEGER) AS oval_left, CAST(p_size - 2 AS INTEGER) AS oval_right, CAST(p_size AS INTEGER) AS hand_left, CAST(p_partkey % 100 + 6 - 6 - 32 AS INTEGER) AS hand_top,
p_size + 50 > 70 AND p_partkey % 500 > 110 AND p_partkey % 500 <= CAST(0.85 AS DOUBLE) * 400 AS indented FROM b JOIN part USING (p_partkey)""")
def region_boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "part").selectExpr("*", "p_size * 50 AS w", "p_size * 80 AS h", "named_struct('x0', (p_partkey % 50) / 200.0D, 'y0', (p_partkey % 30) / 300.0D, 'x1', 1.0D, 'y1', 1.0D) AS box")
    y = (F.col("p_partkey") % 100).cast("int")
    region, oval = geometry.write_in_boxes(y, F.col("p_size"), F.lit(0), F.lit(400))
    hand = geometry.hand_band(oval, region)
    px = geometry.pixels(F.col("box"), F.col("w"), F.col("h"))
    fits = geometry.indented(F.col("p_size") + 50, F.col("p_partkey") % 500, F.lit(400))
    return rows.select("p_partkey", px["x0"].alias("left_px"), px["y0"].alias("top_px"), region["y0"].alias("region_top"), oval["x0"].alias("oval_left"), oval["x1"].alias("oval_right"), hand["x0"].alias("hand_left"), hand["y0"].alias("hand_top"), fits.alias("indented"))


@query("SELECT p_partkey, 'crops/AB-' || p_size || '_' || p_partkey || '.png' AS crop, to_base64(encode(p_name)) AS content FROM part")
def crop_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    box, seq = F.concat(F.lit("AB-"), F.col("p_size")), F.col("p_partkey").cast("string")
    return table(spark, sf_dir, "part").select("p_partkey", crop_path("crops", box, seq).alias("crop"), F.base64(F.col("p_name").cast("binary")).alias("content"))
