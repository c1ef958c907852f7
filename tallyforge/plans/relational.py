"""Queries over state: filters, joins, aggregates, rankings and state changes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import parsed_parts
from ..operators import stages, state, summary
from ..sources.files import OFFICIAL, contests
from ..telemetry import inflight
from .register import registry, table

QUERIES, ORACLE_SQL, query = registry()

URL = r"^https?://(?P<box>[^/]+)/[a-z]{2}/(?P<seq>\d+)"


@query("SELECT o_orderstatus AS status, count(*) AS n FROM orders GROUP BY 1")
def status_funnel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summary.counts_by(table(spark, sf_dir, "orders").select(F.col("o_orderstatus").alias("status")), "status")


@query("""SELECT o_orderkey AS path, o_orderpriority AS box FROM orders
WHERE o_orderstatus = 'F' AND o_orderpriority IN ('1-URGENT', '2-HIGH') AND o_totalprice IS NOT NULL AND o_custkey <> 0""")
def scan_filter_project(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders")
    test = (F.col("o_orderstatus") == "F") & F.col("o_orderpriority").isin("1-URGENT", "2-HIGH") & F.col("o_totalprice").isNotNull() & (F.col("o_custkey") != 0)
    return rows.filter(test).select(F.col("o_orderkey").alias("path"), F.col("o_orderpriority").alias("box"))


@query("SELECT o_orderkey AS path, o_orderpriority AS box, o_orderstatus AS status FROM orders WHERE o_orderstatus = 'P' AND o_orderpriority = '5-LOW' ORDER BY o_orderkey LIMIT 100")
def select_by_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The limited work list of a stage; the limit is the feature."""
    rows = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("path"), F.col("o_orderpriority").alias("box"), F.col("o_orderstatus").alias("status"))
    return state.select_status(rows, "P", "5-LOW", 100)


@query("""SELECT page_id, nullif(regexp_extract(url, '^https?://([^/]+)/[a-z]{2}/(\\d+)', 1, 'i'), '') AS box,
nullif(regexp_extract(url, '^https?://([^/]+)/[a-z]{2}/(\\d+)', 2, 'i'), '') AS seq FROM pages""")
def parse_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", parsed_parts(F.col("url"), URL).alias("p")).select("page_id", "p.box", "p.seq")


@query("SELECT count(*) FILTER (regexp_extract(url, '^https?://([^/]+)/[a-z]{2}/(\\d+)', 1, 'i') = '') AS n FROM pages")
def skipped_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many names do not parse."""
    return table(spark, sf_dir, "pages").agg(F.count_if(parsed_parts(F.col("url"), URL)["box"].isNull()).alias("n"))


@query("SELECT count(DISTINCT box) AS boxes, count(*) FILTER (box IS NULL) AS unparsed FROM (SELECT nullif(regexp_extract(url, '^https?://([^/]+)/[a-z]{2}/(\\d+)', 1, 'i'), '') AS box FROM pages)")
def distinct_boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    box = parsed_parts(F.col("url"), URL)["box"]
    return table(spark, sf_dir, "pages").agg(F.countDistinct(box).alias("boxes"), F.count_if(box.isNull()).alias("unparsed"))


_BASE = """SELECT {group}, count(*) AS n, round(quantile_cont({oval}, 0.3), 10) AS base_oval, round(quantile_cont({line}, 0.3), 10) AS base_line FROM {source} GROUP BY {group}"""


def _gate(rows: DataFrame, group: list[str]) -> DataFrame:
    base = stages.baselines(rows, group).withColumns({c: F.round(c, 10) for c in ("base_oval", "base_line")})
    marked = stages.is_marked(F.col("oval_fill_score"), F.col("line_ink_score"), F.col("base_oval"), F.col("base_line"), F.col("n"))
    return rows.join(base, group).withColumn("marked", marked).groupBy(*group).agg(
        F.first("n").alias("n"), F.first("base_oval").alias("base_oval"), F.first("base_line").alias("base_line"), F.count_if("marked").alias("n_marked"))


def _gate_sql(rows: str, group: str) -> str:
    on = " AND ".join(f"m.{g.strip()} = b.{g.strip()}" for g in group.split(","))
    names = ", ".join(f"b.{g.strip()}" for g in group.split(","))
    return f"""WITH m AS ({rows}), b AS ({_BASE.format(group=group, oval='oval', line='line', source='m')})
SELECT {names}, b.n, b.base_oval, b.base_line, count(*) FILTER (CASE WHEN b.n >= 8 THEN m.oval - b.base_oval > CAST(0.12 AS DOUBLE) OR m.line - b.base_line > CAST(0.07 AS DOUBLE)
  ELSE m.oval > CAST(0.18 AS DOUBLE) OR m.line > CAST(0.11 AS DOUBLE) END) AS n_marked
FROM m JOIN b ON {on} GROUP BY ALL"""


@query(_gate_sql("SELECT l_suppkey, l_returnflag, l_quantity / 50 AS oval, l_tax AS line FROM lineitem", "l_suppkey, l_returnflag"))
def baseline_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Large groups: ink above the group's blank baseline."""
    rows = table(spark, sf_dir, "lineitem").select("l_suppkey", "l_returnflag", (F.col("l_quantity") / 50).alias("oval_fill_score"), F.col("l_tax").alias("line_ink_score"))
    return _gate(rows, ["l_suppkey", "l_returnflag"])


@query(_gate_sql("SELECT o_custkey, o_orderpriority, o_totalprice / 1000000 AS oval, o_totalprice / 2000000 AS line FROM orders", "o_custkey, o_orderpriority"))
def baseline_gate_sparse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Small groups: most fall back to fixed limits."""
    rows = table(spark, sf_dir, "orders").select("o_custkey", "o_orderpriority", (F.col("o_totalprice") / 1000000).alias("oval_fill_score"), (F.col("o_totalprice") / 2000000).alias("line_ink_score"))
    return _gate(rows, ["o_custkey", "o_orderpriority"])


def _orders_as_images(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("path"), F.col("o_custkey").alias("layout"), F.col("o_orderstatus").alias("found_as"))


@query("""WITH s AS (SELECT o_custkey AS layout, o_orderstatus AS f, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS attempt FROM orders),
t AS (SELECT * FROM s WHERE attempt <= 6),
p AS (SELECT layout, coalesce(min(attempt) FILTER (f = 'F'), max(attempt) FILTER (f <> 'O')) AS attempt FROM t GROUP BY layout)
SELECT p.layout, p.attempt, t.f = 'F' AS valid FROM p JOIN t ON t.layout = p.layout AND t.attempt = p.attempt""")
def locate_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One region a layout: status F stands for a valid attempt, O for one that found nothing."""
    rows = _orders_as_images(spark, sf_dir)
    tries = stages.samples(rows, rows.select("layout").limit(0))
    return stages.chosen_attempts(tries.select("layout", F.col("attempt"), (F.col("found_as") != "O").alias("found"), (F.col("found_as") == "F").alias("valid")))


@query("""WITH k AS (SELECT c_custkey AS layout FROM customer WHERE c_nationkey < 10), n AS (SELECT o_custkey AS layout, count(*) AS n FROM orders GROUP BY 1)
SELECT CAST(coalesce(sum(n) FILTER (k.layout IS NOT NULL), 0) AS BIGINT) AS hits, count(*) FILTER (k.layout IS NULL) AS misses FROM n LEFT JOIN k USING (layout)""")
def locate_cache_use(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = table(spark, sf_dir, "customer").filter("c_nationkey < 10").select(F.col("c_custkey").alias("layout"))
    return stages.cache_use(_orders_as_images(spark, sf_dir), known)


@query("""SELECT o_orderkey AS path, CASE WHEN c_custkey IS NOT NULL THEN 'located' ELSE 'skip_no_governor' END AS status
FROM orders LEFT JOIN (SELECT c_custkey FROM customer WHERE c_nationkey < 10) ON c_custkey = o_custkey""")
def region_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = table(spark, sf_dir, "customer").filter("c_nationkey < 10").select(F.col("c_custkey").alias("layout"))
    return stages.located(_orders_as_images(spark, sf_dir), known)


def _modal_sql(source: str, group: str, text: str, count: int, share: float) -> str:
    return f"""WITH c AS (SELECT {group} AS layout, {text} AS text, count(*) AS k FROM {source} GROUP BY 1, 2)
SELECT layout, CAST(sum(k) AS BIGINT) AS n, max(k) AS modal_n, arg_min(text, (-k, text)) AS modal_text,
max(k) >= {count} AND max(k) >= CAST({share} AS DOUBLE) * sum(k) AS flagged FROM c GROUP BY layout"""


def _modal(rows: DataFrame, count: int, share: float) -> DataFrame:
    return stages.modal_share(rows, "layout", "text").withColumn("flagged", (F.col("modal_n") >= count) & (F.col("modal_n") >= F.lit(share) * F.col("n")))


@query(_modal_sql("events", "user_id", "event_type", 8, 0.25))
def modal_share_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _modal(table(spark, sf_dir, "events").select(F.col("user_id").alias("layout"), F.col("event_type").alias("text")), 8, 0.25)


@query(_modal_sql("conversations", "conv_id", "role", 2, 0.5))
def modal_share_roles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _modal(table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("layout"), F.col("role").alias("text")), 2, 0.5)


@query("SELECT DISTINCT p_partkey FROM part WHERE p_partkey NOT IN (SELECT l_partkey FROM lineitem WHERE l_quantity > 49)")
def coverage_anti(spark: SparkSession, sf_dir: str) -> DataFrame:
    big = table(spark, sf_dir, "lineitem").filter("l_quantity > 49").select(F.col("l_partkey").alias("p_partkey"))
    return summary.missing(table(spark, sf_dir, "part"), big, "p_partkey")


@query("""WITH e AS (SELECT DISTINCT p_partkey AS k FROM part), i AS (SELECT DISTINCT l_partkey AS k FROM lineitem WHERE l_quantity > 49)
SELECT (SELECT count(*) FROM e) AS on_disk, (SELECT count(*) FROM i) AS ingested, (SELECT count(*) FROM e WHERE k NOT IN (SELECT k FROM i)) AS missing""")
def coverage_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    big = table(spark, sf_dir, "lineitem").filter("l_quantity > 49").select(F.col("l_partkey").alias("k"))
    return summary.coverage(table(spark, sf_dir, "part").select(F.col("p_partkey").alias("k")), big, "k")


@query("SELECT doc_id, text, coalesce(CASE WHEN l.doc_id IS NOT NULL THEN CASE WHEN toxic = 1 THEN NULL ELSE 'q' || quality END ELSE lang END, NULL) AS lang FROM documents LEFT JOIN labels l USING (doc_id)")
def update_partial(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled documents get a new lang; a given null replaces too."""
    delta = table(spark, sf_dir, "labels").select("doc_id", F.when(F.col("toxic") != 1, F.concat(F.lit("q"), F.col("quality"))).alias("lang"))
    return state.update(table(spark, sf_dir, "documents").select("doc_id", "text", "lang"), delta, "doc_id")


@query("""WITH d AS (SELECT CASE WHEN toxic = 1 THEN doc_id + 1000000000 ELSE doc_id END AS doc_id, 'q' || quality AS lang FROM labels)
SELECT coalesce(t.doc_id, d.doc_id) AS doc_id, CASE WHEN d.doc_id IS NOT NULL THEN d.lang ELSE t.lang END AS lang, source FROM documents t FULL JOIN d ON t.doc_id = d.doc_id""")
def upsert_partial(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents; labels of clean ones update, those of toxic ones get ids that no document has and insert."""
    key = F.when(F.col("toxic") == 1, F.col("doc_id") + 1_000_000_000).otherwise(F.col("doc_id"))
    delta = table(spark, sf_dir, "labels").select(key.alias("doc_id"), F.concat(F.lit("q"), F.col("quality")).alias("lang"))
    return state.upsert(table(spark, sf_dir, "documents").select("doc_id", "lang", "source"), delta, "doc_id")


@query("""SELECT c_custkey AS k, c_mktsegment AS status FROM customer WHERE c_nationkey < 20
UNION ALL SELECT DISTINCT o_custkey, 'new' FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_nationkey < 20)""")
def insert_if_absent(spark: SparkSession, sf_dir: str) -> DataFrame:
    there = table(spark, sf_dir, "customer").filter("c_nationkey < 20").select(F.col("c_custkey").alias("k"), F.col("c_mktsegment").alias("status"))
    new = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("k"), F.lit("new").alias("status"))
    return state.insert_if_absent(there, new, "k")[0]


@query("SELECT o_custkey AS layout, max(o_orderkey) AS batch, arg_max(o_orderstatus, o_orderkey) AS valid FROM orders GROUP BY 1")
def latest_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("layout"), F.col("o_orderkey").alias("batch"), F.col("o_orderstatus").alias("valid"))
    return state.latest(rows, "layout", "batch")


@query("SELECT doc_id, lang FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def delete_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return state.delete(table(spark, sf_dir, "documents").select("doc_id", "lang"), table(spark, sf_dir, "labels"), "doc_id")


@query("SELECT doc_id, CAST(CASE WHEN doc_id IN (SELECT doc_id FROM labels WHERE quality = 0) THEN 1 ELSE 0 END AS INTEGER) AS quarantined FROM documents")
def reset_and_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    reset = state.set_all(table(spark, sf_dir, "documents").select("doc_id"), quarantined=0)
    return state.set_where(reset, table(spark, sf_dir, "labels").filter("quality = 0"), "doc_id", quarantined=1)


@query("SELECT o_orderkey AS path, CASE o_orderstatus WHEN 'F' THEN 'pending' ELSE o_orderstatus END AS status, CASE o_orderstatus WHEN 'F' THEN NULL ELSE o_orderpriority END AS err FROM orders")
def retry_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = F.when(F.col("o_orderstatus") == "F", "error").otherwise(F.col("o_orderstatus"))
    return state.retry_errors(table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("path"), status.alias("status"), F.col("o_orderpriority").alias("err")), "pending")


@query("""WITH o AS (SELECT o_orderpriority AS party, count(*) FILTER (o_orderstatus = 'F') AS ours FROM orders WHERE o_orderpriority <> '3-MEDIUM' GROUP BY 1),
f(party, official) AS (VALUES ('1-URGENT', 1000), ('2-HIGH', 5), ('3-MEDIUM', 10), ('4-NOT SPECIFIED', 0), ('5-LOW', NULL))
SELECT party, coalesce(ours, 0) AS ours, CAST(official AS BIGINT) AS official, round((coalesce(ours, 0) - official) / nullif(official, 0), 9) AS delta,
abs((coalesce(ours, 0) - official) / nullif(official, 0)) <= CAST(0.15 AS DOUBLE) AS ok FROM f LEFT JOIN o USING (party)""")
def reconcile_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    ours = table(spark, sf_dir, "orders").filter("o_orderpriority <> '3-MEDIUM'").groupBy(F.col("o_orderpriority").alias("party")).agg(F.count_if(F.col("o_orderstatus") == "F").alias("ours"))
    official = spark.sql("SELECT party, CAST(official AS BIGINT) AS official FROM VALUES ('1-URGENT', 1000), ('2-HIGH', 5), ('3-MEDIUM', 10), ('4-NOT SPECIFIED', 0), ('5-LOW', NULL) AS t(party, official)")
    return summary.reconcile(ours, official).withColumn("delta", F.round("delta", 9))


_OFFICIAL = '{"source": "portal", "as_of": "2026-06-18", "status": "unofficial", "contests": {"Democratic": {"writein_total": 250}, "Republican": {"writein_total": null}}}'


@query("""SELECT * FROM (VALUES ('Democratic', CAST(250 AS BIGINT), 'portal', '2026-06-18', 'unofficial'), ('Republican', NULL, 'portal', '2026-06-18', 'unofficial')) AS t(party, official, source, as_of, status)""")
def official_document(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An official document's totals, with where they come from."""
    return contests(spark.range(1).select(F.from_json(F.lit(_OFFICIAL), OFFICIAL).alias("d")).select("d.*"))


@query("""WITH e AS (SELECT o_orderkey % 977 AS k, o_orderkey % 13 AS ms FROM orders), s AS (SELECT k * 0.25 AS moment, 1 AS step FROM e UNION ALL SELECT k * 0.25 + ms * 0.5, -1 FROM e),
r AS (SELECT sum(step) OVER (ORDER BY moment, step DESC ROWS UNBOUNDED PRECEDING) AS up FROM s) SELECT CAST(max(up) AS BIGINT) AS most FROM r""")
def inflight_reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as reads that begin by their key and take up to six seconds."""
    rows = table(spark, sf_dir, "orders").select((F.col("o_orderkey") % 977 * 0.25).alias("began"), (F.col("o_orderkey") % 13 * 500.0).alias("latency_ms"))
    return inflight(rows)
