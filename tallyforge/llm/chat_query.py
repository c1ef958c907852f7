"""Conversations given tool calls by rule, and the SQL that says what formatting them comes to.

The given conversations hold no calls.  Each message keeps its text and moves to turn 2 * turn + 2; an
assistant's message at turn t gains, by rules over conv_id and t,

* a call ``c<k>``, k = t div 2 mod 3, so that longer conversations repeat ids (duplicates); it names no other
  call, the one before, the one behind, or both, so that there are chains, cycles and unknown ids;
* arguments that meet the schema of its tool or do not, and tools without a schema;
* in some messages a second call, or one that does not parse;
* a result behind it, one ahead of it, or none; some results answer no call.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SCHEMAS = {
    "lookup": {"type": "object", "properties": {"query": {"type": "string"}, "limit": {"type": ["integer", "null"], "minimum": 1, "maximum": 5}}, "required": ["query"], "additionalProperties": False},
    "measure": {"type": "object", "properties": {"value": {"type": "number"}, "unit": {"enum": ["ms", "s"]}}, "required": ["value", "unit"]},
}

# Expressions that Spark and DuckDB read alike; c: conv_id, t: turn.
_H = "((c * 7 + t * 5) % 12)"
_NAME = f"CASE {_H} % 3 WHEN 0 THEN 'lookup' WHEN 1 THEN 'measure' ELSE 'unlisted' END"
# As written, with white space and in no order; the canonical form; whether it meets the schema.
_WRITTEN = f"""CASE {_H} % 3 WHEN 0 THEN '{{"query": "q' || c || '", "limit": ' || CASE WHEN c % 5 = 0 THEN 'null' ELSE '' || t END || '}}'
  WHEN 1 THEN '{{"value": ' || CASE WHEN c % 4 = 0 THEN '"x"' ELSE t || '.50' END || ', "unit":"' || CASE WHEN c % 3 = 0 THEN 'h' ELSE 'ms' END || '"}}' ELSE '[1, {{"b": true, "a": "é"}}]' END"""
_CANONICAL = f"""CASE {_H} % 3 WHEN 0 THEN '{{"limit":' || CASE WHEN c % 5 = 0 THEN 'null' ELSE '' || t END || ',"query":"q' || c || '"}}'
  WHEN 1 THEN '{{"unit":"' || CASE WHEN c % 3 = 0 THEN 'h' ELSE 'ms' END || '","value":' || CASE WHEN c % 4 = 0 THEN '"x"' ELSE t || '.5' END || '}}' ELSE '[1,{{"a":"é","b":true}}]' END"""
_VALID = f"CASE {_H} % 3 WHEN 0 THEN c % 5 = 0 OR t BETWEEN 1 AND 5 WHEN 1 THEN c % 4 <> 0 AND c % 3 <> 0 ELSE FALSE END"
_SECOND = f"{_H} % 5 = 0"
_BROKEN = f"{_H} % 7 = 6"
_BROKEN_TEXT = """<tool_call>{"id": 1}</tool_call>"""
# Turns of results after the shift: behind their call or ahead of it.
_RESULTS = {"(c + t) % 3 = 1": "2 * t + 3", "(c + t) % 3 = 2": "2 * t + 1"}
_CONTENT = "CASE WHEN c % 2 = 0 THEN '{\"z\": [1, 2], \"a\": null}' ELSE '\"r' || t || '\"' END"
_TOLD = "CASE WHEN c % 2 = 0 THEN '{\"a\":null,\"z\":[1,2]}' ELSE 'r' || t END"


def with_calls(messages: DataFrame) -> DataFrame:
    """conv_id, turn, role, text of the conversations with calls and results."""
    k, p, n = ("CAST((t DIV 2 + {}) % 3 AS LONG)".format(i) for i in (0, 2, 1))
    rows = messages.selectExpr("CAST(conv_id AS LONG) AS c", "CAST(turn AS LONG) AS t", "role", "text")
    after = f"""CASE {_H} % 4 WHEN 0 THEN '' WHEN 1 THEN '"c' || {p} || '"' WHEN 2 THEN '"c' || {n} || '"' ELSE '"c' || {n} || '", "c' || {p} || '"' END"""
    calls = f"""coalesce(text, '') || ' <tool_call>{{"name": "' || {_NAME} || '", "id": "c' || {k} || '", "after": [' || {after} || '], "arguments": ' || {_WRITTEN} || '}}</tool_call>'
      || CASE WHEN {_SECOND} THEN '<tool_call>{{"id":"x' || t || '","name":"measure","arguments":{{"unit":"s","value":0}}}}</tool_call>' ELSE '' END
      || CASE WHEN {_BROKEN} THEN '{_BROKEN_TEXT}' ELSE '' END"""
    given = rows.selectExpr("c AS conv_id", "2 * t + 2 AS turn", "role", f"CASE WHEN role = 'assistant' THEN {calls} ELSE text END AS text")
    told = rows.filter("role = 'assistant'")
    results = [
        told.filter(when).selectExpr("c AS conv_id", f"{turn} AS turn", "'tool' AS role", f"""'{{"content": ' || {_CONTENT} || ', "tool_call_id": "c' || {k} || '"}}' AS text""")
        for when, turn in _RESULTS.items()
    ]
    lost = rows.filter("t = 0 AND c % 10 = 0").selectExpr("c AS conv_id", "0L AS turn", "'tool' AS role", """'{"content": "lost", "tool_call_id": "nobody"}' AS text""")
    for more in (*results, lost):
        given = given.unionByName(more)
    return given.select("conv_id", "turn", "role", F.col("text"))


def _sql() -> str:
    k, p, n = ("CAST((t // 2 + {}) % 3 AS BIGINT)".format(i) for i in (0, 2, 1))
    results = " UNION ALL ".join(f"SELECT c, {turn} AS turn, 'c' || {k} AS id, {_TOLD} AS told FROM m WHERE role = 'assistant' AND {when}" for when, turn in _RESULTS.items())
    # A call's after list names two other ids at most, so depths end with the third round.
    rounds, known = "", "SELECT * FROM d0"
    for i in (1, 2):
        rounds += f""", d{i} AS (SELECT f.c, f.id, {i} AS depth, greatest(f.turn, max(b.place)) AS place FROM waits w JOIN first f USING (c, id) JOIN ({known}) b ON b.c = w.c AND b.id = w.before
          WHERE NOT EXISTS (SELECT 1 FROM ({known}) o WHERE o.c = f.c AND o.id = f.id) GROUP BY f.c, f.id, f.turn, f.n_after HAVING count(*) = f.n_after)"""
        known += f" UNION ALL SELECT * FROM d{i}"
    return f"""
WITH m AS (SELECT CAST(conv_id AS BIGINT) AS c, CAST(turn AS BIGINT) AS t, role, text FROM conversations),
calls AS (
  SELECT c, t, 2 * t + 2 AS turn, 0 AS pos, 'c' || {k} AS id, {_NAME} AS name, {_CANONICAL} AS args, {_VALID} AS valid,
    CASE {_H} % 4 WHEN 0 THEN CAST([] AS VARCHAR[]) WHEN 1 THEN ['c' || {p}] WHEN 2 THEN ['c' || {n}] ELSE ['c' || {n}, 'c' || {p}] END AS after FROM m WHERE role = 'assistant'
  UNION ALL SELECT c, t, 2 * t + 2, 1, 'x' || t, 'measure', '{{"unit":"s","value":0}}', TRUE, CAST([] AS VARCHAR[]) FROM m WHERE role = 'assistant' AND {_SECOND}),
first AS (SELECT c, id, turn, after, len(after) AS n_after FROM calls QUALIFY row_number() OVER (PARTITION BY c, id ORDER BY turn, pos) = 1),
results AS (SELECT *, row_number() OVER (PARTITION BY c, id ORDER BY turn) = 1 AS counts FROM ({results} UNION ALL SELECT c, 0, 'nobody', 'lost' FROM m WHERE t = 0 AND c % 10 = 0)),
waits AS (SELECT c, id, unnest(after) AS before FROM first),
d0 AS (SELECT c, id, 0 AS depth, turn AS place FROM first WHERE n_after = 0){rounds},
done AS ({known}),
known AS (SELECT f.c, f.id, f.turn, coalesce(d.depth, 0) AS depth, d.place, d.depth IS NULL AS loop, r.id IS NOT NULL AS answered FROM first f LEFT JOIN done d USING (c, id) LEFT JOIN (SELECT c, id FROM results WHERE counts) r USING (c, id)),
told AS (SELECT a.*, k.depth, k.place, k.answered, CASE WHEN a.turn <> k.turn THEN 'duplicate' WHEN k.loop THEN 'cycle' WHEN NOT a.valid THEN 'invalid' WHEN k.answered THEN 'answered' ELSE 'open' END AS status FROM calls a JOIN known k USING (c, id)),
per AS (SELECT c, t, string_agg('{{"arguments":' || args || ',"depth":' || depth || ',"id":"' || id || '","name":"' || name || '","status":"' || status || '"}}', ',' ORDER BY depth, pos) AS calls,
  count(*) AS n_calls, count(*) FILTER (valid) AS n_valid, count(*) FILTER (answered) AS n_answered, max(place) AS place, max(CASE WHEN status = 'cycle' THEN 0 ELSE depth END) AS depth FROM told GROUP BY c, t)
SELECT m.c AS conv_id, 2 * t + 2 AS turn, role, greatest(2 * t + 2, per.place) AS place, CAST(coalesce(2 * per.depth, 0) AS BIGINT) AS rank,
  '{{"content":' || CASE WHEN role = 'assistant' THEN to_json(coalesce(text, '') || ' ' || CASE WHEN {_BROKEN} THEN '{_BROKEN_TEXT}' ELSE '' END) ELSE coalesce(to_json(text), 'null') END || ',"role":' || to_json(role)
    || coalesce(',"tool_calls":[' || per.calls || ']', '') || ',"turn":' || (2 * t + 2) || '}}' AS message,
  coalesce(n_calls, 0) AS n_calls, coalesce(n_valid, 0) AS n_valid, coalesce(n_answered, 0) AS n_answered, CAST(NULL AS BOOLEAN) AS linked
FROM m LEFT JOIN per USING (c, t)
UNION ALL
SELECT r.c, r.turn, 'tool', greatest(r.turn, k.turn, k.place), CAST(2 * coalesce(k.depth, 0) + 1 AS BIGINT),
  '{{"content":' || to_json(told) || ',"linked":' || (k.id IS NOT NULL AND r.counts) || ',"role":"tool","tool_call_id":"' || r.id || '","turn":' || r.turn || '}}', 0, 0, 0, k.id IS NOT NULL AND r.counts
FROM results r LEFT JOIN known k USING (c, id)"""


SQL = _sql()
