"""The quality rules stated in SQL, from the same constants."""

from __future__ import annotations

from .quality import _GROWTH, FINEST, LEAST, LEAST_WORDS, LETTERS, LIMITS, MOST_REPEATED, ONE_REPEAT, RULES, SPREADS, TAIL

_SPACE = r"[\x20\x09-\x0D]"
_WORD = r"[^\x20\x09-\x0D]"
_MARK = r"[\x21-\x40\x5B-\x60\x7B-\x7E]"
_VALUE = f"CASE WHEN bucket = -1048576 THEN 0.0 ELSE 2 * exp(bucket * CAST({_GROWTH!r} AS DOUBLE)) / (1 + exp(CAST({_GROWTH!r} AS DOUBLE))) END"
_QUANTILES = ", ".join(f"min({_VALUE}) FILTER (upto >= total * {q}) AS q{i}" for i, q in enumerate((0.25, 0.5, 0.75, 0.95)))
_PARTS = {"mid": "q1", "down": "q1 - q0", "up": "q2 - q1"}


def _double(x: float) -> str:
    return f"CAST({x!r} AS DOUBLE)"


def _limits() -> str:
    parts = _PARTS | {"tail": f"q3 + {_double(TAIL)} * (q3 - q1)"}
    return ", ".join(f"max({parts[part]}) FILTER (rule = '{rule}') AS {rule}_{part}" for rule, part in (c.rsplit("_", 1) for c in LIMITS))


def _picked() -> str:
    own = (f"CASE WHEN a.members >= {LEAST} THEN a.{c} WHEN b.members >= {LEAST} THEN b.{c} ELSE z.{c} END AS own_{c}" for c in LIMITS)
    wide = (f"CASE WHEN b.members >= {LEAST} THEN b.{c} ELSE z.{c} END AS wide_{c}" for c in LIMITS)
    return ", ".join([*own, *wide])


def _beyond(of: str, rule: str, side: str) -> str:
    mid = f"{of}_{rule}_mid"
    part = "word_chars" if rule == "mark_share" else "n_words"
    length = f"least(greatest({part}, 1), {FINEST[part]})"
    noise = f"{_double(LETTERS)} / sqrt(CAST({length} AS DOUBLE))" if rule == "word_length" else f"sqrt({mid} / {length}) + CAST(1 AS DOUBLE) / {length}"
    away = f"{rule} - {mid}" if side == "up" else f"-({rule} - {mid})"
    return f"{away} > {_double(SPREADS[rule])} * greatest({of}_{rule}_{side}, {noise})"


def _outlier() -> str:
    rules = lambda of: (
        f"({_beyond(of, 'mark_share', 'up')}) AND ({_beyond(of, 'symbol_ratio', 'up')})",
        f"({_beyond(of, 'word_length', 'up')}) OR ({_beyond(of, 'word_length', 'down')})",
        f"n_dup_lines > {of}_dup_line_ratio_tail * n_lines + 1",
        f"n_repeat_words > {of}_repeat_ratio_tail * n_words + {ONE_REPEAT}",
    )
    return " OR ".join(f"(({a}) AND ({b}))" for a, b in zip(rules("own"), rules("wide"), strict=True))


SQL = f"""
WITH w AS (
  SELECT doc_id, lang, source, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '{_WORD}+') AS ws,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '{_WORD}')) AS ls FROM documents),
threes AS (
  SELECT doc_id, unnest(tri) AS three, unnest(range(len(tri))) AS i
  FROM (SELECT doc_id, list_transform(range(1, len(ws) - 1), lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2]) AS tri FROM w WHERE len(ws) >= 3)),
again AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, three) AS c FROM threes) WHERE c > 1),
repeats AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM again, (VALUES (0), (1), (2)) AS s(k) GROUP BY doc_id),
c AS (
  SELECT w.doc_id, lang, source, CAST(len(ws) AS BIGINT) AS n_words, CAST(length(regexp_replace(text, '{_SPACE}', '', 'g')) AS BIGINT) AS word_chars,
    CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols, length(text) - length(regexp_replace(text, '{_MARK}', '', 'g')) AS n_marks,
    CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines, coalesce(repeats.n, 0) AS n_repeat_words, len(ls) AS n_lines
  FROM w LEFT JOIN repeats ON repeats.doc_id = w.doc_id),
m AS (
  SELECT *, CAST(n_marks AS DOUBLE) / greatest(word_chars, 1) AS mark_share, CAST(n_symbols AS DOUBLE) / greatest(n_words, 1) AS symbol_ratio, CAST(n_dup_lines AS DOUBLE) / greatest(n_lines, 1) AS dup_line_ratio,
    CAST(n_repeat_words AS DOUBLE) / greatest(n_words, 1) AS repeat_ratio, CAST(word_chars AS DOUBLE) / greatest(n_words, 1) AS word_length,
    coalesce('=' || lang, '-') || chr(31) || coalesce('=' || source, '-') AS own, coalesce('=' || lang, '-') AS of_lang FROM c),
v AS (
  SELECT own, of_lang, rule, CASE WHEN value > 0 THEN CAST(ceil(ln(value) / {_double(_GROWTH)}) AS INTEGER) ELSE -1048576 END AS bucket
  FROM (SELECT own, of_lang, unnest([{', '.join(f"'{r}'" for r in RULES)}]) AS rule, unnest([{', '.join(RULES)}]) AS value FROM m)),
s AS (
  SELECT 0 AS level, own AS g, rule, bucket, count(*) AS n FROM v GROUP BY ALL
  UNION ALL SELECT 1, of_lang, rule, bucket, count(*) FROM v GROUP BY ALL
  UNION ALL SELECT 2, '', rule, bucket, count(*) FROM v GROUP BY ALL),
r AS (SELECT *, sum(n) OVER (PARTITION BY level, g, rule ORDER BY bucket) AS upto, sum(n) OVER (PARTITION BY level, g, rule) AS total FROM s),
q AS (SELECT level, g, rule, max(total) AS n, {_QUANTILES} FROM r GROUP BY level, g, rule),
f AS (SELECT level, g, max(n) AS members, {_limits()} FROM q GROUP BY level, g),
fences AS (
  SELECT a.g AS own, CASE WHEN a.members >= {LEAST} THEN 0 WHEN b.members >= {LEAST} THEN 1 ELSE 2 END AS fence_level, {_picked()}
  FROM f a JOIN f b ON b.level = 1 AND b.g = string_split(a.g, chr(31))[1] JOIN f z ON z.level = 2 WHERE a.level = 0)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < {LEAST_WORDS} OR 100 * n_repeat_words > {MOST_REPEATED} * n_words AS base_failed,
  NOT (n_words < {LEAST_WORDS} OR 100 * n_repeat_words > {MOST_REPEATED} * n_words) AND NOT ({_outlier()}) AS kept, fence_level
FROM m JOIN fences USING (own)"""
