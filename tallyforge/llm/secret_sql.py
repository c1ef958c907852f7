"""The secret scan stated in SQL: base kinds as they are defined, further kinds and ownership from the same constants."""

from __future__ import annotations

from .secret_scan import BASE, KINDS, LEAST_ENTROPY, OWNERS, PEM, PROVIDER, REPOSITORIES, TOKEN

_WORDS = "password|passwd|secret|token|api_?key"
_EITHER = "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in _WORDS)
# Letters of either case are spelt out: folding in the engine would add letters beyond ASCII.
_PATTERNS = [
    f"""({_EITHER})["'']?\\x20*[:=]\\x20*["'']?([A-Za-z0-9+/_.=-]+)""", "AKIA[A-Z0-9]+", "[0-9a-f]+",
    PROVIDER.pattern.replace("(?:", "("), PEM.pattern, TOKEN.pattern,
]
_ENTROPY = "(SELECT -sum(k / n * log2(k / n)) FROM (SELECT CAST(count(*) AS DOUBLE) AS k, CAST(length(m) AS DOUBLE) AS n FROM (SELECT unnest(string_split(m, '')) AS c) GROUP BY c))"
_TESTS = ["length(value) >= 6", "length(m) >= 20", "length(m) >= 24", "TRUE", "TRUE",
          f"regexp_matches(m, '[0-9]') AND regexp_matches(m, '[a-z]') AND regexp_matches(m, '[A-Z]') AND {_ENTROPY} >= {LEAST_ENTROPY}"]


def _matches(kind: int) -> str:
    """k<kind>: places of a pattern's matches, from the lengths of what lies between them."""
    p = _PATTERNS[kind]
    value = f"regexp_extract(m, '{p}', 2)" if kind == 0 else "m"
    return f"""k{kind} AS (SELECT * FROM (
  SELECT doc_id, source, lang, {kind} AS kind, m, {value} AS value, CAST(sum(length(g) + length(m)) OVER (PARTITION BY doc_id ORDER BY i) - length(m) AS BIGINT) AS s FROM (
    SELECT doc_id, source, lang, unnest(ms) AS m, unnest(string_split_regex(t, '{p}')[1:len(ms)]) AS g, unnest(range(len(ms))) AS i
    FROM (SELECT doc_id, source, lang, t, regexp_extract_all(t, '{p}') AS ms FROM d) WHERE len(ms) > 0)) WHERE {_TESTS[kind]})"""


def _apart(kind: int, before: str) -> str:
    """f<kind>: the matches of a further kind that overlap none of ``before``."""
    return f"f{kind} AS (SELECT * FROM k{kind} a WHERE NOT EXISTS (SELECT 1 FROM ({before}) b WHERE b.doc_id = a.doc_id AND b.s < a.s + length(a.m) AND a.s < b.s + length(b.m)))"


def _sql() -> str:
    base = " UNION ALL ".join(f"SELECT * FROM k{i}" for i in range(len(BASE)))
    parts, found = [_matches(i) for i in range(len(KINDS))], base
    for kind in range(len(BASE), len(KINDS)):
        parts.append(_apart(kind, found))
        found += f" UNION ALL SELECT * FROM f{kind}"
    name = "[" + ", ".join(f"'{k}'" for k in KINDS) + "][kind + 1]"
    span = f"{name} || ':' || s || ':' || (s + length(m))"
    listed = lambda what, test="TRUE": f"coalesce(string_agg({what}, ',' ORDER BY s, kind) FILTER ({test}), '')"
    return f"""
WITH d AS (SELECT doc_id, source, lang, coalesce(text, '') AS t FROM documents),
{', '.join(parts)},
found AS ({found}),
owners AS (SELECT value, count(DISTINCT coalesce('=' || source, '-')) AS n_owners, count(DISTINCT coalesce('=' || source, '-') || chr(31) || coalesce('=' || lang, '-')) AS n_repositories FROM found GROUP BY value),
told AS (SELECT f.*, n_owners, n_repositories, n_owners <= {OWNERS} AND n_repositories <= {REPOSITORIES} AS live FROM found f JOIN owners USING (value)),
kept AS (SELECT * FROM told WHERE kind < {len(BASE)} OR live)
SELECT d.doc_id, {', '.join(f"count(*) FILTER (kind = {i}) AS n_{k}" for i, k in enumerate(BASE))}, sha256({listed(span, f'kind < {len(BASE)}')}) AS base_sha256, {listed(span, 'kind IS NOT NULL')} AS spans,
  count(*) FILTER (live) AS n_live, count(*) FILTER (NOT live) AS n_example, {listed('CAST(n_repositories AS VARCHAR)')} AS repositories, {listed('CAST(n_owners AS VARCHAR)')} AS owners
FROM d LEFT JOIN kept ON kept.doc_id = d.doc_id GROUP BY d.doc_id"""


SQL = _sql()
