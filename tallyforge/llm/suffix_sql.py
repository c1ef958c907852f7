"""Removal of repeated byte strings stated in SQL: every window grouped by its bytes, without any sorting of suffixes."""

from __future__ import annotations

from .suffix_dedup import DEPTH

SQL = f"""
WITH d AS (SELECT doc_id, encode(coalesce(text, '')) AS b FROM documents),
w AS (SELECT doc_id, p, array_slice(b, p, p + {DEPTH - 1}) AS k FROM (SELECT doc_id, b, unnest(range(1, octet_length(b) - {DEPTH - 2})) AS p FROM d)),
firsts AS (SELECT k, min(doc_id) AS first FROM w GROUP BY k HAVING count(DISTINCT doc_id) > 1),
gone AS (SELECT doc_id, p FROM w JOIN firsts USING (k) WHERE first < doc_id),
opened AS (SELECT doc_id, p, CASE WHEN p - lag(p) OVER (PARTITION BY doc_id ORDER BY p) <= {DEPTH} THEN 0 ELSE 1 END AS opens FROM gone),
numbered AS (SELECT doc_id, p, sum(opens) OVER (PARTITION BY doc_id ORDER BY p) AS span FROM opened),
spans AS (SELECT doc_id, min(p) AS a, max(p) + {DEPTH - 1} AS e FROM numbered GROUP BY doc_id, span),
stays AS (
  SELECT doc_id, coalesce(lag(e) OVER (PARTITION BY doc_id ORDER BY a), 0) + 1 AS x, a - 1 AS y FROM spans
  UNION ALL SELECT d.doc_id, coalesce(max(e), 0) + 1, max(octet_length(b)) FROM d LEFT JOIN spans USING (doc_id) GROUP BY d.doc_id),
kept AS (SELECT doc_id, string_agg(CASE WHEN x <= y THEN hex(array_slice(b, x, y)) ELSE '' END, '' ORDER BY x) AS bytes FROM stays JOIN d USING (doc_id) GROUP BY doc_id)
SELECT doc_id, octet_length(b) AS n_bytes, CAST(octet_length(b) - length(bytes) // 2 AS BIGINT) AS n_removed, (SELECT count(*) FROM spans s WHERE s.doc_id = d.doc_id) AS n_spans,
  sha256(unhex(bytes)) AS kept_sha256
FROM d JOIN kept USING (doc_id)"""
