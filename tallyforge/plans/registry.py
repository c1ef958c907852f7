"""All queries of the engine by name, and for each the SQL that gives the same rows."""

from __future__ import annotations

from . import kernels, matching, relational

QUERIES = {**relational.QUERIES, **matching.QUERIES, **kernels.QUERIES}
ORACLE_SQL = {**relational.ORACLE_SQL, **matching.ORACLE_SQL, **kernels.ORACLE_SQL}
