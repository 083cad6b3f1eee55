"""All registered queries of the library and their oracle SQL."""

from __future__ import annotations

from . import annotate_queries, corpus_queries, file_queries, payload_queries, report_queries, scoring_queries

_MODULES = (annotate_queries, scoring_queries, corpus_queries, report_queries, payload_queries, file_queries)
QUERIES: dict = {}
ORACLE_SQL: dict = {}
for _m in _MODULES:
    QUERIES |= _m.QUERIES
    ORACLE_SQL |= _m.ORACLE_SQL
