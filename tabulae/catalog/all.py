"""Every registered query: name -> (spark_fn, oracle_sql or None)."""

from __future__ import annotations

from tabulae.catalog import io_q, jobs_files_q, jobs_q, links_match_q, ops_q, registry_q, reliability_q, trade_q, translit_q

CATALOG: dict = {}
for _part in (registry_q.QUERIES, ops_q.Q, trade_q.QUERIES, io_q.Q, jobs_q.Q, jobs_files_q.QUERIES, links_match_q.Q, reliability_q.Q, translit_q.Q):
    CATALOG.update(_part)
