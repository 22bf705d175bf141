"""All queries of this subpackage and the SQL that some of them must equal."""

from __future__ import annotations

from loanweave.llm import dedup_queries, model_queries, native_queries, scan_queries
from loanweave.llm.oracle import ORACLE as ORACLE

QUERIES = {**native_queries.QUERIES, **scan_queries.QUERIES, **model_queries.QUERIES, **dedup_queries.QUERIES}
