"""Everything that the subpackage and the pipeline register."""

from __future__ import annotations

import corpus_pipeline
from tallygrid.llm import queries

QUERIES = {**queries.QUERIES, "pipeline": corpus_pipeline.run}
SQL = dict(queries.SQL)
if corpus_pipeline.ORACLE_SQL:
    SQL["pipeline"] = corpus_pipeline.ORACLE_SQL
