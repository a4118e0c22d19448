"""What the driver's entry module adds: queries and SQL of this subpackage and the pipeline."""

from __future__ import annotations

import corpus_pipeline
from barlens.llm.oracle import ORACLE as _OPERATORS
from barlens.llm.queries import QUERIES as _QUERIES

QUERIES = {**_QUERIES, "pipeline": corpus_pipeline.run}
ORACLE = dict(_OPERATORS)
if corpus_pipeline.ORACLE_SQL:
    ORACLE["pipeline"] = corpus_pipeline.ORACLE_SQL
