"""All queries of this subpackage."""

import corpus_pipeline
from marketgrain.llm.queries import ORACLES, QUERIES

QUERIES["pipeline"] = corpus_pipeline.run
if corpus_pipeline.ORACLE_SQL is not None:
    ORACLES["pipeline"] = corpus_pipeline.ORACLE_SQL

__all__ = ["ORACLES", "QUERIES"]
