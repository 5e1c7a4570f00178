"""All registered queries of the subpackage; importing this module fills the registry."""

import corpus_pipeline
from recordlink.llm import ops  # noqa: F401
from recordlink.llm.queries import ORACLES, QUERIES, query

query("pipeline", corpus_pipeline.ORACLE_SQL)(corpus_pipeline.run)

__all__ = ["ORACLES", "QUERIES"]
