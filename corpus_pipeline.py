"""The corpus pipeline: its stages are in ``loomvec/llm/pipeline.py``."""

from loomvec.llm.pipeline import ORACLE_SQL, STAGES, run

__all__ = ["ORACLE_SQL", "STAGES", "run"]
