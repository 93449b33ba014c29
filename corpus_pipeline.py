"""The training-corpus pipeline; its stages are in ``docketlake.llm.pipeline``."""

from docketlake.llm.pipeline import ORACLE_SQL, STAGES, run

__all__ = ["ORACLE_SQL", "STAGES", "run"]
