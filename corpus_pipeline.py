"""The corpus pipeline of ``sievework.llm.pipeline``: its stages, their SQL and the run over ``documents``."""

from sievework.llm.pipeline import ORACLE_SQL, STAGES, run

__all__ = ["ORACLE_SQL", "STAGES", "run"]
