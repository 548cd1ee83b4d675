"""The corpus pipeline: its stages, and a run over all documents. The body is in `meterflow.llm.pipeline`."""

from meterflow.llm.pipeline import ORACLE_SQL, STAGES, run

__all__ = ["ORACLE_SQL", "STAGES", "run"]
