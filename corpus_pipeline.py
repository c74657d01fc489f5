"""Corpus pipeline over `documents`: STAGES, run() and ORACLE_SQL of `corpusloom.llm.stages`."""

from corpusloom.llm.stages import ORACLE_SQL, STAGES, run

__all__ = ["ORACLE_SQL", "STAGES", "run"]
