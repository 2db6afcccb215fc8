"""The corpus pipeline of ``gridcast.llm``: its stages, their run over a folder and its SQL."""
from gridcast.llm.pipeline import ORACLE_SQL, STAGES, decontaminate, mix, near_duplicates, order, quality, run  # noqa: F401
