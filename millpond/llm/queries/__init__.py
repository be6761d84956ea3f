"""The registered queries of the operators."""

from millpond.llm.queries.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
