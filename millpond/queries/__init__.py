"""The registered queries, each with its SQL twin where SQL can state it."""

from millpond.queries import feed, files, merging, relational, refinement, scalar, versions  # noqa: F401
from millpond.queries.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
