"""Operators of a training-data pipeline; nothing else in the library imports them."""

from quern.llm.registry import ORACLES, QUERIES
from quern.llm import queries  # noqa: F401  (it registers the queries)

__all__ = ["ORACLES", "QUERIES"]
