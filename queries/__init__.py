"""One query per operator over the driver's tables, most of them with an SQL check."""

from queries import aggregates, analysis, cleaning, files, learning, retrieval, texts  # noqa: F401
from queries.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
