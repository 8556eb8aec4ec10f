"""All queries of the library; importing this registers them."""

from strandweave.plans import alignment, sequences, statistics, streams, texts, vectors  # noqa: F401
from strandweave.plans.registry import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
