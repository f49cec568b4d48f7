"""All registered queries and oracles."""

from checks import analytics, flows, matches, texts, whole  # noqa: F401
from checks.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
