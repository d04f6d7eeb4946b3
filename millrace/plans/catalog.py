"""All registered queries and their SQL."""

from . import cleaning, corpus, files, log, scoring, studies  # noqa: F401  (they register themselves)
from .registry import ORACLE_SQL, QUERIES

__all__ = ["ORACLE_SQL", "QUERIES"]
