"""All queries by name, and the SQL that checks them."""

from . import message_queries, table_queries  # noqa: F401  (they register themselves)
from .registry import ORACLES, QUERIES

FLAGSHIP = "clean_latest_kpis"

__all__ = ["FLAGSHIP", "ORACLES", "QUERIES"]
