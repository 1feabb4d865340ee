"""Named queries and the SQL they are checked against."""

from .oracle import ORACLE_SQL
from .queries import QUERIES

__all__ = ["ORACLE_SQL", "QUERIES"]
