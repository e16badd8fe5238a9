"""The registered queries over the driver's tables, and the same in SQL for DuckDB."""

from tidemark.queries import payloads, quality, stores  # noqa: F401  they register their queries
from tidemark.queries.base import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
