"""All queries of the library, and SQL for them."""

from __future__ import annotations

from . import catalog, more_queries

QUERIES = catalog.QUERIES | more_queries.QUERIES
ORACLES = catalog.ORACLES | more_queries.oracles(catalog.ORACLES)
