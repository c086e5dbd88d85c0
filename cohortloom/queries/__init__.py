"""Every operator as a query on the shared tables, with the SQL that must give the same rows."""

from cohortloom.queries.registry import ORACLES, QUERIES
from cohortloom.queries import (  # noqa: F401
    aggregations, expressions, filters, io, joins, ordering, plans, sets,
)

__all__ = ["ORACLES", "QUERIES"]
