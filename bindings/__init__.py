"""The operators bound to the given tables, each with DuckDB SQL for the same result.

Every binding reads a whole table, or rows Spark derives from one, so its work
grows with the data.
"""

from . import aggregates, cutoffs, dates_links, extraction, loading, filters, streams
from .base import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES", "aggregates", "cutoffs", "dates_links", "extraction", "filters", "loading", "streams"]
