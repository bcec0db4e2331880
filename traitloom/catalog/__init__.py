"""Every operator and job as a named query over the driver's tables, with the SQL that gives the same rows."""

from traitloom.catalog import (  # noqa: F401  (importing registers the queries)
    column_queries,
    file_queries,
    filter_queries,
    group_queries,
    job_queries,
    value_queries,
)
from traitloom.catalog.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
