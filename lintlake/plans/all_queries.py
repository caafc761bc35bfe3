"""Imports every query module, so that the registry is complete."""

from lintlake.plans import analysis_queries, catalog_queries, path_queries, report_queries
from lintlake.plans.registry import oracle_sql, queries

__all__ = ["analysis_queries", "catalog_queries", "oracle_sql", "path_queries", "queries", "report_queries"]
