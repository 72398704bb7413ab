"""Operators bound to the driver's tables, each with the SQL that gives the same rows."""

from bindings.registry import ORACLES, QUERIES
from bindings import (  # noqa: F401  (registers the queries)
    evidence_queries,
    isobaric_queries,
    job_queries,
    quant_queries,
    reader_queries,
    statistics_queries,
    taxonomy_queries,
)

__all__ = ["ORACLES", "QUERIES"]
