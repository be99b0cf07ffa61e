"""Queries over the given tables, one or more per operator."""

from quayline.workloads import binary, conversions, csv, database, datasets, paging, warehouse  # noqa: F401
from quayline.workloads.registry import ORACLE_SQL, QUERIES

__all__ = ["ORACLE_SQL", "QUERIES"]
