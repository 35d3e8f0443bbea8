"""Every query of the library on the test tables, each next to its SQL."""

from registry import catalogs, dedup, evolution, feeds, jobs, layouts, reads, reconciliation, snapshots, upserts
from registry.base import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
