"""Whole jobs composed from sources, operators and tables."""

from silverline.plans.consolidate import consolidate
from silverline.plans.evolve import add_column, drop_column
from silverline.plans.feeds import Feed, rows_of, write_entities
from silverline.plans.inspect_table import TableInspection, inspect_table
from silverline.plans.reconcile import ReconciliationError, reconcile, require_agreement
from silverline.plans.together import Consolidation, Outcome, TablesFailed, consolidate_all, run_together

__all__ = [
    "Consolidation",
    "Feed",
    "Outcome",
    "ReconciliationError",
    "TableInspection",
    "TablesFailed",
    "add_column",
    "consolidate",
    "consolidate_all",
    "drop_column",
    "inspect_table",
    "reconcile",
    "require_agreement",
    "rows_of",
    "run_together",
    "write_entities",
]
