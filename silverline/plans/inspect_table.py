"""A look at a table: its columns, some rows now, some rows at its first snapshot."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from silverline.tables import CatalogTable, SnapshotTable


@dataclass(frozen=True)
class TableInspection:
    columns: DataFrame
    rows: DataFrame
    first_snapshot: DataFrame
    rows_then: DataFrame | None


def inspect_table(table: SnapshotTable | CatalogTable, limit: int = 10) -> TableInspection:
    first = table.first_snapshot()
    row = first.first()
    then = table.as_of(row["snapshot_id"]).limit(limit) if row else None
    return TableInspection(table.describe(), table.preview(limit), first, then)
