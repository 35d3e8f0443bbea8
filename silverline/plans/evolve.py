"""Column changes on an existing table."""

from __future__ import annotations

from pyspark.sql import DataFrame

from silverline.tables import CatalogTable, SnapshotTable


def add_column(
    table: SnapshotTable | CatalogTable, name: str, column_type: str, comment: str | None = None
) -> DataFrame:
    """Add a column and return the new description."""
    table.add_column(name, column_type, comment)
    return table.describe()


def drop_column(table: SnapshotTable | CatalogTable, name: str) -> DataFrame:
    """Drop a column and return the new description."""
    table.drop_column(name)
    return table.describe()
