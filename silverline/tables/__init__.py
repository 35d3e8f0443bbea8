from silverline.tables.bucketed_table import BucketedTable
from silverline.tables.catalog_table import CatalogTable
from silverline.tables.partitioned_files import merge_partitions
from silverline.tables.snapshot_table import SnapshotTable

__all__ = ["BucketedTable", "CatalogTable", "SnapshotTable", "merge_partitions", "open_table"]


def open_table(spark, catalog: str | None, database: str, table: str, warehouse: str | None = None):
    """The table named by catalog, database and table.

    A catalog configured in the session (`spark.sql.catalog.<name>`) wins. Otherwise
    the table is a snapshot dataset at `<warehouse>/<database>/<table>`.
    """
    if catalog and spark.conf.get(f"spark.sql.catalog.{catalog}", None):
        return CatalogTable(spark, [catalog, database, table])
    if not warehouse:
        raise ValueError(
            f"catalog {catalog!r} is not configured in this session and no warehouse path was given"
        )
    return SnapshotTable(spark, f"{warehouse.rstrip('/')}/{database}/{table}")
