"""Feed to current-state table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Observation, SparkSession

from silverline.operators.dedup import latest_per_key
from silverline.plans.feeds import Feed, counted
from silverline.tables import CatalogTable, SnapshotTable


def consolidate(
    spark: SparkSession,
    feed: Feed,
    table: SnapshotTable | CatalogTable,
    keys: str | Sequence[str],
    order_col: str | None = None,
    *,
    tiebreak: str | Sequence[str] = (),
    strategy: str = "window",
    partitions: str | Sequence[str] | None = None,
    buckets: int | None = None,
    recreate: bool = False,
    guard: str | Sequence[str] = (),
    fill_missing: bool = False,
    rows_read: Observation | None = None,
) -> SnapshotTable | CatalogTable:
    """Merge the latest row per key of the chosen feed partitions into `table`.

    The table is created from the feed's columns when absent. The feed is scanned
    once and crosses the network once, already cut to a row per key and task.
    `rows_read` receives the number of rows scanned, as `rows`.
    """
    changes = feed.read(spark)
    table.ensure(changes, keys, partitions=partitions, buckets=buckets, recreate=recreate)
    latest = latest_per_key(counted(changes, rows_read), keys, order_col, tiebreak=tiebreak, strategy=strategy)
    table.merge(latest, keys, guard=guard, fill_missing=fill_missing, source_unique=True)
    return table
