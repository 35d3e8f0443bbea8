"""The consolidation run incrementally over files as they arrive in the feed."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from silverline.functions.columns import split_names
from silverline.operators.dedup import latest_per_key
from silverline.tables import CatalogTable, SnapshotTable


def consolidate_stream(
    spark: SparkSession,
    feed_uri: str,
    schema: T.StructType | str,
    table: SnapshotTable | CatalogTable,
    keys: str | Sequence[str],
    order_col: str,
    checkpoint: str,
    *,
    tiebreak: str | Sequence[str] = (),
    fmt: str = "parquet",
    max_files_per_batch: int | None = None,
    fill_missing: bool = False,
) -> StreamingQuery:
    """Merge every file not yet seen, then stop; returns the started query.

    Files may arrive in any order, so merges are guarded by the order and tie-break
    columns: an older record never replaces a newer one. That also makes a batch
    repeated after a failure harmless. With `fill_missing`, columns the table got since read NULL until the feed has them.
    """
    reader = spark.readStream.format(fmt).schema(schema)
    if max_files_per_batch:
        reader = reader.option("maxFilesPerTrigger", max_files_per_batch)

    def merge(batch: DataFrame, batch_id: int) -> None:
        table.ensure(batch, keys)
        latest = latest_per_key(batch, keys, order_col, tiebreak=tiebreak)
        table.merge(latest, keys, guard=[order_col, *split_names(tiebreak)], fill_missing=fill_missing)

    return (
        reader.load(feed_uri)
        .writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
