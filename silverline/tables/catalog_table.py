"""A current-state table in a Spark catalog whose connector can merge rows.

The same surface as `SnapshotTable`, carried out by Spark's table commands, so the
connector's own storage, commits and history are used.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from silverline.functions.columns import (
    all_of,
    col,
    cols,
    require_keys,
    resolve,
    split_names,
    typed_null,
)
from silverline.operators.upsert import align, require_unique_keys
from silverline.session import materialise


class CatalogTable:
    # others may write to the table too
    holds_keys_once = False

    def __init__(self, spark: SparkSession, name: Sequence[str], provider: str | None = "iceberg"):
        self.spark = spark
        self.name = ".".join(_quote(part) for part in name)
        self.provider = provider

    # -- life cycle ---------------------------------------------------------

    def exists(self) -> bool:
        return self.spark.catalog.tableExists(self.name)

    def ensure(
        self,
        like: DataFrame,
        keys: str | Sequence[str],
        *,
        partitions: str | Sequence[str] | None = None,
        buckets: int | None = None,
        recreate: bool = False,
    ) -> CatalogTable:
        """Create the table empty with the columns of `like`, unless it exists.

        `buckets` has no meaning here; the connector lays out its own files.
        """
        require_keys(like, keys)
        parts = resolve(self.spark, like.columns, split_names(partitions), "partition columns")
        if recreate:
            self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")
        if not self.exists():
            writer = like.limit(0).writeTo(self.name)
            if self.provider:
                writer = writer.using(self.provider)
            if parts:
                writer = writer.partitionedBy(*cols(parts))
            writer.create()
        elif parts:
            own = [c.name for c in self.spark.catalog.listColumns(self.name) if c.isPartition]
            if own != parts:
                raise ValueError(f"table is partitioned by {own}, not {parts}")
        return self

    # -- reading ------------------------------------------------------------

    def current(self) -> DataFrame:
        return self.spark.table(self.name)

    def as_of(self, snapshot_id: int) -> DataFrame:
        return self.spark.sql(f"SELECT * FROM {self.name} VERSION AS OF {int(snapshot_id)}")

    def snapshots(self) -> DataFrame:
        return self.spark.table(f"{self.name}.snapshots")

    def first_snapshot(self) -> DataFrame:
        return self.snapshots().orderBy("committed_at").limit(1)

    def previous_snapshot(self) -> DataFrame:
        newest_two = self.snapshots().orderBy(col("committed_at").desc()).limit(2)
        return newest_two.orderBy(col("committed_at").desc()).offset(1)

    def preview(self, n: int = 10) -> DataFrame:
        return self.current().limit(n)

    def describe(self) -> DataFrame:
        return self.spark.sql(f"DESCRIBE TABLE {self.name}")

    # -- writing ------------------------------------------------------------

    def merge(
        self,
        source: DataFrame,
        keys: str | Sequence[str],
        *,
        guard: str | Sequence[str] = (),
        fill_missing: bool = False,
        source_unique: bool = False,
    ) -> None:
        """MERGE the source by key. It is written out first, because the connector may
        evaluate it more than once."""
        target = self.current()
        names = require_keys(target, keys)
        ages = resolve(self.spark, target.columns, split_names(guard), "guard columns")
        incoming = align(source, target.schema, fill_missing=fill_missing, required=[*names, *ages])
        incoming = materialise(incoming, "merge-source")
        if not source_unique:
            require_unique_keys(incoming, names).select(*cols(names)).write.format("noop").mode("overwrite").save()
        incoming = incoming.alias("source")
        match = all_of(col(k, self.name).eqNullSafe(col(k, "source")) for k in names)
        newer = None
        if ages:
            newer = F.struct(*cols(ages, "source")) >= F.struct(*cols(ages, self.name))
        writer = incoming.mergeInto(self.name, match).whenMatched(newer).updateAll()
        writer.whenNotMatched().insertAll().merge()

    def append(self, rows: DataFrame, *, fill_missing: bool = False) -> None:
        """Add rows, matched to the table's columns by name. Every provider can; keys are not looked at."""
        align(rows, self.current().schema, fill_missing=fill_missing).write.insertInto(self.name)

    def drop(self) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")

    def add_column(self, name: str, column_type: str, comment: str | None = None) -> None:
        # parsed first, so only a type can reach the statement
        dtype = self.spark.range(0).select(typed_null(column_type).alias("c")).schema["c"].dataType
        clause = " COMMENT :comment" if comment else ""
        args = {"comment": comment} if comment else None
        self.spark.sql(
            f"ALTER TABLE {self.name} ADD COLUMN {_quote(name)} {dtype.simpleString()}{clause}", args=args
        )

    def drop_column(self, name: str) -> None:
        self.spark.sql(f"ALTER TABLE {self.name} DROP COLUMN {_quote(name)}")


def _quote(part: str) -> str:
    return "`" + part.replace("`", "``") + "`"
