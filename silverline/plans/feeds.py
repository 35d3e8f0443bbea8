"""Where a feed lives and which part of it to use."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from datetime import date

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from silverline.operators.feed import change_feed, daily_versions
from silverline.sinks import write_partitioned
from silverline.sources import read_partitioned
from silverline.sources.partitions import ISO_DAY


@dataclass(frozen=True)
class Feed:
    """A partitioned feed and the partitions chosen from it."""

    uri: str
    partition_col: str
    partitions: Sequence[str] | DataFrame | None = None
    fmt: str = "parquet"
    partition_format: str = ISO_DAY
    infer_schema: bool = False
    csv_header: bool = False
    schema: T.StructType | str | None = None
    options: Mapping[str, str] = field(default_factory=dict)
    list_selected_only: bool = False
    evolving: bool = False

    def read(self, spark: SparkSession) -> DataFrame:
        return read_partitioned(
            spark,
            self.uri,
            self.partition_col,
            self.partitions,
            fmt=self.fmt,
            partition_format=self.partition_format,
            infer_schema=self.infer_schema,
            csv_header=self.csv_header,
            schema=self.schema,
            options=self.options,
            list_selected_only=self.list_selected_only,
            evolving=self.evolving,
        )


def counted(rows: DataFrame, rows_read: Observation | None) -> DataFrame:
    """`rows`, whose number `rows_read` receives from the run that reads them: no pass of its own."""
    return rows if rows_read is None else rows.observe(rows_read, F.count(F.lit(1)).alias("rows"))


def rows_of(rows_read: Observation) -> int:
    return rows_read.get.get("rows", 0)


def write_entities(
    entities: Mapping[str, tuple[DataFrame, str]],
    output_root: str,
    schema_name: str,
    first_day: date | str,
    last_day: date | str,
    key_space: int,
) -> dict[str, str]:
    """Write one daily change feed per entity; returns the path of each.

    `entities` maps a name to a table and its row-number column. Every row changes
    once a day.
    """
    paths = {}
    for name, (rows, id_col) in entities.items():
        days = daily_versions(rows.select(id_col), first_day, last_day)
        feed = change_feed(days, id_col, "dt_ref", name, key_space, first_day)
        path = f"{output_root.rstrip('/')}/{schema_name}/{name}"
        paths[name] = write_partitioned(feed, path, ["dt_ref"])
    return paths
