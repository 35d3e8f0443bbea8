"""Command-line options shared by the jobs."""

from __future__ import annotations

import argparse

from silverline.operators.dedup import STRATEGIES
from silverline.plans import Feed
from silverline.sources import resolve_partitions
from silverline.sources.partitions import ISO_DAY
from silverline.tables import open_table


def add_table_options(parser: argparse.ArgumentParser) -> None:
    group = parser.add_argument_group("table")
    group.add_argument("--catalog", help="a catalog configured in the session")
    group.add_argument("--database", required=True)
    group.add_argument("--table", required=True)
    group.add_argument("--warehouse", help="root of snapshot tables, used without a catalog")


def table_from(spark, args):
    return open_table(spark, args.catalog, args.database, args.table, args.warehouse)


def add_feed_options(parser: argparse.ArgumentParser) -> None:
    group = parser.add_argument_group("feed")
    group.add_argument("--bronze-uri", required=True)
    group.add_argument("--source-format", default="parquet", help="parquet, json, csv, avro, orc, ..")
    group.add_argument("--partition-col", required=True)
    chosen = group.add_mutually_exclusive_group(required=True)
    chosen.add_argument("--partition-values", help="comma-separated list")
    chosen.add_argument("--partition-range", help="first,last; both included")
    group.add_argument("--partition-format", default=ISO_DAY)
    group.add_argument("--infer-schema", action="store_true")
    group.add_argument("--csv-header", action="store_true")
    group.add_argument("--source-schema", help="DDL of the feed; saves schema inference")
    group.add_argument("--list-selected-only", action="store_true")

    group = parser.add_argument_group("keys")
    group.add_argument("--pk", required=True, help="key columns, comma-separated")
    group.add_argument("--dedup-col", help="the latest value of this column wins")
    group.add_argument("--tiebreak", help="columns that settle equal dedup values")
    group.add_argument("--strategy", default="window", choices=STRATEGIES)


def feed_from(args) -> Feed:
    return Feed(
        uri=args.bronze_uri,
        partition_col=args.partition_col,
        partitions=resolve_partitions(args.partition_values, args.partition_range, args.partition_format),
        fmt=args.source_format,
        partition_format=args.partition_format,
        infer_schema=args.infer_schema,
        csv_header=args.csv_header,
        schema=args.source_schema,
        list_selected_only=args.list_selected_only,
    )
