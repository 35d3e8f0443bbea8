"""Merge feed partitions into a current-state table."""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import Observation

from silverline import plans, session
from silverline.jobs.options import add_feed_options, add_table_options, feed_from, table_from


def main(argv: Sequence[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    add_table_options(parser)
    add_feed_options(parser)
    parser.add_argument("--silver-partitions", help="partition columns of the table")
    parser.add_argument("--recreate-silver", action="store_true")
    parser.add_argument("--buckets", type=int, default=None, help="buckets of a new snapshot table")
    parser.add_argument("--guard", help="columns; a row older on them than the table's row is ignored")
    parser.add_argument("--fill-missing", action="store_true", help="NULL for columns the feed lacks")
    parser.add_argument("--count-input", action="store_true", help="print schema and rows read")
    args = parser.parse_args(argv)

    feed = feed_from(args)
    spark = session.build(f"consolidate-{args.database}.{args.table}")
    try:
        if args.count_input:
            feed.read(spark).printSchema()
        rows_read = Observation() if args.count_input else None
        plans.consolidate(
            spark,
            feed,
            table_from(spark, args),
            args.pk,
            args.dedup_col,
            tiebreak=args.tiebreak or (),
            strategy=args.strategy,
            partitions=args.silver_partitions,
            buckets=args.buckets,
            recreate=args.recreate_silver,
            guard=args.guard or (),
            fill_missing=args.fill_missing,
            rows_read=rows_read,
        )
        if rows_read:
            print("rows read:", plans.rows_of(rows_read))
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
