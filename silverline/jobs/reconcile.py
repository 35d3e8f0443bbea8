"""Check a current-state table against feed partitions; fails when they disagree."""

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
    parser.add_argument("--compare-columns", help="default: all shared columns but keys and partition")
    parser.add_argument("--null-safe", action="store_true", help="compare NULLs as values")
    args = parser.parse_args(argv)

    feed = feed_from(args)
    spark = session.build(f"reconcile-{args.database}.{args.table}")
    try:
        table, rows_read = table_from(spark, args), Observation()
        checks = plans.reconcile(
            spark,
            feed,
            table.current(),
            args.pk,
            args.dedup_col,
            tiebreak=args.tiebreak or (),
            strategy=args.strategy,
            columns=args.compare_columns,
            null_safe=args.null_safe,
            silver_unique=table.holds_keys_once,
            rows_read=rows_read,
        )
        print("rows read:", plans.rows_of(rows_read))
        # a handful of rows: evaluate the checks once, then show and judge them
        checks = spark.createDataFrame(checks.collect(), checks.schema)
        checks.show(checks.count(), truncate=False)
        plans.require_agreement(checks)
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
