"""Show a table's columns, some rows, its first snapshot and some rows of that."""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from silverline import plans, session
from silverline.jobs.options import add_table_options, table_from


def main(argv: Sequence[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    add_table_options(parser)
    parser.add_argument("--limit", type=int, default=10)
    args = parser.parse_args(argv)

    spark = session.build(f"inspect-{args.database}.{args.table}")
    try:
        seen = plans.inspect_table(table_from(spark, args), args.limit)
        seen.columns.show(seen.columns.count(), truncate=False)
        seen.rows.show(args.limit)
        seen.first_snapshot.show(truncate=False)
        if seen.rows_then is not None:
            seen.rows_then.show(args.limit)
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
