"""Add a column to a table or drop one."""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from silverline import plans, session
from silverline.jobs.options import add_table_options, table_from


def main(argv: Sequence[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("action", choices=["add", "drop"])
    add_table_options(parser)
    parser.add_argument("--column-name", required=True)
    parser.add_argument("--column-type", help="any SQL type; needed to add")
    parser.add_argument("--comment")
    args = parser.parse_args(argv)
    if args.action == "add" and not args.column_type:
        parser.error("--column-type is needed to add a column")

    spark = session.build(f"evolve-{args.database}.{args.table}")
    try:
        table = table_from(spark, args)
        if args.action == "add":
            columns = plans.add_column(table, args.column_name, args.column_type, args.comment)
        else:
            columns = plans.drop_column(table, args.column_name)
        columns.show(columns.count(), truncate=False)
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
