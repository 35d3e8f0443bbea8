"""Write daily change feeds derived from the rows of existing tables."""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from silverline import plans, session


def main(argv: Sequence[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument(
        "--entity",
        action="append",
        required=True,
        metavar="NAME=TABLE_URI:ID_COLUMN",
        help="repeat for several entities",
    )
    parser.add_argument("--output-root", required=True)
    parser.add_argument("--schema", required=True, help="directory between root and entity")
    parser.add_argument("--start-date", required=True)
    parser.add_argument("--end-date", required=True)
    parser.add_argument("--key-space", type=int, default=500, help="distinct keys per entity")
    args = parser.parse_args(argv)

    spark = session.build(f"make-feed-{args.schema}")
    try:
        entities = {}
        for text in args.entity:
            name, _, source = text.partition("=")
            uri, _, id_col = source.rpartition(":")
            entities[name] = (spark.read.parquet(uri), id_col)
        paths = plans.write_entities(
            entities, args.output_root, args.schema, args.start_date, args.end_date, args.key_space
        )
        for name, path in paths.items():
            print(name, path)
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
