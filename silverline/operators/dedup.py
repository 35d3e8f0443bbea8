"""One row per key out of a feed that holds many."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from silverline.functions.columns import col, cols, require_keys, resolve, split_names, unused_name

STRATEGIES = ("window", "max_by")


def latest_per_key(
    df: DataFrame,
    keys: str | Sequence[str],
    order_col: str | None = None,
    *,
    tiebreak: str | Sequence[str] = (),
    strategy: str = "window",
) -> DataFrame:
    """Keep the row with the greatest `order_col` for every key.

    NULL orders lose to any value; rows with a NULL key form one group. Equal
    orders are settled by the `tiebreak` columns, greatest first; without them the
    choice among equals is arbitrary. Without `order_col` any row is kept.

    Both strategies cut every key to one row per input task before the shuffle, so
    a key holding a third of the feed costs its reducer one row per task:

    * `window`: row number with a group limit below the exchange. Best when most
      keys occur a few times.
    * `max_by`: partial aggregation of whole rows. Sorts by key only, which wins
      when keys repeat thousands of times.
    """
    names = require_keys(df, keys)
    if strategy not in STRATEGIES:
        raise ValueError(f"unknown strategy {strategy!r}; choose from {STRATEGIES}")
    if not order_col:
        return any_per_key(df, names)
    order = resolve(df.sparkSession, df.columns, [order_col, *split_names(tiebreak)], "order columns")

    if strategy == "max_by":
        newest = F.max_by(F.struct(*cols(df.columns)), F.struct(*cols(order)))
        return df.groupBy(*cols(names)).agg(newest.alias("newest")).select("newest.*")

    rank = unused_name("rank", df.columns)
    window = Window.partitionBy(*cols(names)).orderBy(*[col(c).desc_nulls_last() for c in order])
    return df.withColumn(rank, F.row_number().over(window)).where(col(rank) == 1).drop(rank)


def any_per_key(df: DataFrame, keys: str | Sequence[str]) -> DataFrame:
    """Keep one row per key, whichever comes first."""
    return df.dropDuplicates(require_keys(df, keys))
