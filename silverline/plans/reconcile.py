"""Check a current-state table against its feed."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession

from silverline.functions.columns import col
from silverline.operators.dedup import latest_per_key
from silverline.operators.reconcile import CHECK_COUNTS, CHECK_KEYS, CHECK_SCHEMA, CHECK_VALUES, report
from silverline.plans.feeds import Feed, counted
from silverline.session import materialise

ORDER = (CHECK_COUNTS, CHECK_KEYS, CHECK_SCHEMA, CHECK_VALUES)


class ReconciliationError(AssertionError):
    """Feed and table disagree."""


def reconcile(
    spark: SparkSession,
    feed: Feed,
    silver: DataFrame,
    keys: str | Sequence[str],
    order_col: str | None = None,
    *,
    tiebreak: str | Sequence[str] = (),
    strategy: str = "window",
    columns: str | Sequence[str] | None = None,
    null_safe: bool = False,
    silver_unique: bool = False,
    maps: bool = False,
    rows_read: Observation | None = None,
) -> DataFrame:
    """The report of all checks, one row per check.

    Counts compare the chosen partitions with the whole table, so they agree only
    when the range covers every key. Without `columns`, all columns found on both
    sides are compared except keys and the feed's partition column, and columns of one side only fail. Say
    `silver_unique` for a table that cannot hold a key twice; the checks then take a
    single join. `maps` compares columns holding maps. `rows_read` receives the feed's rows before they are reduced, as `rows`.
    """
    bronze = latest_per_key(counted(feed.read(spark), rows_read), keys, order_col, tiebreak=tiebreak, strategy=strategy)
    bronze = materialise(bronze, "bronze-latest")
    return report(
        bronze,
        silver,
        keys,
        columns,
        exclude=[feed.partition_col],
        null_safe=null_safe,
        silver_unique=silver_unique,
        maps=maps,
    )


def require_agreement(checks: DataFrame) -> None:
    """Raise for the first kind of check that failed: counts, then keys, columns, values."""
    # one row per compared column
    failed = checks.where(~col("passed")).collect()
    for kind in ORDER:
        found = {r["item"]: r["violations"] for r in failed if r["check"] == kind}
        if found:
            raise ReconciliationError(f"{kind}: {found}")
