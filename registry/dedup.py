"""One row per key, over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from registry.base import events, events_latest, events_latest_sql, query, table
from silverline.operators import any_per_key, latest_per_key

LINE_KEY = ["l_orderkey", "l_linenumber"]
LINE_TIES = ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax"]
LINES_LATEST = f"""select * from lineitem qualify row_number() over (
    partition by {", ".join(LINE_KEY)}
    order by l_shipdate desc nulls last, {", ".join(c + " desc nulls last" for c in LINE_TIES)}) = 1"""


@query(f"select * from {events_latest_sql()}")
def dedup_latest(spark, sf_dir):
    return events_latest(spark, sf_dir)


@query(f"select * from {events_latest_sql()}")
def dedup_latest_max_by(spark, sf_dir):
    return latest_per_key(events(spark, sf_dir), "user_id", "ts", tiebreak="event_id", strategy="max_by")


@query(LINES_LATEST)
def dedup_composite_key(spark, sf_dir):
    return latest_per_key(table(spark, sf_dir, "lineitem"), LINE_KEY, "l_shipdate", tiebreak=LINE_TIES)


@query(LINES_LATEST)
def dedup_composite_key_max_by(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    return latest_per_key(lines, LINE_KEY, "l_shipdate", tiebreak=LINE_TIES, strategy="max_by")


@query(
    """select * from orders qualify row_number() over (
    partition by o_custkey order by o_orderdate desc nulls last, o_orderkey desc) = 1"""
)
def dedup_ties(spark, sf_dir):
    """Several orders of a customer share a date; the order key settles it."""
    return latest_per_key(table(spark, sf_dir, "orders"), "o_custkey", "o_orderdate", tiebreak="o_orderkey")


NULL_KEYED = "(select nullif(user_id % 10, 0) as k, event_id, ts, event_type, value from events)"


def null_keyed(spark, sf_dir):
    """Events under a ten-valued key, one of which is NULL."""
    return table(spark, sf_dir, "events").select(
        F.nullif(F.col("user_id") % 10, F.lit(0)).alias("k"), "event_id", "ts", "event_type", "value"
    )


@query(
    f"""select * from {NULL_KEYED}
    qualify row_number() over (partition by k order by ts desc nulls last, event_id desc) = 1"""
)
def dedup_null_key(spark, sf_dir):
    return latest_per_key(null_keyed(spark, sf_dir), "k", "ts", tiebreak="event_id")


@query(
    """select user_id, event_id, case when event_type <> 'error' then ts end as seen, event_type from events
    qualify row_number() over (partition by user_id order by seen desc nulls last, event_id desc) = 1"""
)
def dedup_null_order(spark, sf_dir):
    """Rows without an order value lose to any row that has one."""
    df = table(spark, sf_dir, "events")
    seen = F.when(F.col("event_type") != "error", F.col("ts"))
    df = df.select("user_id", "event_id", seen.alias("seen"), "event_type")
    return latest_per_key(df, "user_id", "seen", tiebreak="event_id")


@query("select l_orderkey, l_linenumber from lineitem group by all")
def dedup_any_keys(spark, sf_dir):
    """Which row survives is open, so only its key is shown."""
    return any_per_key(table(spark, sf_dir, "lineitem"), LINE_KEY).select(*LINE_KEY)
