"""Merges and checks that use how a table is stored: by bucket, by partition, by hash cell."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from registry.base import events, events_latest, events_latest_sql, merged_sql, query, table
from registry.reconciliation import (
    BRONZE,
    KEYED,
    NULL_SAFE,
    NULL_SAFE_DIFFS,
    PLAIN,
    PLAIN_DIFFS,
    SILVER,
    _diffs,
    _keyed,
    _missing,
    _report,
    _silver,
    _stored,
)
from registry.upserts import FIRST_HALF, LATER, _null_keyed_sql, null_keyed
from silverline.operators import column_diffs, digest_report, latest_per_key, report, upsert
from silverline.session import materialise, scratch_path
from silverline.sinks import write_partitioned
from silverline.tables import BucketedTable, merge_partitions


def _bucketed(spark):
    name = ["default", f"silver_{uuid.uuid4().hex}"]
    return BucketedTable(spark, name, scratch_path(spark, "bucketed"))


@query(f"select * from {merged_sql(FIRST_HALF, LATER)}")
def upsert_bucketed_table(spark, sf_dir):
    """Two merges into a bucketed table: the rows that it holds are never shuffled."""
    silver = _bucketed(spark).ensure(events(spark, sf_dir), "user_id")
    silver.merge(events_latest(spark, sf_dir, last=15), source_unique=True)
    silver.merge(events_latest(spark, sf_dir, first=20), source_unique=True)
    return silver.current()


@query(f"select * from {merged_sql(_null_keyed_sql('true'), _null_keyed_sql('value > 50'), 'k')}")
def upsert_bucketed_table_null_key(spark, sf_dir):
    """More buckets than shuffle partitions, and a NULL key."""
    rows = null_keyed(spark, sf_dir)
    silver = _bucketed(spark).ensure(rows, "k", buckets=24)
    for changes in (rows, rows.where("value > 50")):
        silver.merge(latest_per_key(changes, "k", "ts", tiebreak="event_id"), "k")
    return silver.current()


@query(_report(_missing(PLAIN), PLAIN_DIFFS))
def reconcile_bucketed_table(spark, sf_dir):
    """The report against a bucketed table: one join, of which only the feed's side is shuffled."""
    stale = _silver(spark, sf_dir)
    silver = _bucketed(spark).ensure(stale, "k")
    silver.merge(stale, source_unique=True)
    bronze, _ = _stored(spark, sf_dir)
    return report(bronze, silver.current(), "k", exclude=["o_orderdate"], silver_unique=silver.holds_keys_once)


MONTHS = "(select *, strftime(o_orderdate, '%Y-%m') as month from orders)"
NEWEST = "qualify row_number() over (partition by o_custkey order by o_orderdate desc, o_orderkey desc) = 1"
EARLIER, RECENT = (
    f"(select * from {MONTHS} where o_orderdate {op} (select max(o_orderdate) - interval 60 day from orders) {NEWEST})"
    for op in ("<", ">=")
)


def _orders_by_month(spark, sf_dir):
    """The latest order of every customer before the last sixty days, and since."""
    orders = table(spark, sf_dir, "orders").withColumn("month", F.date_format("o_orderdate", "yyyy-MM"))
    cut = orders.agg(F.max("o_orderdate") - F.expr("interval 60 days")).first()[0]
    before, since = orders.where(F.col("o_orderdate") < F.lit(cut)), orders.where(F.col("o_orderdate") >= F.lit(cut))
    return [latest_per_key(df, "o_custkey", "o_orderdate", tiebreak="o_orderkey") for df in (before, since)]


@query(f"select * from {merged_sql(EARLIER, RECENT, 'o_custkey')}")
def merge_touched_partitions(spark, sf_dir):
    """A customer's newer order takes the place of the one before, which lies in another month."""
    held, arriving = _orders_by_month(spark, sf_dir)
    path = write_partitioned(held, scratch_path(spark, "silver"), ["month"])
    merge_partitions(spark, path, arriving, "o_custkey", "month", source_unique=True)
    return spark.read.parquet(path)


LAST_DAYS = events_latest_sql(first=3)


@query(f"""select * from (select * from {events_latest_sql()} t where not exists (
    select 1 from {LAST_DAYS} s where s.user_id = t.user_id and s.dt_ref = t.dt_ref)
    union all by name select * from {LAST_DAYS})""")
def merge_partitions_in_place(spark, sf_dir):
    """Keys that never leave their partition: only the last days are read and replaced."""
    path = write_partitioned(events_latest(spark, sf_dir), scratch_path(spark, "silver"), ["dt_ref"])
    arriving = events_latest(spark, sf_dir, first=3)
    merge_partitions(spark, path, arriving, ["user_id"], "dt_ref", source_unique=True, moves="ignore")
    return spark.read.parquet(path)


LAST_ORDERS = """(select * replace (o_totalprice + 1 as o_totalprice) from orders
    where o_orderdate >= (select max(o_orderdate) - interval 3 day from orders))"""


@query(f"select * from {merged_sql('orders', LAST_ORDERS, 'o_orderkey')}")
def upsert_split(spark, sf_dir):
    """Few source keys: orders that no source key can match are passed on without a shuffle."""
    orders = table(spark, sf_dir, "orders")
    cut = orders.agg(F.max("o_orderdate") - F.expr("interval 3 days")).first()[0]
    changed = orders.where(F.col("o_orderdate") >= F.lit(cut)).withColumn("o_totalprice", F.col("o_totalprice") + 1)
    return upsert(orders, changed, "o_orderkey", strategy="split")


@query(f"select * from {merged_sql(_null_keyed_sql('true'), _null_keyed_sql('value > 50'), 'k')}")
def upsert_split_null_key(spark, sf_dir):
    df = null_keyed(spark, sf_dir)
    target = materialise(latest_per_key(df, "k", "ts", tiebreak="event_id"), "target")
    source = latest_per_key(df.where("value > 50"), "k", "ts", tiebreak="event_id")
    return upsert(target, source, "k", source_unique=True, strategy="split")


@query(_report(_missing(PLAIN), PLAIN_DIFFS))
def reconcile_digest(spark, sf_dir):
    """The whole report, with only those hash cells joined that differ."""
    bronze, silver = _stored(spark, sf_dir)
    return digest_report(bronze, silver, "k", exclude=["o_orderdate"])


@query(_report(_missing(NULL_SAFE), NULL_SAFE_DIFFS))
def reconcile_digest_null_safe(spark, sf_dir):
    bronze, silver = _stored(spark, sf_dir)
    return digest_report(bronze, silver, "k", exclude=["o_orderdate"], null_safe=True, cells=64)


FRESH = _report("select k from (select 1 as k) where false", "select 0::bigint as o_orderkey, 0::bigint as o_totalprice, "
                "0::bigint as o_orderstatus, 0::bigint as o_orderpriority")


@query(FRESH.replace(SILVER, BRONZE))
def reconcile_digest_fresh(spark, sf_dir):
    """Tables that agree: nothing is joined."""
    bronze, _ = _stored(spark, sf_dir)
    return digest_report(bronze, materialise(bronze, "silver"), "k", exclude=["o_orderdate"], null_safe=True)


#: Every order as a row of silver, so that its keys repeat.
REPEATED = f"(select * replace (nullif(o_orderpriority, '1-URGENT') as o_orderpriority) from {KEYED})"


@query(_diffs(NULL_SAFE, "b.{c} is distinct from s.{c}").replace(SILVER, REPEATED))
def reconcile_repeated_silver_null_safe(spark, sf_dir):
    """Silver repeats its keys: each of its rows is compared with the bronze row of its key."""
    bronze, _ = _stored(spark, sf_dir)
    silver = _keyed(spark, sf_dir).withColumn("o_orderpriority", F.nullif("o_orderpriority", F.lit("1-URGENT")))
    return column_diffs(bronze, silver, "k", exclude=["o_orderdate"], null_safe=True)
