"""Snapshot tables: creation, commits, history."""

from __future__ import annotations

from pyspark.sql import functions as F

from registry.base import events, events_latest, events_latest_sql, merged_sql, new_table, query, table
from registry.dedup import LINE_KEY, LINE_TIES, LINES_LATEST
from silverline.operators import latest_per_key

FIRST_HALF = events_latest_sql(last=15)
LATE = events_latest_sql(first=20)


def three_commits(spark, sf_dir):
    """Created empty, then the first half of the month, then the second with some days of the first again."""
    silver = new_table(spark, "silver").ensure(events(spark, sf_dir), "user_id")
    silver.merge(events_latest(spark, sf_dir, last=15), source_unique=True)
    late = events_latest(spark, sf_dir, first=20)
    silver.merge(late, source_unique=True)
    return silver


@query("select 1::bigint as snapshot_id, 0::bigint as n union all select 2, count(distinct o_custkey) from orders")
def table_create_empty(spark, sf_dir):
    """Creation takes the columns but no rows; the first merge brings them."""
    orders = table(spark, sf_dir, "orders")
    silver = new_table(spark, "silver").ensure(orders, "o_custkey")
    silver.merge(latest_per_key(orders, "o_custkey", "o_orderdate", tiebreak="o_orderkey"), source_unique=True)
    sizes = [
        silver.as_of(n).agg(F.lit(n).cast("long").alias("snapshot_id"), F.count("*").alias("n")) for n in (1, 2)
    ]
    return sizes[0].unionByName(sizes[1])


@query(f"select * from {LATE}")
def table_recreate(spark, sf_dir):
    """Recreating forgets the rows merged before."""
    silver = new_table(spark, "silver").ensure(events(spark, sf_dir), "user_id")
    silver.merge(events_latest(spark, sf_dir), source_unique=True)
    silver.ensure(events(spark, sf_dir), "user_id", recreate=True)
    late = events_latest(spark, sf_dir, first=20)
    silver.merge(late, source_unique=True)
    return silver.current()


@query(f"select * from {merged_sql(FIRST_HALF, LATE)}")
def snapshot_current(spark, sf_dir):
    return three_commits(spark, sf_dir).current()


@query(f"select * from {FIRST_HALF}")
def snapshot_as_of(spark, sf_dir):
    return three_commits(spark, sf_dir).as_of(2)


COUNTS = f"""(select (select count(*) from {FIRST_HALF}) as n1, (select count(*) from {LATE}) as n2,
    (select count(*) from {LATE} s semi join {FIRST_HALF} t on s.user_id = t.user_id) as shared)"""
LOG = f"""(select 1::bigint as snapshot_id, 'create' as operation, 0::bigint as inserted, 0::bigint as updated,
    0::bigint as total union all select 2, 'merge', n1, 0, n1 from {COUNTS}
    union all select 3, 'merge', n2 - shared, shared, n1 + n2 - shared from {COUNTS})"""
LOG_COLUMNS = ["snapshot_id", "operation", "inserted", "updated", "total"]


@query(f"select * from {LOG}")
def snapshot_list(spark, sf_dir):
    return three_commits(spark, sf_dir).snapshots().select(*LOG_COLUMNS)


@query(f"select * from {LOG} order by snapshot_id limit 1")
def snapshot_first(spark, sf_dir):
    return three_commits(spark, sf_dir).first_snapshot().select(*LOG_COLUMNS)


@query(f"select * from {LOG} where snapshot_id = 2")
def snapshot_previous(spark, sf_dir):
    return three_commits(spark, sf_dir).previous_snapshot().select(*LOG_COLUMNS)


@query(
    f"""select * from (select * from {FIRST_HALF} union all select * from {events_latest_sql(first=18)})
    qualify row_number() over (partition by user_id order by ts desc, event_id desc) = 1"""
)
def snapshot_guarded(spark, sf_dir):
    """Newer days first, older days second, with a guard."""
    silver = new_table(spark, "silver").ensure(events(spark, sf_dir), "user_id")
    silver.merge(events_latest(spark, sf_dir, first=18), source_unique=True)
    silver.merge(events_latest(spark, sf_dir, last=15), guard="ts,event_id", source_unique=True)
    return silver.current()


@query(LINES_LATEST)
def snapshot_partitioned(spark, sf_dir):
    """Table partitioned by a column whose value changes as rows are updated."""
    lines = table(spark, sf_dir, "lineitem")
    silver = new_table(spark, "silver").ensure(lines, LINE_KEY, partitions="l_returnflag", buckets=4)
    middle = "timestamp_ntz '1998-06-01 00:00:00'"
    for part in (lines.where(f"l_shipdate < {middle}"), lines.where(f"l_shipdate >= {middle}")):
        silver.merge(latest_per_key(part, LINE_KEY, "l_shipdate", tiebreak=LINE_TIES), source_unique=True)
    return silver.current()


@query(f"select least(count(*), 20)::bigint as n, true as all_held from {events_latest_sql()}")
def preview_limit(spark, sf_dir):
    """A preview returns any rows of the table, as many as asked for."""
    silver = new_table(spark, "silver").ensure(events(spark, sf_dir), "user_id")
    silver.merge(events_latest(spark, sf_dir), source_unique=True)
    shown, held = silver.preview(20), silver.current().select("event_id", F.lit(True).alias("held"))
    found = shown.join(held, "event_id", "left")
    return found.agg(F.count("*").alias("n"), F.every(F.coalesce("held", F.lit(False))).alias("all_held"))
