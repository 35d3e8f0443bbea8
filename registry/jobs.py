"""Whole jobs: feed on disk, table on disk, checks between them."""

from __future__ import annotations

from pyspark.sql import functions as F

from registry.base import events, events_latest_sql, merged_sql, new_table, query, table
from registry.dedup import LINE_KEY, LINE_TIES, LINES_LATEST
from registry.feeds import days_sql, records_sql
from silverline import plans
from silverline.operators import change_feed, daily_versions
from silverline.plans import Feed
from silverline.session import scratch_path
from silverline.sinks import write_partitioned
from silverline.sources import resolve_partitions
from silverline.streaming import consolidate_stream


def _events_feed(spark, sf_dir):
    return write_partitioned(events(spark, sf_dir), scratch_path(spark, "feed"), ["dt_ref"])


def _days(path, first, last):
    return Feed(path, "dt_ref", resolve_partitions(between=(first, last)))


def _reach(rows, column, first, last):
    """From the least to the greatest value of a column, and at least from `first` to `last`."""
    low, high = rows.agg(F.min(column).cast("string"), F.max(column).cast("string")).first()
    return min(low or first, first), max(high or last, last)


FIRST_HALF = events_latest_sql(last="2024-01-15")


@query(f"select * from {merged_sql(FIRST_HALF, events_latest_sql(first='2024-01-10'))}")
def consolidate_ranges(spark, sf_dir):
    """Two overlapping ranges of days, one after the other, which reach from the first day to the last."""
    path, silver = _events_feed(spark, sf_dir), new_table(spark, "silver")
    begin, end = _reach(events(spark, sf_dir), "dt_ref", "2024-01-10", "2024-01-15")
    for first, last in ((begin, "2024-01-15"), ("2024-01-10", end)):
        plans.consolidate(spark, _days(path, first, last), silver, "user_id", "ts", tiebreak="event_id")
    return silver.current()


@query(f"select * from {events_latest_sql()}")
def consolidate_replay(spark, sf_dir):
    """Running all days twice changes nothing."""
    path, silver = _events_feed(spark, sf_dir), new_table(spark, "silver")
    begin, end = _reach(events(spark, sf_dir), "dt_ref", "2024-01-01", "2024-01-30")
    for _ in range(2):
        feed = _days(path, begin, end)
        plans.consolidate(spark, feed, silver, "user_id", "ts", tiebreak="event_id", strategy="max_by")
    return silver.current()


@query(LINES_LATEST.replace("select *", "select *, strftime(l_shipdate, '%Y-%m') as month"))
def consolidate_composite_key(spark, sf_dir):
    """Line items fed by month of shipping, in two runs over all months, newest date guarded."""
    lines = table(spark, sf_dir, "lineitem").withColumn("month", F.date_format("l_shipdate", "yyyy-MM"))
    path = write_partitioned(lines, scratch_path(spark, "feed"), ["month"])
    silver = new_table(spark, "silver")
    begin, end = _reach(lines, "month", "1998-06", "1998-07")
    for first, last in (("1998-07", end), (begin, "1998-06")):
        months = resolve_partitions(between=(first, last), fmt="%Y-%m")
        feed = Feed(path, "month", months, partition_format="%Y-%m", schema=lines.schema)
        plans.consolidate(
            spark, feed, silver, LINE_KEY, "l_shipdate", tiebreak=LINE_TIES, guard=["l_shipdate", *LINE_TIES]
        )
    return silver.current()


PART_FEED = records_sql(days_sql("part", "2026-01-01", "2026-01-10"), "p_partkey", "product", "2026-01-01", 1000)


@query(f"select * from ({PART_FEED}) qualify row_number() over (partition by id_product order by dat_kafka desc) = 1")
def consolidate_change_feed(spark, sf_dir):
    """A generated ten-day feed: the kept row always comes from the last day."""
    days = daily_versions(table(spark, sf_dir, "part"), "2026-01-01", "2026-01-10")
    records = change_feed(
        days, "p_partkey", "dt_ref", "product", 1000, "2026-01-01", timestamp_type="timestamp_ntz"
    )
    path, silver = write_partitioned(records, scratch_path(spark, "feed"), ["dt_ref"]), new_table(spark, "silver")
    plans.consolidate(spark, _days(path, "2026-01-01", "2026-01-10"), silver, "id_product", "dat_kafka")
    return silver.current()


BRONZE = events_latest_sql()
CHECKED = ["event_id", "ts", "event_type", "value", "props"]


def _job_report(silver):
    diffs = " union all ".join(
        f"select 'column_values', '{c}', null, null, (select count(*) from {BRONZE} b "
        f"join {silver} s on b.user_id = s.user_id where b.{c} <> s.{c})"
        for c in CHECKED
    )
    return f"""select *, violations = 0 as passed from (
    select 'counts' as "check", 'rows' as item, b as bronze_rows, s as silver_rows, abs(b - s) as violations
    from (select (select count(*) from {BRONZE}) as b, (select count(*) from {silver}) as s)
    union all select 'key_coverage', 'missing', null, null, (select count(distinct b.user_id) from {BRONZE} b
    where not exists (select 1 from {silver} s where s.user_id = b.user_id)) union all {diffs})"""


def _consolidated_then_checked(spark, sf_dir, last=None):
    """A table of the days up to `last` against all days of the feed."""
    path, silver = _events_feed(spark, sf_dir), new_table(spark, "silver")
    begin, end = _reach(events(spark, sf_dir), "dt_ref", last or "2024-01-01", last or "2024-01-30")
    plans.consolidate(spark, _days(path, begin, last or end), silver, "user_id", "ts", tiebreak="event_id")
    everything = _days(path, begin, end)
    return plans.reconcile(
        spark, everything, silver.current(), "user_id", "ts", tiebreak="event_id",
        silver_unique=silver.holds_keys_once,
    )


@query(_job_report(BRONZE))
def reconcile_fresh_table(spark, sf_dir):
    """A table that has merged all days agrees with them."""
    return _consolidated_then_checked(spark, sf_dir)


@query(_job_report(events_latest_sql(last="2024-01-02")))
def reconcile_stale_table(spark, sf_dir):
    """A table that stopped on the second day does not."""
    return _consolidated_then_checked(spark, sf_dir, "2024-01-02")


@query(f"select * from {events_latest_sql()}")
def stream_consolidate(spark, sf_dir):
    """Files of the feed merged a few at a time as a stream."""
    path, silver = _events_feed(spark, sf_dir), new_table(spark, "silver")
    run = consolidate_stream(
        spark, path, events(spark, sf_dir).schema, silver, "user_id", "ts",
        scratch_path(spark, "stream"), tiebreak="event_id", max_files_per_batch=12,
    )
    run.awaitTermination()
    return silver.current()
