"""Partitioned scans in every format, over feeds written from the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from registry.base import EVENTS, events, query, table
from silverline.session import scratch_path
from silverline.sinks import write_partitioned
from silverline.sources import read_partitioned, resolve_partitions

ORDERS = "select o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority from orders"


def _events_feed(spark, sf_dir):
    return write_partitioned(events(spark, sf_dir), scratch_path(spark, "feed"), ["dt_ref"])


def _retyped(df, like):
    """Columns and types of `like`; text formats lose both."""
    return df.select(*[F.col(f.name).cast(f.dataType) for f in like.schema.fields])


@query(f"select * from {EVENTS} where dt_ref in (date '2024-01-03', date '2024-01-10', date '2024-01-28')")
def read_partition_list(spark, sf_dir):
    days = resolve_partitions(values="2024-01-03, 2024-01-10, 2024-01-28")
    return read_partitioned(spark, _events_feed(spark, sf_dir), "dt_ref", days)


@query(f"select * from {EVENTS} where dt_ref between date '2024-01-05' and date '2024-01-20'")
def read_partition_range(spark, sf_dir):
    days = resolve_partitions(between="2024-01-05,2024-01-20")
    return read_partitioned(spark, _events_feed(spark, sf_dir), "dt_ref", days)


@query(f"select * from {EVENTS} where dt_ref between date '2024-01-05' and date '2024-01-20'")
def read_selected_directories(spark, sf_dir):
    days = resolve_partitions(between="2024-01-05,2024-01-20")
    feed = _events_feed(spark, sf_dir)
    return read_partitioned(spark, feed, "dt_ref", days, list_selected_only=True)


@query(
    """select event_id, ts, user_id, event_type, value, props, strftime(ts, '%Y%m%d')::int as day
    from events where ts::date between date '2024-01-08' and date '2024-01-25'"""
)
def read_partition_format(spark, sf_dir):
    """Directories named 20240108: read back as integers, chosen with a date format."""
    feed = table(spark, sf_dir, "events").withColumn("day", F.date_format("ts", "yyyyMMdd"))
    path = write_partitioned(feed, scratch_path(spark, "feed"), ["day"])
    days = resolve_partitions(between=("20240108", "20240125"), fmt="%Y%m%d")
    return read_partitioned(spark, path, "day", days, partition_format="%Y%m%d")


@query(
    """select o_orderkey, o_custkey, o_totalprice, strftime(o_orderdate, '%Y-%m') as month
    from orders where o_orderdate >= date '1996-03-01' and o_orderdate < date '1998-03-01'"""
)
def read_partition_months(spark, sf_dir):
    """A coarse format: a range of days names each month once."""
    feed = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_totalprice", F.date_format("o_orderdate", "yyyy-MM").alias("month")
    )
    path = write_partitioned(feed, scratch_path(spark, "feed"), ["month"])
    months = resolve_partitions(between="1996-03,1998-02", fmt="%Y-%m")
    return read_partitioned(
        spark, path, "month", months, partition_format="%Y-%m",
        schema="o_orderkey long, o_custkey long, o_totalprice double, month string",
    )


@query(f"{ORDERS} where o_orderstatus in ('F', 'O')")
def read_json(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    path = write_partitioned(orders, scratch_path(spark, "feed"), ["o_orderstatus"], fmt="json")
    statuses = resolve_partitions(values="F,O")
    df = read_partitioned(spark, path, "o_orderstatus", statuses, fmt="json", infer_schema=True)
    return _retyped(df, orders)


@query(ORDERS)
def read_csv_header(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    path = write_partitioned(
        orders, scratch_path(spark, "feed"), ["o_orderpriority"], fmt="csv", options={"header": "true"}
    )
    df = read_partitioned(spark, path, "o_orderpriority", fmt="csv", infer_schema=True, csv_header=True)
    return _retyped(df, orders)


@query("select c_custkey as _c0, c_name as _c1, c_nationkey as _c2, c_mktsegment from customer")
def read_csv_plain(spark, sf_dir):
    """No header and no inference: text columns named by position."""
    rows = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    path = write_partitioned(rows, scratch_path(spark, "feed"), ["c_mktsegment"], fmt="csv")
    df = read_partitioned(spark, path, "c_mktsegment", fmt="csv")
    return df.select(F.col("_c0").cast("long"), "_c1", F.col("_c2").cast("int"), "c_mktsegment")


@query("select * from lineitem where l_linestatus = 'F'")
def read_orc(spark, sf_dir):
    """Any format Spark knows by name."""
    rows = table(spark, sf_dir, "lineitem")
    path = write_partitioned(rows, scratch_path(spark, "feed"), ["l_linestatus"], fmt="orc")
    return _retyped(read_partitioned(spark, path, "l_linestatus", ["F"], fmt="orc"), rows)


@query("select dt_ref, event_type, count(*)::bigint as n from (select ts::date as dt_ref, "
       "case when ts::date between date '2024-01-10' and date '2024-01-12' then 'rewritten' "
       "else event_type end as event_type from events) group by all")
def write_touched_partitions(spark, sf_dir):
    """A second write replaces three of the days and leaves the rest."""
    path = _events_feed(spark, sf_dir)
    again = events(spark, sf_dir).where("dt_ref between date '2024-01-10' and date '2024-01-12'")
    again = again.withColumn("event_type", F.lit("rewritten"))
    write_partitioned(again, path, ["dt_ref"], touched_only=True)
    return spark.read.parquet(path).groupBy("dt_ref", "event_type").agg(F.count("*").alias("n"))


@query("select event_type, dt_ref, count(*)::bigint as n, sum(event_id)::bigint as ids "
       f"from {EVENTS} group by all")
def write_partitioned_feed(spark, sf_dir):
    """Write by day, discover the partitions again, and add up what came back."""
    df = spark.read.parquet(_events_feed(spark, sf_dir))
    return df.groupBy("event_type", "dt_ref").agg(F.count("*").alias("n"), F.sum("event_id").alias("ids"))
