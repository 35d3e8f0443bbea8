"""Change feeds derived from the test tables."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import functions as F

from registry.base import query, table
from silverline import plans
from silverline.operators import change_feed, daily_versions, union_days
from silverline.session import scratch_path

KEY_SPACE = 500


def records_sql(rows: str, row_id: str, entity: str, first_day: str, space: int = KEY_SPACE) -> str:
    """Change records of a relation with columns `row_id` and `day`."""
    return f"""select ({row_id} % {space})::varchar as id_{entity},
    day::timestamp + to_hours(day - date '{first_day}') as dat_update,
    case {row_id} % 3 when 0 then 'A' when 1 then 'I' else 'P' end as ind_status,
    '{entity}_' || ({row_id} % {space})::varchar || '_v' || (day - date '{first_day}')::varchar as des_{entity},
    case when {row_id} % 2 = 0 then 'Y' else 'N' end as flg_ativo,
    day::timestamp + to_seconds({row_id}) as dat_kafka,
    day as dt_ref from {rows}"""


def days_sql(table_name: str, first: str, last: str) -> str:
    return f"""(select t.*, d::date as day from {table_name} t,
    generate_series(timestamp '{first}', timestamp '{last}', interval 1 day) g(d))"""


@query(records_sql("(select *, o_orderdate::date as day from orders)", "o_orderkey", "purchase", "1995-01-01"))
def feed_records(spark, sf_dir):
    return change_feed(
        table(spark, sf_dir, "orders"), "o_orderkey", "o_orderdate", "purchase", KEY_SPACE, "1995-01-01",
        timestamp_type="timestamp_ntz",
    )


@query(records_sql(days_sql("customer", "2026-01-01", "2026-01-20"), "c_custkey", "customer", "2026-01-01"))
def feed_daily_versions(spark, sf_dir):
    """Every customer changes on each of twenty days; the days are generated."""
    days = daily_versions(table(spark, sf_dir, "customer"), "2026-01-01", "2026-01-20")
    return change_feed(
        days, "c_custkey", "dt_ref", "customer", KEY_SPACE, "2026-01-01", timestamp_type="timestamp_ntz"
    )


@query(records_sql(days_sql("part", "2026-01-01", "2026-01-05"), "p_partkey", "product", "2026-01-01"))
def feed_union_days(spark, sf_dir):
    """One frame per day, put together by name."""
    rows, start = table(spark, sf_dir, "part").select("p_partkey"), date(2026, 1, 1)
    frames = [
        change_feed(
            rows.withColumn("day", F.lit(start + timedelta(days=n))), "p_partkey", "day", "product",
            KEY_SPACE, start, timestamp_type="timestamp_ntz",
        )
        for n in range(5)
    ]
    return union_days(frames)


@query(
    """select entity, dt_ref, count(*)::bigint as n, count(distinct key)::bigint as keys, sum(on_flag)::bigint as active
    from (select 'customer' as entity, c_custkey % 300 as key, (c_custkey % 2 = 0)::int as on_flag, c_custkey from customer
    union all select 'invoice', s_suppkey % 300, (s_suppkey % 2 = 0)::int, s_suppkey from supplier),
    (select d::date as dt_ref from generate_series(timestamp '2026-01-01', timestamp '2026-01-20', interval 1 day) g(d))
    group by all"""
)
def feed_entities(spark, sf_dir):
    """Two entities written through one function, each read back from its own path."""
    entities = {
        "customer": (table(spark, sf_dir, "customer"), "c_custkey"),
        "invoice": (table(spark, sf_dir, "supplier"), "s_suppkey"),
    }
    root = scratch_path(spark, "bronze")
    paths = plans.write_entities(entities, root, "sales", "2026-01-01", "2026-01-20", 300)
    sums = [
        spark.read.parquet(path)
        .groupBy(F.lit(name).alias("entity"), "dt_ref")
        .agg(
            F.count("*").alias("n"),
            F.count_distinct(f"id_{name}").alias("keys"),
            F.count_if(F.col("flg_ativo") == "Y").alias("active"),
        )
        for name, path in paths.items()
    ]
    return union_days(sums)
