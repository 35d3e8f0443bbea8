"""Checks of a current-state table against its feed.

Bronze is the latest order per customer group. Silver is the same state as of an
earlier day, so some keys are missing and some values differ. One group's key is
NULL, and silver lost the priority of urgent orders.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from registry.base import query, table
from silverline.operators import (
    column_diffs,
    counts,
    key_coverage,
    latest_per_key,
    missing_keys,
    report,
)
from silverline.session import materialise

KEYED = """(select case when o_custkey % 1000 <> 0 then o_custkey end as k, o_orderkey, o_orderdate,
    o_totalprice, o_orderstatus, o_orderpriority from orders)"""
LATEST = "qualify row_number() over (partition by k order by o_orderdate desc, o_orderkey desc) = 1"
BRONZE = f"(select * from {KEYED} {LATEST})"
SILVER = f"""(select * replace (nullif(o_orderpriority, '1-URGENT') as o_orderpriority)
    from (select * from {KEYED} where o_orderdate < timestamp '2000-06-01' {LATEST}))"""
COMPARED = ["o_orderkey", "o_totalprice", "o_orderstatus", "o_orderpriority"]


def _keyed(spark, sf_dir):
    key = F.when(F.col("o_custkey") % 1000 != 0, F.col("o_custkey"))
    return table(spark, sf_dir, "orders").select(
        key.alias("k"), "o_orderkey", "o_orderdate", "o_totalprice", "o_orderstatus", "o_orderpriority"
    )


def _bronze(spark, sf_dir):
    return latest_per_key(_keyed(spark, sf_dir), "k", "o_orderdate", tiebreak="o_orderkey")


def _silver(spark, sf_dir):
    earlier = _keyed(spark, sf_dir).where("o_orderdate < timestamp_ntz '2000-06-01 00:00:00'")
    state = latest_per_key(earlier, "k", "o_orderdate", tiebreak="o_orderkey")
    return state.withColumn("o_orderpriority", F.nullif("o_orderpriority", F.lit("1-URGENT")))


def _stored(spark, sf_dir):
    return materialise(_bronze(spark, sf_dir), "bronze"), materialise(_silver(spark, sf_dir), "silver")


def _missing(condition):
    return f"select k from {BRONZE} b where not exists (select 1 from {SILVER} s where {condition}) group by k"


PLAIN, NULL_SAFE = "s.k = b.k", "s.k is not distinct from b.k"


@query(f"select (select count(*) from {BRONZE}) as bronze_count, (select count(*) from {SILVER}) as silver_count")
def reconcile_counts(spark, sf_dir):
    return counts(_bronze(spark, sf_dir), _silver(spark, sf_dir))


@query(_missing(PLAIN))
def reconcile_missing_keys(spark, sf_dir):
    return missing_keys(_bronze(spark, sf_dir), _silver(spark, sf_dir), "k")


@query(_missing(NULL_SAFE))
def reconcile_missing_keys_null_safe(spark, sf_dir):
    return missing_keys(_bronze(spark, sf_dir), _silver(spark, sf_dir), "k", null_safe=True)


@query(f"select count(*) as missing_keys from ({_missing(PLAIN)})")
def reconcile_key_coverage(spark, sf_dir):
    return key_coverage(_bronze(spark, sf_dir), _silver(spark, sf_dir), "k")


def _diffs(on, test):
    sums = ", ".join(
        f"coalesce(sum(case when {test.format(c=c)} then 1 else 0 end), 0)::bigint as {c}" for c in COMPARED
    )
    return f"select {sums} from {BRONZE} b join {SILVER} s on {on}"


PLAIN_DIFFS = _diffs(PLAIN, "b.{c} <> s.{c}")
NULL_SAFE_DIFFS = _diffs(NULL_SAFE, "b.{c} is distinct from s.{c}")


@query(PLAIN_DIFFS)
def reconcile_column_diffs(spark, sf_dir):
    """Default columns: shared, not key, not the date the feed is partitioned by."""
    return column_diffs(_bronze(spark, sf_dir), _silver(spark, sf_dir), "k", exclude=["o_orderdate"])


@query(NULL_SAFE_DIFFS)
def reconcile_column_diffs_null_safe(spark, sf_dir):
    bronze, silver = _bronze(spark, sf_dir), _silver(spark, sf_dir)
    return column_diffs(bronze, silver, "k", ",".join(COMPARED), null_safe=True)


def _report(missing, diffs):
    return f"""select *, violations = 0 as passed from (
    select 'counts' as "check", 'rows' as item, b as bronze_rows, s as silver_rows, abs(b - s) as violations
    from (select (select count(*) from {BRONZE}) as b, (select count(*) from {SILVER}) as s)
    union all select 'key_coverage', 'missing', null, null, (select count(*) from ({missing}))
    union all select 'column_values', item, null, null, violations
    from (unpivot ({diffs}) on {", ".join(COMPARED)} into name item value violations))"""


@query(_report(_missing(PLAIN), PLAIN_DIFFS))
def reconcile_report(spark, sf_dir):
    """Both sides stored, as the checks read them twice."""
    bronze, silver = _stored(spark, sf_dir)
    return report(bronze, silver, "k", exclude=["o_orderdate"])


@query(_report(_missing(NULL_SAFE), NULL_SAFE_DIFFS))
def reconcile_report_null_safe(spark, sf_dir):
    bronze, silver = _stored(spark, sf_dir)
    return report(bronze, silver, "k", exclude=["o_orderdate"], null_safe=True)


@query(_report(_missing(PLAIN), PLAIN_DIFFS))
def reconcile_report_single_join(spark, sf_dir):
    """Silver holds every key once, so one full outer join answers everything."""
    bronze, silver = _bronze(spark, sf_dir), _silver(spark, sf_dir)
    return report(bronze, silver, "k", exclude=["o_orderdate"], silver_unique=True)


@query(_report(_missing(NULL_SAFE), NULL_SAFE_DIFFS))
def reconcile_report_single_join_null_safe(spark, sf_dir):
    bronze, silver = _bronze(spark, sf_dir), _silver(spark, sf_dir)
    return report(bronze, silver, "k", exclude=["o_orderdate"], null_safe=True, silver_unique=True)


@query(
    f"""select 'schema' as "check", unnest(['o_orderstatus', 'remark']) as item, 1::bigint as violations, false as passed
    union all select 'counts', 'rows', abs(b - s)::bigint, b = s
    from (select (select count(*) from {BRONZE}) as b, (select count(*) from {SILVER}) as s)"""
)
def reconcile_schema_differences(spark, sf_dir):
    """Columns that one side lacks fail by name, next to the counts."""
    bronze, silver = _stored(spark, sf_dir)
    silver = silver.drop("o_orderstatus").withColumn("remark", F.lit("only here"))
    found = report(bronze, silver, "k").where("check in ('schema', 'counts')")
    return found.select("check", "item", "violations", "passed")
