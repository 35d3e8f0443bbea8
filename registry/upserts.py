"""Merge semantics on DataFrames."""

from __future__ import annotations

from pyspark.sql import functions as F

from registry.base import events_latest, events_latest_sql, merged_sql, query, table
from registry.dedup import LINE_KEY, LINE_TIES, NULL_KEYED, null_keyed
from silverline.operators import latest_per_key, upsert, upsert_summary
from silverline.session import materialise

FIRST_HALF = events_latest_sql(last=15)
LATER = events_latest_sql(first=20)
LATE = events_latest_sql(first=20, last=19)


@query(f"select * from {merged_sql(FIRST_HALF, LATER)}")
def upsert_forward(spark, sf_dir):
    target = events_latest(spark, sf_dir, last=15)
    source = events_latest(spark, sf_dir, first=20)
    return upsert(target, source, "user_id", source_unique=True)


@query(f"select * from {merged_sql(FIRST_HALF, LATER)}")
def upsert_forward_anti_join(spark, sf_dir):
    """The other strategy, on a stored source."""
    target = events_latest(spark, sf_dir, last=15)
    source = materialise(events_latest(spark, sf_dir, first=20), "source")
    return upsert(target, source, "user_id", source_unique=True, strategy="anti_join")


@query(f"select * from {merged_sql(FIRST_HALF, LATER)}")
def upsert_forward_full_outer(spark, sf_dir):
    """The same merge as a full outer join."""
    target = events_latest(spark, sf_dir, last=15)
    source = events_latest(spark, sf_dir, first=20)
    return upsert(target, source, "user_id", source_unique=True, strategy="full_outer")


@query(f"select * from {merged_sql(FIRST_HALF, LATER)}")
def upsert_checked(spark, sf_dir):
    """As above, with the plan itself checking that source keys are unique."""
    target = events_latest(spark, sf_dir, last=15)
    source = events_latest(spark, sf_dir, first=20)
    return upsert(target, source, "user_id")


@query(f"select * from {merged_sql(events_latest_sql(), LATE)}")
def upsert_late_overwrites(spark, sf_dir):
    """Merging an old range again puts its older rows back."""
    source = events_latest(spark, sf_dir, first=20, last=19)
    return upsert(events_latest(spark, sf_dir), source, "user_id", source_unique=True)


@query(
    f"""select * from (select * from {FIRST_HALF} union all select * from {LATER})
    qualify row_number() over (partition by user_id order by ts desc, event_id desc) = 1"""
)
def upsert_guarded(spark, sf_dir):
    """The same merge with a guard: older rows are refused."""
    target = events_latest(spark, sf_dir, last=15)
    source = events_latest(spark, sf_dir, first=20)
    return upsert(target, source, "user_id", guard="ts", source_unique=True)


def _null_keyed_sql(condition):
    return f"""(select * from {NULL_KEYED} where {condition}
        qualify row_number() over (partition by k order by ts desc nulls last, event_id desc) = 1)"""


@query(f"select * from {merged_sql(_null_keyed_sql('true'), _null_keyed_sql('value > 50'), 'k')}")
def upsert_null_key(spark, sf_dir):
    df = null_keyed(spark, sf_dir)
    target = latest_per_key(df, "k", "ts", tiebreak="event_id")
    source = latest_per_key(df.where("value > 50"), "k", "ts", tiebreak="event_id")
    return upsert(target, source, "k", source_unique=True)


LINES = f"""(select * from lineitem where {{}} qualify row_number() over (
    partition by {", ".join(LINE_KEY)}
    order by l_shipdate desc, {", ".join(c + " desc" for c in LINE_TIES)}) = 1)"""
LINES_BEFORE, LINES_SINCE = (LINES.format(f"l_shipdate {op} timestamp '1999-01-01'") for op in ("<", ">="))


@query(
    f"""select t.* from {LINES_BEFORE} t where not exists (select 1 from {LINES_SINCE} s
    where s.l_orderkey is not distinct from t.l_orderkey and s.l_linenumber is not distinct from t.l_linenumber)
    union all select * from {LINES_SINCE}"""
)
def upsert_composite_key(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    before = lines.where("l_shipdate < timestamp_ntz '1999-01-01 00:00:00'")
    since = lines.where("l_shipdate >= timestamp_ntz '1999-01-01 00:00:00'")
    target = latest_per_key(before, LINE_KEY, "l_shipdate", tiebreak=LINE_TIES)
    source = latest_per_key(since, LINE_KEY, "l_shipdate", tiebreak=LINE_TIES)
    return upsert(target, source, LINE_KEY, source_unique=True)


@query(
    "select * from "
    + merged_sql(FIRST_HALF, f"(select * replace (null as props) from {LATER})")
)
def upsert_by_name(spark, sf_dir):
    """Other column order, one column too many, one missing."""
    target = events_latest(spark, sf_dir, last=15)
    source = events_latest(spark, sf_dir, first=20).select(
        "value", "dt_ref", "event_type", "user_id", "ts", "event_id", F.lit(1).alias("unknown")
    )
    return upsert(target, source, "user_id", fill_missing=True, source_unique=True)


@query(
    f"""select count(*) filter (where t.m is null) as inserted, count(*) filter (where t.m = 1 and s.m = 1) as updated,
    count(*) filter (where s.m is null) as kept
    from (select o_custkey as k, 1 as m from orders where o_orderdate < timestamp '1998-01-01' group by all) t
    full join (select o_custkey as k, 1 as m from orders where o_orderdate >= timestamp '1998-01-01' group by all) s
    on t.k is not distinct from s.k"""
)
def upsert_counts(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    before = orders.where("o_orderdate < timestamp_ntz '1998-01-01 00:00:00'")
    since = orders.where("o_orderdate >= timestamp_ntz '1998-01-01 00:00:00'")
    target = latest_per_key(before, "o_custkey", "o_orderdate", tiebreak="o_orderkey")
    source = latest_per_key(since, "o_custkey", "o_orderdate", tiebreak="o_orderkey")
    return upsert_summary(target, source, "o_custkey")
