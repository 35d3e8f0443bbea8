"""Columns added to and dropped from a table that holds rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from registry.base import events, events_latest, events_latest_sql, merged_sql, new_table, query

WHOLE = events_latest_sql()
FIRST_HALF = events_latest_sql(last=15)
LATER = events_latest_sql(first=14)


def _filled(spark, sf_dir, last=None):
    silver = new_table(spark, "silver").ensure(events(spark, sf_dir), "user_id")
    silver.merge(events_latest(spark, sf_dir, last=last), source_unique=True)
    return silver


@query(f"select *, cast(null as decimal(10,2)) as score from {WHOLE}")
def schema_add_column(spark, sf_dir):
    silver = _filled(spark, sf_dir)
    silver.add_column("score", "decimal(10,2)", "added later")
    return silver.current()


@query(
    "select * from "
    + merged_sql(
        f"(select *, null::double as score from {FIRST_HALF})", f"(select *, value * 2 as score from {LATER})"
    )
)
def schema_add_then_merge(spark, sf_dir):
    """Old rows read NULL, merged rows carry the new column."""
    silver = _filled(spark, sf_dir, last=15)
    silver.add_column("score", "double")
    later = events_latest(spark, sf_dir, first=14)
    silver.merge(later.withColumn("score", F.col("value") * 2), source_unique=True)
    return silver.current()


@query(f"select * exclude (props) from {WHOLE}")
def schema_drop_column(spark, sf_dir):
    silver = _filled(spark, sf_dir)
    silver.drop_column("props")
    return silver.current()


@query(f"select * replace (null as props) from {WHOLE}")
def schema_drop_readd(spark, sf_dir):
    """The old values stay gone."""
    silver = _filled(spark, sf_dir)
    silver.drop_column("props")
    silver.add_column("props", "string")
    return silver.current()


@query("select * from " + merged_sql(f"(select * replace (null as props) from {FIRST_HALF})", LATER))
def schema_drop_readd_merge(spark, sf_dir):
    silver = _filled(spark, sf_dir, last=15)
    silver.drop_column("props")
    silver.add_column("props", "string")
    silver.merge(events_latest(spark, sf_dir, first=14), source_unique=True)
    return silver.current()


@query(f"select * from {FIRST_HALF}")
def schema_time_travel(spark, sf_dir):
    """An old snapshot reads with the columns it had."""
    silver = _filled(spark, sf_dir, last=15)
    silver.drop_column("props")
    silver.add_column("score", "int")
    silver.merge(events_latest(spark, sf_dir, first=14), fill_missing=True, source_unique=True)
    return silver.as_of(2)


@query(
    """select * from (values ('event_id', 'bigint', null), ('ts', 'timestamp_ntz', null), ('user_id', 'bigint', null),
    ('event_type', 'string', null), ('value', 'double', null), ('dt_ref', 'date', null),
    ('score', 'decimal(10,2)', 'it''s new')) t(col_name, data_type, comment)"""
)
def schema_describe(spark, sf_dir):
    silver = _filled(spark, sf_dir)
    silver.add_column("score", "decimal(10,2)", "it's new")
    silver.drop_column("props")
    return silver.describe()
