"""Registration and the shared inputs, in Spark and in SQL."""

from __future__ import annotations

from collections.abc import Callable
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from silverline.operators import latest_per_key
from silverline.session import scratch_path
from silverline.tables import SnapshotTable

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str):
    """Register a function under its own name together with its SQL."""

    def register(fn):
        QUERIES[fn.__name__] = fn
        SQL[fn.__name__] = " ".join(sql.split())
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events table as a daily change feed."""
    return table(spark, sf_dir, "events").withColumn("dt_ref", F.to_date("ts"))


EVENTS = "(select *, ts::date as dt_ref from events)"


def last_day(spark, sf_dir):
    """The latest day of the events, which query inputs are cut by."""
    return events(spark, sf_dir).agg(F.max("dt_ref")).first()[0]


def events_latest(spark, sf_dir, first: int | None = None, last: int | None = None) -> DataFrame:
    """Latest event per user over an inclusive range of days, counted back from the last day."""
    df = events(spark, sf_dir)
    if first is not None:
        df = df.where(F.col("dt_ref") >= F.lit(last_day(spark, sf_dir) - timedelta(days=first)))
    if last is not None:
        df = df.where(F.col("dt_ref") <= F.lit(last_day(spark, sf_dir) - timedelta(days=last)))
    return latest_per_key(df, "user_id", "ts", tiebreak="event_id")


def events_latest_sql(first: int | str | None = None, last: int | str | None = None) -> str:
    """The same in SQL; a text is a day itself."""

    def day(value) -> str:
        return f"date '{value}'" if isinstance(value, str) else f"(select max(ts)::date - {value} from events)"

    low = "true" if first is None else f"dt_ref >= {day(first)}"
    high = "true" if last is None else f"dt_ref <= {day(last)}"
    return f"""(select * from {EVENTS} where {low} and {high}
        qualify row_number() over (partition by user_id order by ts desc nulls last, event_id desc) = 1)"""


def merged_sql(target: str, source: str, key: str = "user_id") -> str:
    """The target relation after merging the source relation."""
    return f"""(select t.* from {target} t where not exists (
        select 1 from {source} s where s.{key} is not distinct from t.{key})
        union all by name select s.* from {source} s)"""


def new_table(spark: SparkSession, label: str) -> SnapshotTable:
    return SnapshotTable(spark, scratch_path(spark, label))
