"""A day-partitioned change feed derived from the rows of any table."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from silverline.functions import change_records as rec
from silverline.functions.columns import col


def change_feed(
    df: DataFrame,
    id_col: str,
    day_col: str,
    entity: str,
    key_space: int,
    first_day: date | str,
    *,
    timestamp_type: str = "timestamp",
) -> DataFrame:
    """Project a row number and a day to one change record per row.

    Columns: `id_<entity>`, `dat_update` (midnight plus one hour per day since
    `first_day`), `ind_status`, `des_<entity>`, `flg_ativo`, `dat_kafka` (midnight
    plus the row number in seconds), `dt_ref`.
    """
    row_id, day = col(id_col), col(day_col).cast("date")
    version = F.datediff(day, F.lit(str(first_day)).cast("date"))
    key = rec.wrapped_key(row_id, key_space)
    return df.select(
        key.alias(f"id_{entity}"),
        rec.hours_after(day, version, timestamp_type).alias("dat_update"),
        rec.status(row_id).alias("ind_status"),
        rec.description(entity, key, version).alias(f"des_{entity}"),
        rec.parity_flag(row_id).alias("flg_ativo"),
        rec.seconds_after(day, row_id, timestamp_type).alias("dat_kafka"),
        day.alias("dt_ref"),
    )


def daily_versions(df: DataFrame, first_day: date | str, last_day: date | str, day_col: str = "dt_ref") -> DataFrame:
    """Every row of `df` once per day of the inclusive range.

    The days are generated next to each row, so the plan does not grow with their
    number and nothing is shuffled.
    """
    if str(last_day) < str(first_day):
        raise ValueError(f"range ends before it starts: {first_day} .. {last_day}")
    days = F.sequence(F.lit(str(first_day)).cast("date"), F.lit(str(last_day)).cast("date"))
    return df.withColumn(day_col, F.explode(days))


def union_days(frames: Sequence[DataFrame]) -> DataFrame:
    """All rows of all frames, columns matched by name."""
    if not frames:
        raise ValueError("nothing to union")
    return reduce(DataFrame.unionByName, frames)
