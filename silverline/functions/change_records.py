"""Expressions that turn a row number and a day into a change record."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the record format.
STATUS_BY_REMAINDER = {0: "A", 1: "I"}
STATUS_OTHERWISE = "P"
FLAG_EVEN, FLAG_ODD = "Y", "N"
VERSION_MARK = "_v"


def wrapped_key(row_id: Column, key_space: int) -> Column:
    """Row number folded into `key_space` keys, as text."""
    return (row_id % F.lit(key_space)).cast("string")


def status(row_id: Column) -> Column:
    """One of three states, by the row number's remainder."""
    expr = F
    for remainder, code in STATUS_BY_REMAINDER.items():
        expr = expr.when(row_id % 3 == remainder, F.lit(code))
    return expr.otherwise(F.lit(STATUS_OTHERWISE))


def parity_flag(row_id: Column) -> Column:
    return F.when(row_id % 2 == 0, F.lit(FLAG_EVEN)).otherwise(F.lit(FLAG_ODD))


def description(prefix: str, key: Column, version: Column) -> Column:
    """`<prefix>_<key>_v<version>`."""
    return F.concat(F.lit(f"{prefix}_"), key, F.lit(VERSION_MARK), version.cast("string"))


def hours_after(day: Column, hours: Column, as_type: str = "timestamp") -> Column:
    """Midnight of `day` plus whole hours."""
    return day.cast("date").cast(as_type) + F.make_dt_interval(hours=hours.cast("int"))


def seconds_after(day: Column, seconds: Column, as_type: str = "timestamp") -> Column:
    """Midnight of `day` plus seconds; works for zoned and zoneless timestamps."""
    return day.cast("date").cast(as_type) + F.make_dt_interval(secs=seconds.cast("decimal(18,6)"))
