"""Partitioned write of a feed."""

from __future__ import annotations

import re
import threading
from collections.abc import Iterator, Sequence
from contextlib import contextmanager, nullcontext

from pyspark.sql import DataFrame, SparkSession

from silverline.functions.columns import resolve

#: Shuffled bytes that a task of a rebalanced write sorts, about, and the setting that says so.
TASK_BYTES, ADVISED = 32 << 20, "spark.sql.adaptive.advisoryPartitionSizeInBytes"

_lock = threading.Lock()
# sessions with open writes: how many, and the size to go back to
_open: dict[SparkSession, tuple[int, str]] = {}


def _as_bytes(size: str) -> int:
    number, unit = re.fullmatch(r"(\d+)\s*([bkmgtp]?)i?b?", size.strip().lower()).groups()
    return int(number) << (10 * "bkmgtp".index(unit or "b"))


@contextmanager
def _small_tasks(spark: SparkSession) -> Iterator[None]:
    """While open, adaptive execution aims at tasks of TASK_BYTES, or less if the session says so. Writes of several threads may overlap."""
    with _lock:
        n, before = _open.get(spark) or (0, spark.conf.get(ADVISED))
        _open[spark] = n + 1, before
        if _as_bytes(before) > TASK_BYTES:
            spark.conf.set(ADVISED, str(TASK_BYTES))
    try:
        yield
    finally:
        with _lock:
            n, before = _open.pop(spark)
            if n > 1:
                _open[spark] = n - 1, before
            else:
                spark.conf.set(ADVISED, before)


def write_partitioned(
    df: DataFrame,
    path: str,
    partition_cols: Sequence[str],
    *,
    fmt: str = "parquet",
    mode: str = "overwrite",
    touched_only: bool = False,
    rebalance: bool = True,
    options: dict[str, str] | None = None,
) -> str:
    """Write `df` below `path` in one directory per partition value; returns `path`.

    `mode="overwrite"` replaces the whole path; with `touched_only` it replaces only
    the partitions present in `df`. `rebalance` gathers each partition value into
    few files and lets adaptive execution split values that are too large for one
    task, so a day holding a third of the rows is still written in parallel. A task sorts
    its rows by partition value before it writes them; TASK_BYTES bounds what it holds. Turn
    it off when every task already holds a single value.
    """
    names = resolve(df.sparkSession, df.columns, partition_cols, "partition columns")
    if rebalance:
        df = df.hint("rebalance", *names)
    writer = df.write.format(fmt).mode(mode).options(**(options or {})).partitionBy(*names)
    writer = writer.option("partitionOverwriteMode", "dynamic" if touched_only else "static")
    with _small_tasks(df.sparkSession) if rebalance else nullcontext():
        writer.save(path)
    return path
