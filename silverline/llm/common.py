"""Helpers that several operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from silverline.session import scratch_path

__all__ = ["LAST_ID", "SPACES", "WORD", "materialise", "partitions", "running_total", "table", "words"]

#: Bytes that separate words.
SPACES = " \t\n\u000b\f\r"
#: A word, as a regular expression.
WORD = r"[^\x20\x09-\x0D]+"
#: Stands for a missing document id, which ranks after every other.
LAST_ID = 2**63 - 1


def materialise(df: DataFrame, label: str, **options: str) -> DataFrame:
    """Evaluate `df` once into Parquet in the shared folder and return a scan of it: what later steps read again
    after an executor is lost."""
    path = scratch_path(df.sparkSession, label)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words(text: Column) -> Column:
    """Words of a text in order; a null or empty text has none."""
    pieces = F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+")
    return F.array_remove(pieces, "")


def partitions(df: DataFrame, rows: int, rows_per_task: int) -> int:
    """At least the session's shuffle partitions, more where tasks would get too many rows."""
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(least, -(-rows // rows_per_task))


def running_total(
    df: DataFrame,
    group: list[str],
    order: list[str],
    value: str,
    name: str,
    *,
    rows_per_task: int = 200_000,
) -> DataFrame:
    """Add `name`: the sum of `value` over the rows of the same group that come before a row.

    `df` should be cheap to read twice, for example a stored table, and must not have columns
    `_range`, `_before` or `name`. A group of any size spreads over many tasks: rows are dealt out by
    ranges of (group, order), and each range starts at the sum of the ranges before it. Rows that agree
    in group and order share a task, so `order` should end in something near unique. Null groups
    count as one group.
    """
    parts = partitions(df, df.count(), rows_per_task)
    dealt = df.repartitionByRange(parts, *group, *order).withColumn("_range", F.spark_partition_id())
    dealt = materialise(dealt, "ranges")
    keys = [f"_group{i}" for i in range(len(group))]
    sums = dealt.groupBy(
        *(F.col(c).alias(k) for c, k in zip(group, keys)), F.col("_range").alias("_r")
    ).agg(F.sum(value).alias("_sum"))
    ahead = Window.partitionBy(*keys).orderBy("_r").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(*keys, "_r", F.coalesce(F.sum("_sum").over(ahead), F.lit(0)).alias("_before"))
    same = F.col("_range") == F.col("_r")
    for c, k in zip(group, keys):
        same &= F.col(c).eqNullSafe(F.col(k))
    within = (
        Window.partitionBy("_range", *group).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    )
    return (
        dealt.join(sums, same)
        .withColumn(name, F.col("_before") + F.coalesce(F.sum(value).over(within), F.lit(0)))
        .drop("_range", "_r", "_before", *keys)
    )
