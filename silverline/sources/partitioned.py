"""Batch scan of a feed laid out in `<column>=<value>` directories."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime, timedelta

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from silverline.functions.columns import col, resolve
from silverline.sources.evolving import evolving_schema
from silverline.sources.partitions import ISO_DAY

#: Partition values of a table that are sent to every task.
MOST_BROADCAST = 100_000


def read_partitioned(
    spark: SparkSession,
    base_uri: str,
    partition_col: str | None = None,
    partitions: Sequence[str] | DataFrame | None = None,
    *,
    fmt: str = "parquet",
    partition_format: str = ISO_DAY,
    infer_schema: bool = False,
    csv_header: bool = False,
    schema: T.StructType | str | None = None,
    options: Mapping[str, str] | None = None,
    list_selected_only: bool = False,
    evolving: bool = False,
) -> DataFrame:
    """Load a feed and keep the chosen partitions.

    The filter uses literals of the partition column's own type, so it prunes
    directories before any file is opened. `partitions=None` reads everything; an
    empty list is an error rather than a silent full read. Pass `schema` for JSON
    and CSV at scale: without it Spark reads the files once more to infer one.

    `list_selected_only` lists just the named directories instead of the whole
    feed. Use it when directories are spelled exactly like the values.

    `partitions` may be a DataFrame, whose first column holds the values: the feed is then pruned by that table while the query
    runs, however many values there are. They are NULL or of a type that casts to the partition column's; `partition_format` has no meaning.

    `evolving` reads Parquet days of different columns in one scan: see `evolving_schema`.
    """
    if isinstance(partitions, DataFrame):
        whole = read_partitioned(
            spark, base_uri, partition_col, fmt=fmt, infer_schema=infer_schema, csv_header=csv_header, schema=schema,
            options=options, evolving=evolving,
        )
        return _chosen_by_table(whole, partition_col, partitions)
    if evolving:
        if fmt != "parquet" or schema is not None or partition_col is None:
            raise ValueError("only Parquet feeds with a partition column and without a given schema evolve")
        schema = evolving_schema(spark, base_uri, partition_col)
    reading = {"header": csv_header, "inferSchema": infer_schema} if fmt == "csv" else {}
    reading |= options or {}

    if partitions is not None and not partitions:
        raise ValueError("the list of partitions is empty; pass None to read the whole feed")
    if partitions is not None and partition_col is None:
        raise ValueError("partitions need the column they are values of")
    filtering = partition_col is not None and partitions is not None
    df = None
    # values that a path pattern would read as something else are left to the filter
    if filtering and list_selected_only and not any(set(v) & set("{},*?[]\\") for v in partitions):
        path = f"{base_uri.rstrip('/')}/{partition_col}={{{','.join(partitions)}}}"
        try:
            df = spark.read.format(fmt).options(**reading).option("basePath", base_uri).load(path, schema=schema)
        except AnalysisException as error:
            # none of the directories is there: the whole feed tells the columns, the filter leaves no row
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
    if df is None:
        df = spark.read.format(fmt).options(**reading).load(base_uri, schema=schema)
    if not filtering:
        return df
    name = resolve(spark, df.columns, [partition_col], "partition column")[0]
    return df.where(partition_filter(df.schema[name], partitions, partition_format))


def _chosen_by_table(df: DataFrame, partition_col: str | None, values: DataFrame) -> DataFrame:
    """Rows of the partitions that a table names.

    Bounds of the values prune as literals; the values themselves as a subquery of the scan, where their number allows a broadcast.
    """
    if partition_col is None:
        raise ValueError("partitions need the column they are values of")
    name = resolve(df.sparkSession, df.columns, [partition_col], "partition column")[0]
    wanted = values.select(col(values.columns[0]).cast(df.schema[name].dataType).alias(name)).where(col(name).isNotNull()).distinct()
    low, high, n = wanted.agg(F.min(name), F.max(name), F.count(F.lit(1))).first()
    if not n:
        raise ValueError("the table of partitions is empty; pass None to read the whole feed")
    within = col(name).between(F.lit(low), F.lit(high))
    wanted = wanted.where(within)
    if n <= MOST_BROADCAST:
        wanted = F.broadcast(wanted)  # its rows have just been counted
    return df.where(within).join(wanted, on=[name], how="left_semi").select(*[col(c) for c in df.columns])


def partition_filter(field: T.StructField, values: Sequence[str], fmt: str = ISO_DAY) -> Column:
    """`column IN values` with the values parsed to the column's type.

    Unbroken runs of days become one BETWEEN, so a range of years stays a small
    expression.
    """
    column, dtype = col(field.name), field.dataType
    if isinstance(dtype, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        stamps = sorted({datetime.strptime(v, fmt) for v in values})
        if isinstance(dtype, T.DateType):
            days = [s.date() for s in stamps]
            if len(days) > 2 and days[-1] - days[0] == timedelta(days=len(days) - 1):
                return column.between(F.lit(days[0]), F.lit(days[-1]))
            return column.isin(days)
        return column.isin([F.lit(s.isoformat(sep=" ")).cast(dtype) for s in stamps])
    if isinstance(dtype, T.IntegralType):
        return column.isin([int(v) for v in values])
    if isinstance(dtype, T.StringType):
        return column.isin(list(values))
    return column.isin([F.lit(v).cast(dtype) for v in values])
