"""One schema for a feed whose days were written with different columns and types."""

from __future__ import annotations

from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import SparkSession
from pyspark.sql import types as T

from silverline.functions.columns import name_folder

#: Integral types by width.
LADDER = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
#: Decimal digits that hold every value of an integral type.
DIGITS = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 20}
#: Directories looked into at a time.
THREADS = 16


def evolving_schema(spark: SparkSession, base_uri: str, partition_col: str) -> T.StructType:
    """The columns of all `<partition_col>=<value>` directories below `base_uri`, in order of first appearance, in types that hold all values.

    The directories are listed once, and the driver reads the schema of one file of each. Scanned with this schema, a column that a file lacks is
    NULL and a narrower type is widened as it is read, so the days need no union: it stays one scan with its pruning. All columns may be
    NULL. Types that cannot be widened without loss are a ValueError that names column and types.
    """
    files = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(base_uri)
    store = files.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    mark = f"{partition_col}="
    found = [s.getPath() for s in store.listStatus(files) if s.isDirectory() and s.getPath().getName().startswith(mark)]
    if not found:
        raise ValueError(f"no directories {mark}... below {base_uri}")
    # day names sort by time; the latest day is not special otherwise
    paths = sorted(p.toUri().toString() for p in found)

    def columns(path: str) -> T.StructType:
        return spark.read.option("mergeSchema", "false").parquet(path).schema

    with ThreadPoolExecutor(THREADS) as pool:
        schemas = list(pool.map(columns, paths))
    return merge_schemas(spark, schemas)


def merge_schemas(spark: SparkSession, schemas: Iterable[T.StructType]) -> T.StructType:
    """All columns of the schemas, by name under the session's case rule, each in the narrowest type that holds those it has."""
    return _structs(list(schemas), name_folder(spark), "")


def _structs(schemas: list[T.StructType], fold, prefix: str) -> T.StructType:
    merged: dict[str, T.StructField] = {}
    for schema in schemas:
        for field in schema.fields:
            known = merged.get(fold(field.name))
            kind = field.dataType if known is None else wider(known.dataType, field.dataType, prefix + field.name, fold)
            named = known or field
            merged[fold(field.name)] = T.StructField(named.name, kind, True, named.metadata)
    return T.StructType(list(merged.values()))


def wider(a: T.DataType, b: T.DataType, name: str = "value", fold=str.lower) -> T.DataType:
    """The narrowest type that Parquet files of both types can be read as without loss."""
    if a == b:
        return a
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        return _structs([a, b], fold, f"{name}.")
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        return T.ArrayType(wider(a.elementType, b.elementType, f"{name}.element", fold), True)
    if isinstance(a, T.MapType) and isinstance(b, T.MapType):
        key = wider(a.keyType, b.keyType, f"{name}.key", fold)
        return T.MapType(key, wider(a.valueType, b.valueType, f"{name}.value", fold), True)
    for x, y in ((a, b), (b, a)):
        if isinstance(x, LADDER) and isinstance(y, LADDER) and LADDER.index(type(x)) < LADDER.index(type(y)):
            return y
        if isinstance(y, T.DoubleType) and (isinstance(x, T.FloatType) or (isinstance(x, LADDER) and not isinstance(x, T.LongType))):
            return y
        if isinstance(y, T.TimestampNTZType) and isinstance(x, T.DateType):
            return y
    whole = [_digits(x) for x in (a, b)]
    if None not in whole and any(isinstance(x, T.DecimalType) for x in (a, b)):
        before, after = (max(x[i] for x in whole) for i in (0, 1))
        if before + after <= 38:
            return T.DecimalType(before + after, after)
    raise ValueError(f"column {name}: {a.simpleString()} and {b.simpleString()} have no common type")


def _digits(kind: T.DataType) -> tuple[int, int] | None:
    if isinstance(kind, T.DecimalType):
        return kind.precision - kind.scale, kind.scale
    return (DIGITS[type(kind)], 0) if type(kind) in DIGITS else None
