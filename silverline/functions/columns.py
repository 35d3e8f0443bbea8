"""Names, keys and null-safe comparisons as Column expressions."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def col(name: str, relation: str | None = None) -> Column:
    """Reference a top-level column by its literal name, dots and quotes included."""
    quoted = "`" + name.replace("`", "``") + "`"
    return F.col(f"{relation}.{quoted}" if relation else quoted)


def cols(names: Iterable[str], relation: str | None = None) -> list[Column]:
    return [col(n, relation) for n in names]


def split_names(text: str | Sequence[str] | None) -> list[str]:
    """Names from a comma-separated text or a list, blanks removed."""
    parts = text.split(",") if isinstance(text, str) else (text or [])
    return [p.strip() for p in parts if p and p.strip()]


def name_folder(spark: SparkSession):
    """How this session compares column names: as written, or in lower case."""
    exact = spark.conf.get("spark.sql.caseSensitive", "false") == "true"
    return (lambda name: name) if exact else str.lower


def resolve(spark: SparkSession, available: Sequence[str], wanted: Iterable[str], what: str) -> list[str]:
    """Spell `wanted` as in `available`, following the session's case rule.

    Raises ValueError naming every column that does not exist.
    """
    fold = name_folder(spark)
    known = {fold(a): a for a in available}
    wanted = list(wanted)
    missing = [w for w in wanted if fold(w) not in known]
    if missing:
        raise ValueError(f"{what} not found: {missing}; available: {list(available)}")
    return [known[fold(w)] for w in wanted]


def require_keys(df: DataFrame, keys: str | Sequence[str]) -> list[str]:
    """Validated key columns of `df`."""
    names = split_names(keys)
    if not names:
        raise ValueError("at least one key column is required")
    names = resolve(df.sparkSession, df.columns, names, "key columns")
    maps = [n for n in names if contains_map(df.schema[n].dataType)]
    if maps:
        raise ValueError(f"map columns cannot be keys: {maps}")
    return names


def contains_map(dtype: T.DataType) -> bool:
    if isinstance(dtype, T.MapType):
        return True
    if isinstance(dtype, T.ArrayType):
        return contains_map(dtype.elementType)
    if isinstance(dtype, T.StructType):
        return any(contains_map(f.dataType) for f in dtype.fields)
    return False


def comparable(value: Column, dtype: T.DataType) -> Column:
    """`value` with every map in it, at any depth, as its entries sorted by key, so that it can be compared and hashed.

    NULL stays NULL at every level, and an empty map differs from NULL.
    """
    if not contains_map(dtype):
        return value
    if isinstance(dtype, T.MapType):
        entry = lambda e: F.struct(
            comparable(e["key"], dtype.keyType).alias("key"), comparable(e["value"], dtype.valueType).alias("value")
        )
        return F.array_sort(F.transform(F.map_entries(value), entry))
    if isinstance(dtype, T.ArrayType):
        return F.transform(value, lambda x: comparable(x, dtype.elementType))
    fields = [comparable(value.getField(f.name), f.dataType).alias(f.name) for f in dtype.fields]
    return F.when(value.isNotNull(), F.struct(*fields))


def comparable_maps(df: DataFrame) -> DataFrame:
    """`df` with its maps in the form that `comparable` gives them."""
    held = [f for f in df.schema.fields if contains_map(f.dataType)]
    return df.withColumns({f.name: comparable(col(f.name), f.dataType) for f in held}) if held else df


def all_of(conditions: Iterable[Column]) -> Column:
    return reduce(and_, conditions)


def any_of(conditions: Iterable[Column]) -> Column:
    return reduce(or_, conditions)


def same_keys(keys: Sequence[str], left: str, right: str) -> Column:
    """Null-safe equality of every key between two aliased relations."""
    return all_of(col(k, left).eqNullSafe(col(k, right)) for k in keys)


def unused_name(base: str, taken: Iterable[str]) -> str:
    """`base`, lengthened until it clashes with no column in `taken`."""
    folded = {t.lower() for t in taken}
    while base.lower() in folded:
        base += "_"
    return base


def typed_null(dtype: T.DataType | str) -> Column:
    return F.lit(None).cast(dtype)


def empty_frame(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """Zero rows with the given schema, without touching any data."""
    nulls = [typed_null(f.dataType).alias(f.name, metadata=f.metadata or {}) for f in schema.fields]
    return spark.range(0).select(*nulls)


def one_row(spark: SparkSession, schema: T.StructType, values: Sequence) -> DataFrame:
    """A single row of literals in a single partition."""
    pairs = zip(schema.fields, values, strict=True)
    literals = [F.lit(v).cast(f.dataType).alias(f.name) for f, v in pairs]
    return spark.range(0, 1, 1, 1).select(*literals)
