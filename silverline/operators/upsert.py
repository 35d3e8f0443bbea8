"""Merge semantics on plain DataFrames: update what matches, insert the rest."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from silverline.functions.cells import in_cells, key_cell
from silverline.functions.columns import (
    any_of,
    col,
    cols,
    require_keys,
    resolve,
    same_keys,
    split_names,
    typed_null,
    unused_name,
)
from silverline.session import materialise

STRATEGIES = ("window", "full_outer", "anti_join", "split")
#: Cells that the key space is split into, at most, and cells for each source key.
MOST_CELLS, CELLS_PER_KEY = 1 << 20, 16


def align(
    source: DataFrame, target: T.StructType, *, fill_missing: bool = False, required: Sequence[str] = ()
) -> DataFrame:
    """`source` with the target's columns, in its order and types, matched by name.

    Columns the target lacks are dropped. A column the source lacks is an error,
    or NULL with `fill_missing`; one of `required` (keys and guards) is always an error.
    """
    spark = source.sparkSession
    resolve(spark, source.columns, required, "source columns")
    picked = []
    for field in target.fields:
        try:
            name = resolve(spark, source.columns, [field.name], "source columns")[0]
            value = col(name).cast(field.dataType)
        except ValueError:
            if not fill_missing:
                raise
            value = typed_null(field.dataType)
        picked.append(value.alias(field.name, metadata=field.metadata or {}))
    return source.select(*picked)


def require_unique_keys(df: DataFrame, keys: str | Sequence[str]) -> DataFrame:
    """`df` unchanged, but any action on it fails if a key occurs twice.

    The check is part of the plan: keys are counted with partial aggregation, so a
    key with very many copies is caught without gathering them in one task.
    """
    names = require_keys(df, keys)
    n = unused_name("n", names)
    message = F.lit(f"source has several rows for one key ({', '.join(names)})")
    repeated = F.when(col(n) > 1, F.raise_error(message).cast("boolean")).otherwise(F.lit(False))
    # a filter that is either false or an error: contributes no rows
    guard = df.groupBy(*cols(names)).agg(F.count(F.lit(1)).alias(n)).where(repeated)
    nulls = [typed_null(f.dataType).alias(f.name) for f in df.schema.fields]
    return df.unionByName(guard.select(*nulls))


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: str | Sequence[str],
    *,
    guard: str | Sequence[str] = (),
    fill_missing: bool = False,
    source_unique: bool = False,
    strategy: str = "window",
) -> DataFrame:
    """The target after merging `source` into it.

    Keys match null-safely. A source row replaces the target row with its key even
    when it is older; target rows without a match stay. With `guard` columns a
    source row that sorts before its target row on them is ignored (NULL is oldest).

    Source keys must be unique. Pass `source_unique=True` when the source comes
    from a per-key operator on the same keys. Otherwise the source is evaluated once, when this is called,
    and its stored keys are checked when the result is.

    * `window`: both sides in one relation, of which every key keeps the side that wins. Reads each side once and
      takes over the exchange of a side that is already dealt out by key, for example by a per-key operator.
      For any source.
    * `full_outer`: one join of the two sides. Its null-safe keys need an exchange of their own on both sides.
    * `anti_join`: target rows without a match, followed by the source. Reads the
      source twice, so it must be stored or cheap and always give the same rows. If
      its keys are small enough to broadcast, the target is not shuffled at all.
    * `split`: target rows that no source key can match, because they lie outside the source's range of the first key or in a hash cell
      without a source key, are passed on where they are; only the others are merged by `window`. For a source of few keys against a
      target of any size; the target is scanned twice, so it must be stored or cheap, and the source is evaluated when this is called.
    """
    names = require_keys(target, keys)
    if strategy not in STRATEGIES:
        raise ValueError(f"unknown strategy {strategy!r}; choose from {STRATEGIES}")
    ages = resolve(target.sparkSession, target.columns, split_names(guard), "guard columns")
    incoming = align(source, target.schema, fill_missing=fill_missing, required=[*names, *ages])
    if not source_unique or strategy == "split":
        # stored first: the rows that are checked are the rows that are merged
        incoming = materialise(incoming, "upsert-source")
    if strategy == "split":
        reach = _reach(incoming, names)
    if not source_unique:
        incoming = require_unique_keys(incoming, names)
    if strategy == "split":
        return _by_split(target, incoming, names, ages, reach)
    merge = {"window": _by_window, "full_outer": _by_full_outer, "anti_join": _by_anti_join}[strategy]
    return merge(target, incoming, names, ages)


def _by_window(target, incoming, keys, ages) -> DataFrame:
    """Per key all rows of the side that wins: target rows that repeat a key stay as long as no source row has it."""
    side = unused_name("side", target.columns)
    winner = unused_name("winner", [*target.columns, side])
    rows = target.withColumn(side, F.lit(0)).unionByName(incoming.withColumn(side, F.lit(1)))
    key = Window.partitionBy(*cols(keys))
    wins = F.max(col(side)).over(key)
    if ages:
        age = F.struct(*cols(ages))
        held, came = (F.max(F.when(col(side) == n, age)).over(key) for n in (0, 1))
        # a side without a row has no age; within an age NULL sorts before everything
        wins = (came.isNotNull() & F.coalesce(came >= held, F.lit(True))).cast("int")
    return rows.withColumn(winner, wins).where(col(side) == col(winner)).drop(side, winner)


def _by_full_outer(target, incoming, keys, ages) -> DataFrame:
    arrived = unused_name("arrived", target.columns)
    both = target.alias("t").join(
        incoming.withColumn(arrived, F.lit(True)).alias("s"), same_keys(keys, "t", "s"), "full_outer"
    )
    take = col(arrived, "s").isNotNull()
    if ages:
        take = take & ~_older(ages)
    return both.select(
        *[F.when(take, col(c, "s")).otherwise(col(c, "t")).alias(c) for c in target.columns]
    )


def _by_anti_join(target, incoming, keys, ages) -> DataFrame:
    if ages:
        held = target.select(*cols(dict.fromkeys([*keys, *ages])))
        stale = same_keys(keys, "s", "t") & _older(ages)
        incoming = incoming.alias("s").join(held.alias("t"), stale, "left_anti")
    arriving = incoming.select(*cols(keys))
    kept = target.alias("t").join(arriving.alias("s"), same_keys(keys, "t", "s"), "left_anti")
    return kept.unionByName(incoming)


def _reach(incoming: DataFrame, keys: Sequence[str]) -> tuple | None:
    """Number of cells, those that hold a source key, and least and greatest first key with the number of NULLs; None without rows."""
    first = col(keys[0])
    kind = incoming.schema[keys[0]].dataType
    ordered = isinstance(kind, (T.NumericType, T.DateType, T.StringType))
    low, high = (F.min(first), F.max(first)) if ordered else (F.lit(None), F.lit(None))
    n, n_null, low, high = incoming.agg(F.count("*"), F.count_if(first.isNull()), low, high).first()
    if not n:
        return None
    cells = min(MOST_CELLS, max(1024, 1 << (CELLS_PER_KEY * n - 1).bit_length()))
    # one row per cell at most
    chosen = [r[0] for r in incoming.select(key_cell(keys, cells)).distinct().collect()]
    return cells, chosen, low, high, n_null


def _by_split(target, incoming, keys, ages, reach) -> DataFrame:
    if reach is None:
        return target
    cells, chosen, low, high, n_null = reach
    first, kind = col(keys[0]), target.schema[keys[0]].dataType
    met = in_cells(key_cell(keys, cells), chosen, cells)
    if low is not None:
        # reaches the scan; NULL keys are kept apart, as they are in no range
        within = first.between(F.lit(low).cast(kind), F.lit(high).cast(kind))
        met = (within | first.isNull() if n_null else within) & met
    merged = _by_window(target.where(met), incoming, keys, ages)
    return target.where(~F.coalesce(met, F.lit(False))).unionByName(merged)


def _older(ages: Sequence[str]) -> Column:
    """Source row `s` sorts before target row `t`; NULL sorts before everything."""
    return F.struct(*cols(ages, "s")) < F.struct(*cols(ages, "t"))


def upsert_summary(target: DataFrame, source: DataFrame, keys: str | Sequence[str]) -> DataFrame:
    """One row counting the keys a merge would insert, update and keep.

    Keys are tagged by side and grouped once; grouping treats NULL keys as equal,
    and the tags say which side a key was seen on.
    """
    names = require_keys(target, keys)
    sides = key_presence(target, source, names)
    in_target, in_source = col(sides.columns[-2]) > 0, col(sides.columns[-1]) > 0
    return sides.agg(
        F.count_if(in_source & ~in_target).alias("inserted"),
        F.count_if(in_source & in_target).alias("updated"),
        F.count_if(in_target & ~in_source).alias("kept"),
    )


def key_presence(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Every distinct key with its number of rows on each side (last two columns)."""
    n_left = unused_name("left_rows", keys)
    n_right = unused_name("right_rows", keys)
    tagged = left.select(*cols(keys), F.lit(1).alias(n_left), F.lit(0).alias(n_right)).unionByName(
        right.select(*cols(keys), F.lit(0).alias(n_left), F.lit(1).alias(n_right))
    )
    return tagged.groupBy(*cols(keys)).agg(
        F.sum(col(n_left)).alias(n_left), F.sum(col(n_right)).alias(n_right)
    )


def has_null_key(keys: Sequence[str]):
    return any_of(col(k).isNull() for k in keys)


def newest_side(
    rows: DataFrame, partition: Iterable[str], side: str, guard: Sequence[str] = ()
) -> DataFrame:
    """Per key keep the row of the highest `side` (0 or 1), or by `guard` first when given.

    A key with several rows of side 1 fails the action. One exchange on (a prefix of) `partition`
    serves the check, the merge and a write clustered by it.
    """
    order = [col(c).desc_nulls_last() for c in [*guard, side]]
    key = Window.partitionBy(*cols(partition))
    taken = [*rows.columns]
    rank, arrived = unused_name("rank", taken), unused_name("arrived", taken)
    rows = rows.withColumns({rank: F.row_number().over(key.orderBy(*order)), arrived: F.sum(col(side)).over(key)})
    repeated = F.raise_error(F.lit("source has several rows for one key")).cast("boolean")
    return rows.where(F.when(col(arrived) > 1, repeated).otherwise(col(rank) == 1)).drop(rank, arrived)
