"""Does the current-state table agree with the feed it was built from?

`bronze` is the feed already reduced to one row per key. Checks return counts as
DataFrames; nothing is raised here. With `null_safe=False` a NULL equals nothing:
a NULL key is always missing and NULL against a value is not a difference. With
`null_safe=True` NULLs compare as ordinary values.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from silverline.functions.cells import in_cells, key_cell, told_apart
from silverline.functions.columns import (
    all_of,
    col,
    cols,
    comparable_maps,
    contains_map,
    name_folder,
    require_keys,
    resolve,
    same_keys,
    split_names,
    typed_null,
    unused_name,
)
from silverline.operators.upsert import has_null_key, key_presence

CHECK_SCHEMA = "schema"
CHECK_COUNTS = "counts"
CHECK_KEYS = "key_coverage"
CHECK_VALUES = "column_values"


def counts(bronze: DataFrame, silver: DataFrame) -> DataFrame:
    """One row: `bronze_count`, `silver_count`."""
    tagged = bronze.select(F.lit(1).alias("b"), F.lit(0).alias("s")).unionAll(
        silver.select(F.lit(0).alias("b"), F.lit(1).alias("s"))
    )
    return tagged.agg(
        F.coalesce(F.sum("b"), F.lit(0)).alias("bronze_count"),
        F.coalesce(F.sum("s"), F.lit(0)).alias("silver_count"),
    )


def missing_keys(
    bronze: DataFrame, silver: DataFrame, keys: str | Sequence[str], *, null_safe: bool = False
) -> DataFrame:
    """Distinct bronze keys that silver does not hold."""
    names = require_keys(bronze, keys)
    if null_safe:
        # grouping treats NULL keys as equal and, unlike a null-safe join, keeps the exchange on the plain keys
        sides = key_presence(bronze, silver, names)
        in_bronze, in_silver = cols(sides.columns[-2:])
        return sides.where((in_bronze > 0) & (in_silver == 0)).select(*cols(names))
    have = bronze.select(*cols(names)).distinct()
    seen = silver.select(*cols(names)).distinct()
    return have.join(seen, on=names, how="left_anti")


def key_coverage(
    bronze: DataFrame, silver: DataFrame, keys: str | Sequence[str], *, null_safe: bool = False
) -> DataFrame:
    """One row: `missing_keys`, the number of bronze keys that silver does not hold."""
    missing = missing_keys(bronze, silver, keys, null_safe=null_safe)
    return missing.agg(F.count(F.lit(1)).alias("missing_keys"))


def comparable_columns(
    bronze: DataFrame,
    silver: DataFrame,
    keys: Sequence[str],
    exclude: Sequence[str] = (),
) -> tuple[list[str], list[str]]:
    """Columns to compare by default, and those that cannot be.

    Compared are the bronze columns, minus keys and `exclude`, that silver has too.
    The second list names columns found on one side only and columns holding maps,
    which Spark cannot compare.
    """
    fold = name_folder(bronze.sparkSession)
    skip = {fold(c) for c in (*keys, *exclude)}
    ours = {fold(c): c for c in bronze.columns if fold(c) not in skip}
    theirs = {fold(c): c for c in silver.columns if fold(c) not in skip}
    shared = [n for n in ours if n in theirs]
    maps = {
        n
        for n in shared
        if contains_map(bronze.schema[ours[n]].dataType) or contains_map(silver.schema[theirs[n]].dataType)
    }
    skipped = [c for n, c in ours.items() if n not in theirs]
    skipped += [c for n, c in theirs.items() if n not in ours]
    skipped += [ours[n] for n in shared if n in maps]
    return [ours[n] for n in shared if n not in maps], skipped


def column_diffs(
    bronze: DataFrame,
    silver: DataFrame,
    keys: str | Sequence[str],
    columns: str | Sequence[str] | None = None,
    *,
    exclude: Sequence[str] = (),
    null_safe: bool = False,
    maps: bool = False,
) -> DataFrame:
    """One row with, per compared column, the number of matched rows that differ.

    With `maps`, columns holding maps are compared too: equal are maps of the same entries, in whatever order they are stored.
    """
    if maps:
        bronze, silver = comparable_maps(bronze), comparable_maps(silver)
    names = require_keys(bronze, keys)
    chosen, _ = _chosen(bronze, silver, names, columns, exclude)
    if not chosen:
        raise ValueError("no columns to compare")
    if null_safe:
        return _diffs_by_window(bronze, silver, names, chosen)
    pairs = _paired(bronze, silver, names, chosen, "inner", null_safe)
    return pairs.agg(*[F.count_if(_differs(c, null_safe)).alias(c) for c in chosen])


def _diffs_by_window(bronze: DataFrame, silver: DataFrame, keys: Sequence[str], chosen: Sequence[str]) -> DataFrame:
    """Differences of matched rows, NULLs compared as values: the bronze row of a key is carried to each silver row of it.

    Both sides meet in one relation dealt out by the plain keys, which a null-safe join would not do; a side that is dealt out
    by key already keeps its exchange. Bronze holds a key once, silver any number of times.
    """
    left, right, ours, theirs = _side_by_side(bronze, silver, keys, chosen)
    held = F.first(col(ours), ignorenulls=True).over(Window.partitionBy(*cols(keys)))
    carried = unused_name("carried", [*keys, ours, theirs])
    pairs = left.unionByName(right).withColumn(carried, held).where(col(theirs).isNotNull() & col(carried).isNotNull())
    return pairs.agg(
        *[F.count_if(~col(carried)[f"c{n}"].eqNullSafe(col(theirs)[f"c{n}"])).alias(c) for n, c in enumerate(chosen)]
    )


def _side_by_side(bronze, silver, keys, chosen) -> tuple[DataFrame, DataFrame, str, str]:
    """Both sides with the same columns: keys, the packed bronze columns and the packed silver columns, of which one is NULL."""
    ours, theirs = unused_name("ours", keys), unused_name("theirs", keys)
    # each side keeps its own column types
    packed = F.struct(F.lit(1).alias("there"), *[col(c).alias(f"c{n}") for n, c in enumerate(chosen)])
    left = bronze.select(*cols(keys), packed.alias(ours))
    right = silver.select(*cols(keys), packed.alias(theirs))
    return (
        left.withColumn(theirs, typed_null(right.schema[theirs].dataType)),
        right.withColumn(ours, typed_null(left.schema[ours].dataType)),
        ours,
        theirs,
    )


def report(
    bronze: DataFrame,
    silver: DataFrame,
    keys: str | Sequence[str],
    columns: str | Sequence[str] | None = None,
    *,
    exclude: Sequence[str] = (),
    null_safe: bool = False,
    silver_unique: bool = False,
    maps: bool = False,
) -> DataFrame:
    """All checks, one row each: `check, item, bronze_rows, silver_rows, violations, passed`.

    Without `columns`, every column that cannot be compared, because one side lacks it or because it
    holds a map, is a failed check of its own. With `maps`, maps are compared by their entries. A feed of keys alone gets
    counts and coverage.

    With `silver_unique` (a table that holds every key once by construction) all
    checks come out of one full outer join, or with `null_safe` out of one grouping by key, which uses the exchange
    that a side may have already. Otherwise counts and coverage share one
    grouping of the key columns and values take an inner join: both stand a silver
    table with repeated keys, because the grouping aggregates before its shuffle and
    adaptive execution may split the join. Pass a materialised `bronze`.
    """
    if maps:
        bronze, silver = comparable_maps(bronze), comparable_maps(silver)
    names = require_keys(bronze, keys)
    chosen, skipped = _chosen(bronze, silver, names, columns, exclude)
    if silver_unique and null_safe:
        return _report_by_group(bronze, silver, names, chosen, skipped)
    if silver_unique:
        return _report_by_join(bronze, silver, names, chosen, skipped)

    sides = key_presence(bronze, silver, names)
    in_bronze, in_silver = cols(sides.columns[-2:])
    absent = in_silver == 0
    if not null_safe:
        absent = absent | has_null_key(names)
    totals = sides.agg(
        F.coalesce(F.sum(in_bronze), F.lit(0)).alias("bronze_rows"),
        F.coalesce(F.sum(in_silver), F.lit(0)).alias("silver_rows"),
        F.count_if((in_bronze > 0) & absent).alias("missing"),
    )
    checks = _as_rows(totals, [*_schema_checks(skipped), *_key_checks()])
    if not chosen:
        return checks
    diffs = column_diffs(bronze, silver, names, chosen, null_safe=null_safe)
    return checks.unionByName(_as_rows(diffs, [_value_check(c, col(c)) for c in chosen]))


def digest_report(
    bronze: DataFrame,
    silver: DataFrame,
    keys: str | Sequence[str],
    columns: str | Sequence[str] | None = None,
    *,
    exclude: Sequence[str] = (),
    null_safe: bool = False,
    silver_unique: bool = False,
    maps: bool = False,
    cells: int = 4096,
) -> DataFrame:
    """The rows of `report`, with only those parts of the tables joined that differ.

    Both sides are first reduced to `cells` rows, one per hash cell of the key: row count, and for the keys and every compared column a
    sum of 64-bit hashes that does not depend on order. Cells whose digests agree hold the same rows and need no more than
    their counts; all rows of the others go through `report` itself. So a table that agrees costs one scan of either side and no shuffle of
    rows, and one changed row costs the shuffle of its cell.

    Without `null_safe`, rows with a NULL in their key always go through `report`, as they never match. `bronze` must hold a key once. Digests are
    evaluated when this is called; both sides are read again for the cells that differ, so they should be stored.
    """
    if maps:
        bronze, silver = comparable_maps(bronze), comparable_maps(silver)
    names = require_keys(bronze, keys)
    chosen, skipped = _chosen(bronze, silver, names, columns, exclude)
    digests = [_digest(df, names, chosen, cells) for df in (bronze, silver)]
    both = digests[0].withColumn("side", F.lit(0)).unionByName(digests[1].withColumn("side", F.lit(1)))
    parts = [c for c in digests[0].columns if c not in ("cell", "n")]
    alike = F.count("*") == 2
    for c in ("n", *parts):
        alike = alike & F.min(c).eqNullSafe(F.max(c))
    judged = both.groupBy("cell").agg(alike.alias("alike"), F.max("n").alias("n")).collect()  # at most `cells` rows
    different = [r.cell for r in judged if not r.alike]
    settled = sum(r.n for r in judged if r.alike)
    unmatched = F.lit(False) if null_safe else has_null_key(names)
    open_ = unmatched | in_cells(key_cell(names, cells), different, cells)
    left, right = bronze.where(open_), silver.where(open_)
    if not null_safe:
        # settled rows without a key are among those that are reported
        settled -= _null_keyed(bronze, names, different, cells)
    checks = report(
        left, right, names, chosen or None, exclude=[*exclude, *skipped], null_safe=null_safe, silver_unique=silver_unique
    )
    total = lambda c: F.when(col(c).isNotNull(), col(c) + F.lit(settled)).alias(c)
    checks = checks.select("check", "item", total("bronze_rows"), total("silver_rows"), "violations", "passed")
    if not skipped:
        return checks
    failed = bronze.sparkSession.range(0, 1, 1, 1).select(F.inline(F.array(*_schema_checks(skipped))))
    return failed.unionByName(checks)


def _digest(df: DataFrame, keys: Sequence[str], chosen: Sequence[str], cells: int) -> DataFrame:
    """Per cell its rows and, for the keys and every column, the sum of hashes of (key, value)."""
    kinds = {c: df.schema[resolve(df.sparkSession, df.columns, [c], "columns")[0]].dataType for c in (*keys, *chosen)}
    seen = lambda c: told_apart(col(c), kinds[c])
    total = lambda *c: F.sum(F.xxhash64(*map(seen, (*keys, *c))).cast("decimal(38,0)"))
    sums = [total(c).alias(f"d{n}") for n, c in enumerate(chosen)]
    return df.groupBy(key_cell(keys, cells).alias("cell")).agg(F.count("*").alias("n"), total().alias("d"), *sums)


def _null_keyed(bronze: DataFrame, keys: Sequence[str], different: Sequence[int], cells: int) -> int:
    """Bronze rows with a NULL in their key whose cell agrees."""
    rows = bronze.where(has_null_key(keys) & ~in_cells(key_cell(keys, cells), different, cells))
    return rows.count()


def _report_by_group(bronze, silver, keys, chosen, skipped) -> DataFrame:
    """All checks from at most one row per key and side, NULLs compared as values."""
    left, right, ours, theirs = _side_by_side(bronze, silver, keys, chosen)
    both = left.unionByName(right)
    pairs = both.groupBy(*cols(keys)).agg(*[F.first(col(c), ignorenulls=True).alias(c) for c in (ours, theirs)])
    held, kept = col(ours), col(theirs)
    matched = held.isNotNull() & kept.isNotNull()
    diffs = [
        F.count_if(matched & ~held[f"c{n}"].eqNullSafe(kept[f"c{n}"])).alias(f"diff_{n}") for n in range(len(chosen))
    ]
    missing = F.count_if(held.isNotNull() & kept.isNull()).alias("missing")
    totals = pairs.agg(F.count(held).alias("bronze_rows"), F.count(kept).alias("silver_rows"), missing, *diffs)
    return _as_totals(totals, chosen, skipped)


def _report_by_join(bronze, silver, keys, chosen, skipped) -> DataFrame:
    in_bronze = unused_name("in_bronze", [*keys, *chosen])
    in_silver = unused_name("in_silver", [*keys, *chosen])
    pairs = _paired(
        bronze.withColumn(in_bronze, F.lit(1)),
        silver.withColumn(in_silver, F.lit(1)),
        keys,
        chosen,
        "full_outer",
        False,
        markers=(in_bronze, in_silver),
    )
    both = col(in_bronze).isNotNull() & col(in_silver).isNotNull()
    counted = [
        F.count_if(both & _differs(c, False)).alias(f"diff_{n}") for n, c in enumerate(chosen)
    ]
    totals = pairs.agg(
        F.count(col(in_bronze)).alias("bronze_rows"),
        F.count(col(in_silver)).alias("silver_rows"),
        F.count_if(col(in_silver).isNull()).alias("missing"),
        *counted,
    )
    return _as_totals(totals, chosen, skipped)


def _as_totals(totals: DataFrame, chosen: Sequence[str], skipped: Sequence[str]) -> DataFrame:
    """Rows of checks out of row counts, missing keys and differences by column number."""
    values = [_value_check(c, col(f"diff_{n}")) for n, c in enumerate(chosen)]
    return _as_rows(totals, [*_schema_checks(skipped), *_key_checks(), *values])


def _chosen(bronze, silver, keys, columns, exclude) -> tuple[list[str], list[str]]:
    """The columns to compare, checked to exist on both sides, and those left out unasked."""
    wanted = split_names(columns)
    if not wanted:
        return comparable_columns(bronze, silver, keys, exclude)
    wanted = resolve(bronze.sparkSession, bronze.columns, wanted, "compared columns")
    resolve(bronze.sparkSession, silver.columns, wanted, "compared columns")
    return wanted, []


def _paired(bronze, silver, keys, chosen, how, null_safe, markers=(None, None)) -> DataFrame:
    """Bronze rows as `b` joined by key to silver rows as `s`, only the columns needed."""
    needed = list(dict.fromkeys([*keys, *chosen]))
    left, right = ([*needed, m] if m else needed for m in markers)
    match = same_keys(keys, "b", "s")
    if not null_safe:
        match = all_of(col(k, "b") == col(k, "s") for k in keys)
    return bronze.select(*cols(left)).alias("b").join(silver.select(*cols(right)).alias("s"), match, how)


def _differs(name: str, null_safe: bool) -> Column:
    left, right = col(name, "b"), col(name, "s")
    return ~left.eqNullSafe(right) if null_safe else left != right


def _check(kind: str, item: str, violations: Column, in_bronze=None, in_silver=None) -> Column:
    unknown = F.lit(None).cast("long")
    return F.struct(
        F.lit(kind).alias("check"),
        F.lit(item).alias("item"),
        (unknown if in_bronze is None else in_bronze).alias("bronze_rows"),
        (unknown if in_silver is None else in_silver).alias("silver_rows"),
        violations.alias("violations"),
        (violations == 0).alias("passed"),
    )


def _key_checks() -> list[Column]:
    held, kept = col("bronze_rows"), col("silver_rows")
    return [
        _check(CHECK_COUNTS, "rows", F.abs(held - kept), held, kept),
        _check(CHECK_KEYS, "missing", col("missing")),
    ]


def _schema_checks(skipped: Sequence[str]) -> list[Column]:
    return [_check(CHECK_SCHEMA, c, F.lit(1).cast("long")) for c in skipped]


def _value_check(name: str, violations: Column) -> Column:
    return _check(CHECK_VALUES, name, violations)


def _as_rows(totals: DataFrame, checks: Sequence[Column]) -> DataFrame:
    """One row per check out of a single row of totals."""
    return totals.select(F.inline(F.array(*checks)))
