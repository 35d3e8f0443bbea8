"""Merging into plain partitioned Parquet: only the partitions that a source touches are read and replaced."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from silverline.functions.columns import all_of, any_of, col, cols, require_keys, resolve, same_keys, split_names
from silverline.operators.upsert import align, require_unique_keys, upsert
from silverline.session import materialise
from silverline.sinks import write_partitioned

MOVES = ("follow", "ignore")


def merge_partitions(
    spark: SparkSession,
    path: str,
    source: DataFrame,
    keys: str | Sequence[str],
    partition_cols: str | Sequence[str],
    *,
    guard: str | Sequence[str] = (),
    fill_missing: bool = False,
    source_unique: bool = False,
    moves: str = "follow",
) -> int:
    """Merge `source` into the Parquet files below `path`, laid out by `partition_cols`; returns the number of partitions replaced.

    The rules of `operators.upsert` hold. Partitions without a source row keep their files as they are and are not read, but for their
    keys where keys may move. Where nothing is stored yet, the source is written.

    A key whose stored row lies in another partition than its source row: with `moves="follow"` it moves. Stored keys, and only those
    columns, are matched with the source's to find the partitions that hold them; these are replaced too, and a partition that loses
    its last row is removed. With `moves="ignore"` a key counts in each partition for itself, so no other partition is looked at; use it
    where rows never change their partition.

    The source is evaluated once and stored. The merged partitions are staged before any file is replaced, and replaced by Spark's
    dynamic overwrite; a run that fails between two partitions is mended by running the same merge again. The driver sees one row per touched
    partition. One writer at a time.
    """
    names = require_keys(source, keys)
    parts = resolve(spark, source.columns, split_names(partition_cols), "partition columns")
    if not parts:
        raise ValueError("at least one partition column is required")
    if moves not in MOVES:
        raise ValueError(f"unknown rule {moves!r} for keys that move; choose from {MOVES}")
    files = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    store = files.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not store.exists(files):
        rows = source if source_unique else require_unique_keys(materialise(source, "merge-source"), names)
        staged = materialise(rows, "merged")
        write_partitioned(staged, path, parts)
        return staged.select(*cols(parts)).distinct().count()

    # partition columns come back in the types that the source has, not in those guessed from directory names
    plain = spark.read.parquet(path)
    types = {c: source.schema[c].dataType.simpleString() for c in parts}
    held = plain.withColumns({resolve(spark, plain.columns, [c], "partition columns")[0]: col(c).cast(t) for c, t in types.items()})
    ages = resolve(spark, held.columns, split_names(guard), "guard columns")
    identity = names if moves == "follow" else list(dict.fromkeys([*names, *parts]))
    incoming = materialise(align(source, held.schema, fill_missing=fill_missing, required=[*names, *parts, *ages]), "merge-source")
    if not source_unique:
        require_unique_keys(incoming.select(*cols(identity)), identity).write.format("noop").mode("overwrite").save()

    touched = incoming.select(*cols(parts))
    if moves == "follow":
        stored = held.select(*cols(dict.fromkeys([*names, *parts]))).alias("t")
        found = stored.join(incoming.select(*cols(names)).alias("s"), same_keys(names, "t", "s"), "left_semi")
        touched = touched.union(found.select(*cols(parts)))
    values = [tuple(r) for r in touched.distinct().collect()]
    if not values:
        return 0
    slice_ = held.where(_one_of(held, parts, values))
    merged = materialise(upsert(slice_, incoming, identity, guard=ages, source_unique=True), "merged")
    left = {tuple(r) for r in merged.select(*cols(parts)).distinct().collect()}
    emptied = [v for v in values if v not in left]
    folders = _folders(plain, parts, types, emptied) if emptied else []
    write_partitioned(merged, path, parts, touched_only=True)
    for folder in folders:
        jvm = spark.sparkContext._jvm  # file paths of rows are URIs
        store.delete(jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI.create(folder)), True)
    return len(values)


def _one_of(df: DataFrame, parts: Sequence[str], values: Sequence[tuple]) -> Column:
    """Whether a row is in one of the partitions, as literals that prune directories; NULL is a partition of its own."""
    if len(parts) == 1:
        c, kind = col(parts[0]), df.schema[parts[0]].dataType
        known = [F.lit(v[0]).cast(kind) for v in values if v[0] is not None]
        chosen = [c.isin(known)] if known else []
        return any_of([*chosen, *([c.isNull()] if any(v[0] is None for v in values) else [])])
    same = lambda c, v: col(c).isNull() if v is None else col(c) == F.lit(v).cast(df.schema[c].dataType)
    return any_of(all_of(same(c, v) for c, v in zip(parts, row)) for row in values)


def _folders(plain: DataFrame, parts: Sequence[str], types: dict[str, str], values: Sequence[tuple]) -> list[str]:
    """Directories of partitions, as their files name them."""
    typed = plain.select(*[col(c).cast(types[c]).alias(c) for c in parts], F.col("_metadata.file_path").alias("file"))
    chosen = typed.where(_one_of(typed, parts, values))
    return [r[0] for r in chosen.select(F.regexp_extract("file", "^(.*)/[^/]*$", 1)).distinct().collect()]
