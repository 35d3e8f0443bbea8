"""A keyed current-state table on plain Parquet directories, with history.

For sessions without a catalog that can merge rows. State is hashed by key into a
number of buckets that is given or follows from the size of the first load. A merge reads and rewrites only the buckets its source
touches; a snapshot is, for every bucket, the newest copy written up to then.

    <base>/definition/                            keys, partitions, buckets (0 before the first load), first schema
    <base>/lineage=<k>/data/_snapshot_id=<n>/_key_bucket=<b>/[<partition>=..]/
    <base>/lineage=<k>/commits/                   one row per snapshot, written last, with the
                                                  buckets it wrote and their row counts
    <base>/lineage=<k>/schema_log/                columns added and dropped, in order

Readers trust `commits` only, so files of an unfinished commit are never read and
are overwritten by the next one. One writer at a time.
"""

from __future__ import annotations

import json
import math
from collections import defaultdict
from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from silverline.functions.columns import (
    col,
    cols,
    empty_frame,
    one_row,
    require_keys,
    resolve,
    split_names,
    typed_null,
    unused_name,
)
from silverline.operators.upsert import align, newest_side
from silverline.session import scratch_path
from silverline.tables.schema_history import ADD, CHANGE, DROP, SchemaHistory

SNAPSHOT, BUCKET = "_snapshot_id", "_key_bucket"
HOLDING, INCOMING = 0, 1

# buckets of a table whose first load is small, and the most that a load is given: bounds the commit log's entries
DEFAULT_BUCKETS, MOST_BUCKETS = 16, 1 << 14
# stored bytes of the first load that make a bucket, and those that one task of a merge holds
BUCKET_BYTES, TASK_BYTES = 128 << 20, 256 << 20
# buckets and folders that are counted without a job of their own
COUNTED_BUCKETS = 64
# most rows that one task of a merge holds, however narrow
ROWS_PER_TASK = 1_000_000

DEFINITION = "lineage int, keys array<string>, partitions array<string>, buckets int, schema_json string"
COMMITS = (
    "snapshot_id long, committed_at timestamp, operation string, schema_id int, "
    "inserted long, updated long, total long, parts map<int, long>"
)


class SnapshotTable:
    # merges are the only way in, and they keep one row per key
    holds_keys_once = True

    def __init__(
        self,
        spark: SparkSession,
        base: str,
        *,
        bucket_bytes: int = BUCKET_BYTES,
        task_bytes: int = TASK_BYTES,
        rows_per_task: int | None = None,
    ):
        """Sizes are bytes of compressed Parquet. `bucket_bytes` sets the number of buckets when a table without
        a given number gets its first rows. `task_bytes` and `rows_per_task` (ROWS_PER_TASK if not given) are what
        one task of a merge holds on average at most. They change tasks and files, never rows."""
        self.spark = spark
        self.base = base.rstrip("/")
        self.bucket_bytes, self.task_bytes = bucket_bytes, task_bytes
        self.rows_per_task = rows_per_task or ROWS_PER_TASK
        self._spec: Row | None = None

    # -- life cycle ---------------------------------------------------------

    def exists(self) -> bool:
        return self._find_definition() is not None

    def ensure(
        self,
        like: DataFrame,
        keys: str | Sequence[str],
        *,
        partitions: str | Sequence[str] | None = None,
        buckets: int | None = None,
        recreate: bool = False,
    ) -> SnapshotTable:
        """Create the table empty with the columns of `like`, unless it exists.

        Partition columns must be columns of `like`. An existing table keeps its
        columns; other keys, partitions or buckets than its own are an error. `recreate`
        starts over with an empty table and no history. `buckets` sets how finely a merge can choose what to
        rewrite, not how parallel it runs, and stays for good: choose many more than a usual merge brings keys
        where a large table receives few changes at a time. If not given, the first load decides by its size,
        from DEFAULT_BUCKETS to MOST_BUCKETS.
        """
        names = require_keys(like, keys)
        parts = resolve(self.spark, like.columns, split_names(partitions), "partition columns")
        current = self._find_definition()
        if current and not recreate:
            self._check_keys(names)
            if parts and parts != list(current.partitions):
                raise ValueError(f"table is partitioned by {list(current.partitions)}, not {parts}")
            if buckets and buckets != current.buckets:
                own = current.buckets or "an undecided number of"
                raise ValueError(f"table has {own} buckets, not {buckets}")
            return self
        reserved = [c for c in like.columns if c.lower() in (SNAPSHOT, BUCKET)]
        if reserved:
            raise ValueError(f"reserved column names: {reserved}")
        fields = [T.StructField(f.name, f.dataType, True, f.metadata) for f in like.schema.fields]
        lineage = current.lineage + 1 if current else 1
        definition = (lineage, names, parts, buckets or 0, T.StructType(fields).json())
        self._append(f"{self.base}/definition", DEFINITION, definition)
        self._spec = None
        self._commit_unchanged(1, "create", schema_id=0, total=0)
        return self

    # -- reading ------------------------------------------------------------

    @property
    def keys(self) -> list[str]:
        return list(self._definition().keys)

    @property
    def schema(self) -> T.StructType:
        """Current columns."""
        return self._history().latest

    def current(self) -> DataFrame:
        """Latest committed state, in the current schema."""
        history = self._history()
        return self._state(None, history, history.latest_id)

    def as_of(self, snapshot_id: int) -> DataFrame:
        """State after the given commit, in the schema of that time."""
        commit = self.snapshots().where(col("snapshot_id") == snapshot_id).first()
        if commit is None:
            raise ValueError(f"no snapshot {snapshot_id} in {self.base}")
        return self._state(snapshot_id, self._history(), commit.schema_id)

    def snapshots(self) -> DataFrame:
        """The commit log."""
        return self._commits().drop("parts")

    def first_snapshot(self) -> DataFrame:
        """The earliest commit; no row if there is none."""
        return self.snapshots().orderBy("committed_at", "snapshot_id").limit(1)

    def previous_snapshot(self) -> DataFrame:
        """The commit before the latest; no row if there is none."""
        latest = (col("committed_at").desc(), col("snapshot_id").desc())
        return self.snapshots().orderBy(*latest).limit(2).offset(1)

    def preview(self, n: int = 10) -> DataFrame:
        return self.current().limit(n)

    def describe(self) -> DataFrame:
        """Name, type and comment of every column."""
        described = [
            F.struct(
                F.lit(f.name).alias("col_name"),
                F.lit(f.dataType.simpleString()).alias("data_type"),
                F.lit((f.metadata or {}).get("comment")).cast("string").alias("comment"),
            )
            for f in self.schema
        ]
        return self.spark.range(0, 1, 1, 1).select(F.inline(F.array(*described)))

    # -- writing ------------------------------------------------------------

    def merge(
        self,
        source: DataFrame,
        keys: str | Sequence[str] | None = None,
        *,
        guard: str | Sequence[str] = (),
        fill_missing: bool = False,
        source_unique: bool = False,
    ) -> int:
        """Merge `source` into the table as one commit; returns the snapshot id.

        Same rules as `operators.upsert`, also on the first load. The source is evaluated once and stored. Only the
        buckets holding its keys are read. Old and new rows of a key meet in one task,
        where the check for repeated source keys, the merge and the write share a single exchange, so the
        check is always made and `source_unique` changes nothing here; buckets that have
        grown large are spread over several tasks by key. One writer at a time: two would take the same
        snapshot id. Use `CatalogTable` where several write.
        """
        history = self._history()
        schema = history.latest
        spec = self._definition()
        if keys:
            self._check_keys(split_names(keys))
        ages = resolve(self.spark, schema.names, split_names(guard), "guard columns")
        incoming = align(source, schema, fill_missing=fill_missing, required=[*spec.keys, *ages])

        last, live = self._live_parts()
        before = sum(p.row_count for p in live)
        folder = f"{self._path('data')}/{SNAPSHOT}={last + 1}"
        stored = scratch_path(self.spark, "merge-source")
        # the run that stores the source tells its rows and, where their number is settled, the buckets they touch
        seen = Observation()
        met = [F.collect_set(self._bucket(spec)).alias("buckets")] if spec.buckets else []
        incoming.observe(seen, F.count(F.lit(1)).alias("rows"), *met).write.parquet(stored)
        incoming = self.spark.read.schema(incoming.schema).parquet(stored)
        arrived = seen.get["rows"]
        if not arrived:
            self._commit_unchanged(last + 1, "merge", schema_id=history.latest_id, total=before)
            return last + 1
        arriving = set(seen.get["buckets"]) if spec.buckets else None
        if arriving is None:
            spec = self._choose_buckets(stored)
            arriving = set(range(spec.buckets))
        incoming = incoming.withColumn(BUCKET, self._bucket(spec))
        touched = [p for p in live if p[BUCKET] in arriving]
        held = self._read(touched, history, history.latest_id)
        replaced = sum(p.row_count for p in touched)
        folders = [f for of in self._folders(touched).values() for f in of]
        tasks = max((arrived + replaced) / self.rows_per_task, self._bytes(stored, *folders) / self.task_bytes)
        splits = max(1, math.ceil(tasks / len(arriving)))
        merged, side = self._merged(held, incoming, sorted(arriving), splits, ages)
        # few buckets are counted as they are written; the tasks that write them are the last ones
        few = sorted(arriving) if not spec.partitions and len(arriving) <= COUNTED_BUCKETS else []
        written = Observation()
        counts = [F.count_if(col(BUCKET) == b).alias(f"b{b}") for b in few]
        if ages or few:
            merged = merged.observe(written, F.count_if(col(side) == INCOMING).alias("taken"), *counts)
        merged = merged.drop(side)
        if spec.partitions:
            # else every task would write a file into each of its partitions
            merged = merged.hint("rebalance", BUCKET, *spec.partitions)
        self._save(merged, folder)
        accepted = written.get["taken"] if ages else arrived
        if few:
            parts = {b: n for b in few if (n := written.get[f"b{b}"])}
            inserted = sum(parts.values()) - replaced
            row = (last + 1, None, "merge", history.latest_id, inserted, accepted - inserted, before + inserted, None)
            sizes = (F.array(*map(F.lit, x)) for x in (parts, parts.values()))
            commit = one_row(self.spark, T.StructType.fromDDL(COMMITS), row)
            self._commit(commit.withColumn("parts", F.map_from_arrays(*sizes).cast("map<int,bigint>")))
        else:
            self._commit_folder(folder, last + 1, history, before=before, replaced=replaced, accepted=accepted)
        return last + 1

    def _bucket(self, spec: Row) -> Column:
        return F.pmod(F.xxhash64(*cols(spec.keys)), F.lit(spec.buckets)).cast("int")

    def _bytes(self, *folders: str) -> int:
        """Stored bytes below some folders; only listings are read, by a job where there are many."""
        if len(folders) <= COUNTED_BUCKETS:
            return sum(store.getContentSummary(path).getLength() for store, path in map(self._file, folders))
        files = self.spark.read.format("binaryFile").option("recursiveFileLookup", True).load(list(folders))
        return files.agg(F.sum("length")).first()[0] or 0

    def _file(self, path: str):
        """The file system of a path, and the path as it knows it."""
        context = self.spark.sparkContext
        known = context._jvm.org.apache.hadoop.fs.Path(path)
        return known.getFileSystem(context._jsc.hadoopConfiguration()), known

    def _choose_buckets(self, stored: str) -> Row:
        """Decide the number of buckets from the first rows that arrive."""
        spec = self._definition()
        chosen = min(MOST_BUCKETS, max(DEFAULT_BUCKETS, -(-self._bytes(stored) // self.bucket_bytes)))
        decided = (spec.lineage, list(spec.keys), list(spec.partitions), chosen, spec.schema_json)
        self._append(f"{self.base}/definition", DEFINITION, decided)
        self._spec = None
        return self._definition()

    def add_column(self, name: str, column_type: str, comment: str | None = None) -> None:
        """Add a column at the end; existing rows read NULL. Makes no snapshot."""
        dtype = self.spark.range(0).select(typed_null(column_type).alias("c")).schema["c"].dataType
        taken = {n.lower() for n in [*self.schema.names, SNAPSHOT, BUCKET]}
        if name.lower() in taken:
            raise ValueError(f"column {name!r} already exists")
        self._log_change(ADD, name, T.StructType([T.StructField("c", dtype)]).json(), comment)

    def drop_column(self, name: str) -> None:
        """Remove a column; adding the name again later reads NULL. Makes no snapshot."""
        spec = self._definition()
        name = resolve(self.spark, self.schema.names, [name], "column")[0]
        if name in (*spec.keys, *spec.partitions):
            raise ValueError(f"{name!r} is a key or partition column")
        self._log_change(DROP, name, None, None)

    def _merged(
        self, held: DataFrame, incoming: DataFrame, touched: Sequence[int], splits: int, guard: Sequence[str]
    ) -> tuple[DataFrame, str]:
        """New rows of the touched buckets, each bucket in `splits` tasks, and the name
        of the column telling which side a row came from."""
        spec = self._definition()
        side = unused_name("side", held.columns)
        rows = held.withColumn(side, F.lit(HOLDING)).unionByName(incoming.withColumn(side, F.lit(INCOMING)))
        # cells are numbered without gaps, so each gets a task of its own
        cell = unused_name("cell", rows.columns)
        place = {b: i for i, b in enumerate(touched)}
        listed = ",".join(str(place.get(b, -1)) for b in range(spec.buckets))
        number = F.get(F.split(F.lit(listed), ",").cast("array<int>"), col(BUCKET))
        share = F.pmod(F.hash(*cols(spec.keys)), F.lit(splits))
        rows = rows.withColumn(cell, number * splits + share)
        rows = rows.repartitionById(len(touched) * splits, col(cell))
        return newest_side(rows, [cell, *spec.keys], side, guard).drop(cell), side

    def _save(self, rows: DataFrame, folder: str) -> None:
        """Write rows by bucket, replacing whatever an unfinished commit left there."""
        spec = self._definition()
        for name in spec.partitions:
            # an empty text would read back as NULL from a directory name
            if isinstance(rows.schema[name].dataType, T.StringType):
                refuse = F.raise_error(F.lit(f"empty text in partition column {name}")).cast("string")
                rows = rows.withColumn(name, F.when(col(name) == "", refuse).otherwise(col(name)))
        writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "static")
        writer.partitionBy(BUCKET, *spec.partitions).parquet(folder)

    def _commit_folder(
        self,
        folder: str,
        snapshot_id: int,
        history: SchemaHistory,
        *,
        before: int,
        replaced: int,
        accepted: int | None,
    ) -> None:
        """Commit the buckets found in `folder`; row counts come from the file footers."""
        sizes = self._scan([folder], history.latest).groupBy(BUCKET).agg(F.count(F.lit(1)).alias("row_count"))
        inserted = F.coalesce(F.sum("row_count"), F.lit(0)) - F.lit(replaced)
        # one entry per touched bucket
        written = F.map_from_entries(F.collect_list(F.struct(BUCKET, "row_count")))
        taken = col("inserted") if accepted is None else F.lit(accepted)
        commit = sizes.agg(inserted.alias("inserted"), written.alias("parts")).select(
            F.lit(snapshot_id).alias("snapshot_id"),
            F.lit("merge").alias("operation"),
            F.lit(history.latest_id).alias("schema_id"),
            "inserted",
            (taken - col("inserted")).alias("updated"),
            (F.lit(before) + col("inserted")).alias("total"),
            "parts",
        )
        self._commit(commit)

    # -- logs ---------------------------------------------------------------

    def _find_definition(self) -> Row | None:
        if self._spec is None:
            log = self._find_log(f"{self.base}/definition", DEFINITION)
            self._spec = log.orderBy(col("lineage").desc(), col("buckets").desc()).first() if log is not None else None
        return self._spec

    def _definition(self) -> Row:
        spec = self._find_definition()
        if spec is None:
            raise ValueError(f"no table at {self.base}")
        return spec

    def _check_keys(self, keys: Sequence[str]) -> None:
        own = list(self._definition().keys)
        if resolve(self.spark, [*own, *keys], keys, "keys") != own:
            raise ValueError(f"table is keyed by {own}, not {list(keys)}")

    def _history(self) -> SchemaHistory:
        first = T.StructType.fromJson(json.loads(self._definition().schema_json))
        # one row per ALTER ever issued
        log = self._find_log(self._path("schema_log"), CHANGE)
        changes = sorted(log.collect(), key=lambda c: c.schema_id) if log is not None else []
        return SchemaHistory(first, changes)

    def _path(self, part: str) -> str:
        return f"{self.base}/lineage={self._definition().lineage}/{part}"

    def _find_log(self, path: str, schema: str) -> DataFrame | None:
        store, known = self._file(path)
        return self.spark.read.schema(schema).parquet(path) if store.exists(known) else None

    def _append(self, path: str, schema: str, row: tuple) -> None:
        one_row(self.spark, T.StructType.fromDDL(schema), row).write.mode("append").parquet(path)

    def _commits(self) -> DataFrame:
        log = self._find_log(self._path("commits"), COMMITS)
        return empty_frame(self.spark, T.StructType.fromDDL(COMMITS)) if log is None else log

    def _commit(self, row: DataFrame) -> None:
        row = row.withColumn("committed_at", F.current_timestamp())
        align(row, T.StructType.fromDDL(COMMITS)).write.mode("append").parquet(self._path("commits"))

    def _commit_unchanged(self, snapshot_id: int, operation: str, *, schema_id: int, total: int) -> None:
        row = (snapshot_id, None, operation, schema_id, 0, 0, total, None)
        self._commit(one_row(self.spark, T.StructType.fromDDL(COMMITS), row))

    def _log_change(self, op: str, name: str, column_type: str | None, comment: str | None) -> None:
        row = (self._history().latest_id + 1, op, name, column_type, comment)
        self._append(self._path("schema_log"), CHANGE, row)

    # -- state --------------------------------------------------------------

    def _live_parts(self, upto: int | None = None) -> tuple[int, list[Row]]:
        """The newest commit, and for every bucket its newest committed copy.

        Collects at most one row per bucket, and one for commits that wrote none.
        """
        commits = self._commits()
        if upto is not None:
            commits = commits.where(col("snapshot_id") <= upto)
        written = commits.select(
            "snapshot_id",
            "schema_id",
            F.size("parts").alias("parts"),
            F.explode_outer("parts").alias(BUCKET, "row_count"),
        )
        newest = F.max_by(F.struct("snapshot_id", "schema_id", "parts", "row_count"), "snapshot_id")
        found = written.groupBy(BUCKET).agg(newest.alias("p")).select(BUCKET, "p.*").collect()
        last = max((r.snapshot_id for r in found), default=0)
        return last, [r for r in found if r[BUCKET] is not None]

    def _state(self, upto: int | None, history: SchemaHistory, schema_id: int) -> DataFrame:
        rows = self._read(self._live_parts(upto)[1], history, schema_id)
        fields = history.at(schema_id).fields
        return rows.select(*[col(f.name).alias(f.name, metadata=f.metadata or {}) for f in fields])

    def _folders(self, parts: Iterable[Row]) -> dict[int, list[str]]:
        """Folders of the given bucket copies by the schema they were written with; a snapshot all of
        whose buckets are wanted is one folder."""
        by_snapshot, by_schema = defaultdict(list), defaultdict(list)
        for part in parts:
            by_snapshot[part.snapshot_id].append(part)
        for snapshot_id, members in by_snapshot.items():
            folder = f"{self._path('data')}/{SNAPSHOT}={snapshot_id}"
            whole = len(members) == members[0].parts
            paths = [folder] if whole else [f"{folder}/{BUCKET}={m[BUCKET]}" for m in members]
            by_schema[members[0].schema_id] += paths
        return by_schema

    def _read(self, parts: Iterable[Row], history: SchemaHistory, schema_id: int) -> DataFrame:
        """Rows of the given bucket copies, with their bucket, in one schema.

        Copies are scanned together per schema they were written with: the number
        of scans follows the schema changes, not the commits.
        """
        wanted = T.StructType([*history.at(schema_id).fields, T.StructField(BUCKET, T.IntegerType())])
        frames = [
            history.replay(self._scan(paths, history.at(written_with)), written_with, schema_id)
            for written_with, paths in sorted(self._folders(parts).items())
        ]
        if not frames:
            return empty_frame(self.spark, wanted)
        return reduce(DataFrame.unionByName, [f.select(*cols(wanted.names)) for f in frames])

    def _scan(self, paths: list[str], schema: T.StructType) -> DataFrame:
        folders = [T.StructField(BUCKET, T.IntegerType()), T.StructField(SNAPSHOT, T.LongType())]
        stored = T.StructType([*schema.fields, *folders])
        reader = self.spark.read.schema(stored).option("basePath", self._path("data"))
        return reader.parquet(*paths).drop(SNAPSHOT)
