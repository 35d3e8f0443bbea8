"""Line dedup over levelled sorted runs of line hashes."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from silverline.llm.common import LAST_ID, materialise
from silverline.llm.tokens import small
from silverline.session import scratch_path

#: Hashes of a batch, and the slots that batches are made of.
BATCH_ROWS, SLOTS = 1 << 19, 64
#: Hashes that a task returns at once.
ROWS_OUT = 1 << 16


def line_key(line: bytes, min_chars: int) -> bytes | None:
    """What a line is compared by: stripped of ASCII white space, A-Z in lower case; None if it is too short."""
    key = line.strip().lower()
    if len(key) < min_chars or (len(key) < 4 * min_chars and len(key.decode()) < min_chars):
        return None
    return key


def _hash(key: bytes) -> bytes:
    return xxhash.xxh3_128_digest(key)


def _hash_lines(batches: Iterator[pa.RecordBatch], min_chars: int) -> Iterator[pa.RecordBatch]:
    """Per document each line hash once."""
    ids, rows, hashes = [], [], []

    def out():
        columns = [pa.array(ids, pa.int64()), pa.array(rows, pa.int64()), pa.array(hashes, pa.binary())]
        return pa.RecordBatch.from_arrays(columns, ["id", "row", "h"])

    for batch in batches:
        keys_of = zip(batch.column("id").to_pylist(), batch.column("row").to_pylist(), batch.column("text"))
        for doc, row, text in keys_of:
            keys = (line_key(x, min_chars) for x in (text.as_py() or "").encode().split(b"\n"))
            found = {_hash(k) for k in keys if k is not None}
            ids.extend([doc] * len(found))
            rows.extend([row] * len(found))
            hashes.extend(found)
            if len(ids) > ROWS_OUT:
                yield out()
                ids, rows, hashes = [], [], []
    yield out()


class LineRuns:
    """Levelled sorted runs of the line hashes seen so far, below one folder that all executors share.

    A run holds `h`, `docs` (documents with the line) and `last` (the largest id among them) of the hashes that one batch was the first
    to bring, so a hash is in one run only. Every new batch is merge-anti-joined with the runs: what none of them holds becomes a run
    of level 0, what one of them holds is a repeat and is noted beside them. As soon as a level has `fanout` runs they are
    merged into one run of the next level: n batches leave about fanout * log(n) runs, and each hash is rewritten log(n) times.

    Runs are tables bucketed and sorted by hash: a batch comes dealt out to the merge join, and a level is merged bucket by bucket, without
    an exchange. The hashes of the runs, and nothing else of them, are dealt out to the join of each batch.
    """

    def __init__(self, spark: SparkSession, path: str | None = None, *, fanout: int = 4):
        self.spark, self.fanout = spark, fanout
        self.path = path or scratch_path(spark, "line-runs")
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.name = f"line_runs_{uuid.uuid4().hex}"
        self.levels: list[list[str]] = []
        self.repeats: list[str] = []
        self.written = 0

    def _save(self, rows: DataFrame, folder: str) -> str:
        table = f"{self.name}_{self.written}"
        self.written += 1
        writer = rows.select("h", "docs", "last").write.format("parquet").option("path", f"{self.path}/{folder}/{table}")
        writer.bucketBy(self.buckets, "h").sortBy("h").saveAsTable(table)
        return table

    def _write(self, rows: DataFrame, level: int) -> None:
        table = self._save(rows, f"level-{level}")
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(table)
        if len(self.levels[level]) >= self.fanout:
            full, self.levels[level] = self.levels[level], []
            # no hash is in two runs, so this only merges them, bucket by bucket
            self._write(self._sums(self._all(full)), level + 1)
            self._drop(full)

    def _all(self, tables: list[str]) -> DataFrame:
        return reduce(DataFrame.union, [self.spark.table(t) for t in tables])

    def _drop(self, tables: list[str]) -> None:
        for table in tables:
            self.spark.sql(f"DROP TABLE IF EXISTS {table}")

    @property
    def tables(self) -> list[str]:
        """The runs, oldest level first."""
        return [t for level in reversed(self.levels) for t in level]

    def add(self, lines: DataFrame) -> None:
        """Add a batch of (id, h) rows, one per document and line."""
        stored = self._save(lines.groupBy("h").agg(F.count("*").alias("docs"), F.max("id").alias("last")), "batches")
        batch = self.spark.table(stored)
        if self.tables:
            self.repeats.append(self._save(self._known(batch, "left_semi"), "repeats"))
        self._write(self.unseen(batch), 0)
        self._drop([stored])

    @staticmethod
    def _sums(rows: DataFrame) -> DataFrame:
        return rows.groupBy("h").agg(F.sum("docs").alias("docs"), F.max("last").alias("last"))

    def unseen(self, lines: DataFrame) -> DataFrame:
        """Rows whose hash is in no run yet: one merge-anti-join with the runs."""
        return self._known(lines, "left_anti") if self.tables else lines

    def _known(self, lines: DataFrame, how: str) -> DataFrame:
        return lines.join(self._all(self.tables).select("h").hint("merge"), "h", how)

    def totals(self, least: int = 1) -> DataFrame:
        """(h, docs, last) of every hash that at least `least` documents hold: its run's row and its repeats."""
        if not self.tables:
            return self.spark.createDataFrame([], "h binary, docs long, last long")
        seen = self._all(self.tables)
        if self.repeats:
            again = self._sums(self._all(self.repeats)).select("h", F.col("docs").alias("more"), F.col("last").alias("later"))
            docs = F.col("docs") + F.coalesce("more", F.lit(0))
            seen = seen.join(again, "h", "left").select("h", docs.alias("docs"), F.greatest("last", "later").alias("last"))
        return seen.where(F.col("docs") >= least)

    def close(self) -> None:
        """Forget the tables; their files stay in the scratch folder."""
        self._drop(self.tables + self.repeats)
        self.levels, self.repeats = [], []


def line_hashes(docs: DataFrame, *, min_chars: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (id, row, h): the distinct line hashes of every document, lines of fewer than `min_chars` code
    points left out. `row` is a hash of the text; a missing id becomes the smallest number."""
    rows = docs.select(_id(id_col).alias("id"), F.xxhash64(text_col).alias("row"), F.col(text_col).alias("text"))
    return rows.mapInArrow(lambda batches: _hash_lines(batches, min_chars), "id long, row long, h binary")


def _id(id_col: str):
    return F.coalesce(F.col(id_col).cast("long"), F.lit(-LAST_ID - 1))


def _keep_lines(batches: Iterator[pa.RecordBatch], text_col: str, min_chars: int) -> Iterator[pa.RecordBatch]:
    for batch in small(batches):
        lines, dropped, texts = [], [], []
        for text, drop in zip(batch.column("whole").field(text_col), batch.column("drop")):
            all_lines = (text.as_py() or "").encode().split(b"\n")
            kept = all_lines
            if drop.is_valid:
                gone = set(drop.as_py())
                keys = (line_key(x, min_chars) for x in all_lines)
                kept = [x for x, k in zip(all_lines, keys) if k is None or _hash(k) not in gone]
            lines.append(len(all_lines))
            dropped.append(len(all_lines) - len(kept))
            texts.append(b"\n".join(kept))
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("whole"),
                pa.array(lines, pa.int64()),
                pa.array(dropped, pa.int64()),
                pa.array(texts, pa.string()),
            ],
            ["whole", "n_lines", "n_dropped", "kept"],
        )


def dedup_lines(
    docs: DataFrame,
    *,
    min_chars: int = 40,
    min_docs: int = 5,
    batch_rows: int = BATCH_ROWS,
    fanout: int = 4,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Drop lines that many documents share, everywhere but in the document with the largest id.

    Lines end at newlines; null and empty texts are one empty line. Two lines are the same if they agree without
    ASCII white space at both ends and with A-Z in lower case. Lines of at least `min_chars` code points
    found in at least `min_docs` documents go; all others stay, joined by newlines.

    Returns `whole` (the input row as a struct, so names cannot clash), `n_lines` (before), `n_dropped`, `kept` (the
    text that is left). Each row counts as a document of its own: rows that repeat an id are several documents,
    and all that have the largest id keep the line. A missing id is the smallest of all.

    Line hashes (128 bits) are made once and go into `LineRuns` batch by batch, in the order in which they are stored: about `batch_rows`
    hashes at a time, at most SLOTS batches. A line's row count is summed before every shuffle, so a line that is everywhere costs one row per
    task. What is to be dropped is the join of all hashes with the runs' frequent ones, which Spark splits where a line is hot; it comes back to
    its document by id and text hash, a set no larger than the document's lines. Texts are shuffled once.
    """
    spark = docs.sparkSession
    hashed = line_hashes(docs, min_chars=min_chars, id_col=id_col, text_col=text_col)
    path, seen = scratch_path(spark, "lines"), Observation()
    # a task writes one slot, so there are no more files than tasks
    slotted = hashed.withColumn("slot", F.spark_partition_id() % SLOTS).observe(seen, F.count(F.lit(1)).alias("rows"))
    slotted.write.partitionBy("slot").parquet(path)
    stored = spark.read.schema("id long, row long, h binary, slot int").parquet(path)
    batches = min(SLOTS, max(1, -(-seen.get["rows"] // batch_rows)))
    slots = sorted(r[0] for r in stored.select("slot").distinct().collect())  # SLOTS at most
    runs = LineRuns(spark, fanout=fanout)
    for i in range(batches):
        if mine := slots[i * len(slots) // batches : (i + 1) * len(slots) // batches]:
            runs.add(stored.where(F.col("slot").isin(mine)).select("id", "h"))
    frequent = materialise(runs.totals(min_docs), "frequent")
    runs.close()
    drops = (
        stored.join(frequent, "h")
        .where(F.col("id") < F.col("last"))
        .groupBy("id", "row")
        .agg(F.collect_set("h").alias("drop"))
    )
    rows = docs.select(
        F.struct(*docs.columns).alias("whole"), _id(id_col).alias("id"), F.xxhash64(text_col).alias("row")
    )
    joined = rows.join(drops, ["id", "row"], "left").select("whole", "drop")
    whole = joined.schema["whole"].dataType.simpleString()
    return joined.mapInArrow(
        lambda batches: _keep_lines(batches, text_col, min_chars),
        f"whole {whole}, n_lines long, n_dropped long, kept string",
    )
