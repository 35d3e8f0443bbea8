"""Benchmark decontamination: a prefix-filtered set join of word shingles, verified word by word."""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from silverline.llm.common import materialise
from silverline.llm.tokens import ALNUM, LOWER, Grams, hash_words, small, text_chunks

#: Words of a window, and words of a shingle.
WINDOW, SHINGLE = 13, 5
#: A word, as a regular expression for texts in any case.
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: Bits of the marks for each shingle, and of the marks in all, as a power of two (32 MB).
SPARSE, MARK_BITS = 64, 28
#: Stands in for words that are longer than any word of the benchmark; no word is like it.
TOO_LONG = b"-"


def _item_windows(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    """All windows of each item: its words in lower case, joined by spaces."""
    for batch in batches:
        items, windows = [], []
        for item, text in zip(batch.column("item").to_pylist(), batch.column("text").to_pylist()):
            data = (text or "").encode()
            starts, ends, _ = hash_words(data, ALNUM, LOWER)
            words = [data[a:b].lower() for a, b in zip(starts, ends)]
            found = {b" ".join(words[i : i + window]) for i in range(max(1, len(words) - window + 1))} - {b""}
            items.extend([item] * len(found))
            windows.extend(found)
        yield pa.RecordBatch.from_arrays(
            [pa.array(items, pa.string()), pa.array(windows, pa.binary()).cast(pa.string())], ["item", "w"]
        )


def benchmark_windows(
    benchmark: DataFrame, *, window: int = WINDOW, item_col: str = "item_id", text_col: str = "text"
) -> DataFrame:
    """Rows (w, items): every distinct window of the benchmark with the ids, as strings, of the items that have it.

    An item of fewer than `window` words, but not none, is one window. Rows that repeat an id are one item; a
    missing id counts as an empty string.
    """
    rows = benchmark.select(
        F.coalesce(F.col(item_col).cast("string"), F.lit("")).alias("item"), F.col(text_col).alias("text")
    )
    found = rows.mapInArrow(lambda batches: _item_windows(batches, window), "item string, w string")
    return found.groupBy("w").agg(F.sort_array(F.collect_set("item")).alias("items"))


def _window_shingles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The shingles of each window: of min(n, SHINGLE) words in a window of n, with their hashes and places."""
    for batch in small(batches):
        rows = []
        for i, w in enumerate(batch.column("w").to_pylist()):
            hashes = hash_words(w.encode(), ALNUM, LOWER)[2]
            size = min(len(hashes), SHINGLE)
            rows += [(i, len(hashes), size, h, at) for at, h in enumerate(Grams(hashes).all(size).view(np.int64).tolist())]
        which, n, size, h, place = zip(*rows) if rows else ((),) * 5
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("w").take(pa.array(which, pa.int64())),
                batch.column("set").take(pa.array(which, pa.int64())),
                *(pa.array(x, pa.int32()) for x in (n, size, place)),
                pa.array(h, pa.int64()),
            ],
            ["w", "set", "n", "size", "place", "h"],
        )


class Marks:
    """Two bits for each of some hashes: rules out most others by two looks, and none of these.

    Holds SPARSE bits for each hash up to 2**`most` bits, so its size is bounded whatever the number of hashes; with fewer bits
    more strangers pass, which the join after it drops.
    """

    def __init__(self, hashes: DataFrame, most: int):
        count = hashes.count()
        self.bits = min(max(6, (SPARSE * count).bit_length()), most)
        places = F.array(F.shiftrightunsigned("h", 64 - self.bits), F.col("h").bitwiseAND((1 << self.bits) - 1))
        words = hashes.select(F.explode(places).alias("p")).groupBy(F.expr("p div 64").alias("at"))
        words = words.agg(F.bit_or(F.expr("shiftleft(1L, cast(p % 64 as int))")).alias("mask")).toArrow()
        self.words = np.zeros(1 << (self.bits - 6), np.uint64)
        self.words[words.column("at").to_numpy()] = words.column("mask").to_numpy().view(np.uint64)

    def _marked(self, places: np.ndarray) -> np.ndarray:
        return (self.words[places >> np.uint64(6)] >> (places & np.uint64(63))) & np.uint64(1) == 1

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """Positions of the hashes that are marked."""
        at = np.flatnonzero(self._marked(hashes >> np.uint64(64 - self.bits)))
        return at[self._marked(hashes[at] & np.uint64((1 << self.bits) - 1))]


def _marked_shingles(texts, marks: Marks, sizes: list[int]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """By shingle length, the hashes of the marked shingles that lie within one text, and the words they start at."""
    grams = Grams(texts.hashes)
    for size in sizes:
        hashes = grams.all(size)
        at = marks.find(hashes)
        at = at[texts.row_of[at] == texts.row_of[at + size - 1]]
        yield size, hashes[at], at


def _count(batches: Iterator[pa.RecordBatch], sizes: list[int], shared) -> Iterator[pa.RecordBatch]:
    """How often marked shingles occur in some documents."""
    marks: Marks = pickle.loads(shared.value)
    for batch in batches:
        for texts in text_chunks(batch.column("text"), ALNUM, LOWER):
            for size, hashes, _ in _marked_shingles(texts, marks, sizes):
                found, times = np.unique(hashes, return_counts=True)
                yield pa.RecordBatch.from_pydict(
                    {"size": np.full(len(found), size, np.int32), "h": found.view(np.int64), "times": times.astype(np.int64)}
                )


def _candidates(
    batches: Iterator[pa.RecordBatch], sizes: list[int], window: int, longest: int, shared
) -> Iterator[pa.RecordBatch]:
    """Marked shingles of documents with the words around them, as far as a window could reach."""
    marks: Marks = pickle.loads(shared.value)
    for batch in small(batches):
        for texts in text_chunks(batch.column("text"), ALNUM, LOWER):
            first = texts.first.tolist()
            rows, at_word, before, around, kinds, prints = [], [], [], [], [], []
            for size, hashes, words in _marked_shingles(texts, marks, sizes):
                kinds += [size] * len(words)
                prints.append(hashes.view(np.int64))
                for at in words.tolist():
                    row = int(texts.row_of[at])
                    begin, end = max(first[row], at - window + size), min(first[row + 1], at + window)
                    spans = zip(texts.starts[begin:end].tolist(), texts.ends[begin:end].tolist())
                    around.append(b" ".join(texts.data[a:b].lower() if b - a <= longest else TOO_LONG for a, b in spans))
                    rows.append(texts.rows[row])
                    at_word.append(at - first[row])
                    before.append(at - begin)
            rows = pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("t0").take(rows),
                    batch.column("t1").take(rows),
                    pa.array(kinds, pa.int32()),
                    pa.array(np.concatenate(prints) if prints else [], pa.int64()),
                    pa.array(at_word, pa.int64()),
                    pa.array(before, pa.int32()),
                    pa.array(around, pa.binary()).cast(pa.string()),
                ],
                ["t0", "t1", "size", "h", "word", "before", "around"],
            )


def _merged(found: DataFrame, key: list[str]) -> DataFrame:
    """Spans (word, end) that overlap or touch as one, as a sorted array `spans` for each key."""
    ahead = Window.partitionBy(*key).orderBy("word", "end")
    reach = F.max("end").over(ahead.rowsBetween(Window.unboundedPreceding, -1))
    opens = F.coalesce(F.col("word") > reach, F.lit(True)).cast("int")
    runs = found.select(*key, "word", "end").distinct().withColumn("opens", opens)
    runs = runs.withColumn("run", F.sum("opens").over(ahead.rowsBetween(Window.unboundedPreceding, 0)))
    runs = runs.groupBy(*key, "run").agg(F.min("word").alias("word"), F.max("end").alias("end"))
    return runs.groupBy(*key).agg(F.sort_array(F.collect_list(F.struct("word", "end"))).alias("spans"))


SPANS = "array<struct<word: bigint, end: bigint>>"


def find_contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    *,
    window: int = WINDOW,
    one_in: int = 20,
    mark_bits: int = MARK_BITS,
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """Find benchmark passages in documents.

    Texts are compared by words: runs of digits, A-Z in lower case and everything beyond ASCII. An item's windows are its runs of
    `window` words, or the whole item if it has fewer. Returns `whole` (the input row as a struct, so names cannot clash),
    `n_words`, `spans` (words from and to, merged and sorted, that lie in an occurrence of a window), `n_hit` (words in them),
    `items` (ids of the items with occurring windows, as strings, sorted), `contaminated`: at least one word is hit, and
    at least one in `one_in`. A null or empty text has no words. Null item texts and empty ones have no
    windows; null item ids read as ''. Rows that repeat are judged one by one; empty tables are fine.

    A window is the set of its shingles of SHINGLE words (fewer in shorter windows). All occurrences of these shingles in the
    corpus are counted, a window's shingles ordered by rarity, and, because all of them must be there, the rarest alone is the
    prefix that is joined. Candidates must leave room for the window, and are compared word by word.

    The benchmark stays a table: documents are read once to count and once to find, whatever its size, and tasks hold only
    marks of its shingles, of at most 2**`mark_bits` bits. Shingles that pass them are joined with the windows by hash, with
    the words around them; Spark splits a hot shingle. Findings belong to a text (its two hashes), so copies share them. A
    window's item ids are kept once for all windows with the same ids.
    """
    spark = docs.sparkSession
    windows = benchmark_windows(benchmark, window=window, item_col=item_col, text_col=item_text_col)
    windows = materialise(windows.withColumn("set", F.sha2(F.to_json("items"), 256)), "windows")
    shingles = windows.select("w", "set").mapInArrow(
        _window_shingles, "w string, set string, n int, size int, place int, h long"
    )
    shingles = materialise(shingles, "shingles")
    sizes = sorted(r.size for r in shingles.select(F.col("size").alias("size")).distinct().collect())
    longest = windows.agg(F.max(F.octet_length("w"))).first()[0] or 0

    text = F.col(text_col)
    keys = F.xxhash64(F.coalesce(text, F.lit(""))), F.xxhash64(F.lit(7), F.coalesce(text, F.lit("")))
    texts = docs.select(keys[0].alias("t0"), keys[1].alias("t1"), text.alias("text")).where("text <> ''")
    shared = spark.sparkContext.broadcast(cloudpickle.dumps(Marks(shingles.select("h").distinct(), mark_bits)))
    counts = texts.select("text").mapInArrow(
        lambda batches: _count(batches, sizes, shared), "size int, h long, times long"
    )
    counts = materialise(counts.groupBy("size", "h").agg(F.sum("times").alias("times")), "counts")
    # A window with a shingle that occurs nowhere occurs nowhere.
    counted = shingles.join(counts, ["size", "h"], "left").withColumn("times", F.coalesce("times", F.lit(0)))
    rarest = counted.groupBy("w", "set", "n", "size").agg(F.min(F.struct("times", "place", "h")).alias("r")).where("r.times > 0")
    rarest = materialise(rarest.select("w", "set", "n", "size", "r.place", "r.h"), "rarest")

    fewer = spark.sparkContext.broadcast(cloudpickle.dumps(Marks(rarest.select("h").distinct(), mark_bits)))
    near = texts.mapInArrow(
        lambda batches: _candidates(batches, sizes, window, longest, fewer),
        "t0 long, t1 long, size int, h long, word long, before int, around string",
    )
    # Length and positional bounds before the words themselves.
    words = F.split("around", " ")
    room = (F.col("before") >= F.col("place")) & (F.size(words) - F.col("before") >= F.col("n") - F.col("place"))
    there = F.array_join(F.slice(words, F.greatest(F.col("before") - F.col("place") + 1, F.lit(1)), F.col("n")), " ") == F.col("w")
    begin = F.col("word") - F.col("place")
    found = near.join(rarest, ["size", "h"]).where(room).where(there)
    found = found.select("t0", "t1", begin.alias("word"), (begin + F.col("n")).alias("end"), "set").distinct()
    found = materialise(found, "found")

    key = ["t0", "t1"]
    sets = windows.select("set", "items").dropDuplicates(["set"])
    listed = found.select(*key, "set").distinct().join(sets, "set").select(*key, F.explode("items").alias("item"))
    listed = listed.groupBy(*key).agg(F.sort_array(F.collect_set("item")).alias("items"))
    findings = materialise(_merged(found, key).join(listed, key), "findings")

    n_words = F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")
    rows = docs.select(F.struct(*docs.columns).alias("whole"), n_words.alias("n_words"), keys[0].alias("t0"), keys[1].alias("t1"))
    out = rows.join(findings, key, "left").select(
        "whole",
        "n_words",
        F.coalesce("spans", F.expr(f"cast(array() as {SPANS})")).alias("spans"),
        F.coalesce("items", F.expr("cast(array() as array<string>)")).alias("items"),
    )
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda s, x: s + x["end"] - x["word"])
    return out.select("whole", "n_words", "spans", hit.alias("n_hit"), "items").withColumn(
        "contaminated", (F.col("n_hit") > 0) & (F.col("n_hit") * one_in >= F.col("n_words"))
    )
