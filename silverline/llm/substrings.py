"""Substring dedup: FM-indexes of the passages that documents may share, and what they find in streamed documents."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from silverline.llm.common import LAST_ID, materialise
from silverline.llm.fm_index import FMIndex
from silverline.llm.tokens import Grams, hash_words, small, text_chunks

#: Words of an anchor; words in an index shard; segments of an anchor that may share a shard.
ANCHOR, SHARD_WORDS, HOT = 10, 250_000, 2_000
#: Segments that a task returns at once.
ROWS_OUT = 1 << 12


def anchors(hashes: np.ndarray, row_of: np.ndarray, window: int, size: int) -> tuple[np.ndarray, ...]:
    """Runs of windows with the same anchor: first window, number of windows, and the anchor's hash.

    A window's anchor is the least hash among its runs of `size` words, the first on a tie, so equal windows
    have equal anchors wherever they stand.
    """
    grams = Grams(hashes).all(size)
    span = window - size + 1
    n = len(hashes) - window + 1
    if n <= 0:
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(0, np.uint64)
    best, reach = np.arange(len(grams)), 1
    while reach < span:
        step = min(reach, span - reach)
        left, right = best[: len(best) - step], best[step:]
        best = np.where(grams[right] < grams[left], right, left)
        reach += step
    best = best[:n]
    inside = row_of[:n] == row_of[window - 1 :]
    new = np.ones(n, bool)
    new[1:] = (best[1:] != best[:-1]) | ~inside[:-1] | ~inside[1:]
    first = np.flatnonzero(new & inside)
    # A run ends before the next one, or where windows leave their text.
    ends = np.append(np.flatnonzero(new), n)
    count = ends[np.searchsorted(ends, first, side="right")] - first
    return first, count, grams[best[first]]


def _find_anchors(batches: Iterator[pa.RecordBatch], window: int, size: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, rows = batch.column("id").to_numpy(), batch.column("row").to_numpy()
        for texts in text_chunks(batch.column("text")):
            first, count, anchor = anchors(texts.hashes, texts.row_of, window, size)
            owner = texts.row_of[first]
            segment = Grams(texts.hashes).of(first, first + count + window - 1)
            yield pa.RecordBatch.from_pydict(
                {
                    "anchor": anchor.view(np.int64),
                    "segment": segment.view(np.int64),
                    "id": ids[texts.rows.start + owner],
                    "row": rows[texts.rows.start + owner],
                    "first": (first - texts.first[owner]).astype(np.int32),
                    "n": count.astype(np.int32),
                }
            )


def _cut_segments(batches: Iterator[pa.RecordBatch], window: int, shards: int) -> Iterator[pa.RecordBatch]:
    """The words of the wanted segments, each with the shard that it goes to.

    Segments go whole, by anchor; those of a hot anchor are cut into windows that go by their own hash.
    """
    names = ["shard", "anchor", "segment", "at", "piece", "hot", "again", "id", "words"]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.bool_(), pa.bool_(), pa.int64(), pa.string()]
    out: list[tuple] = []

    def flush():
        columns = zip(*out) if out else [[]] * len(names)
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    for batch in small(batches):
        docs = zip(*(batch.column(c).to_pylist() for c in ("id", "again")), batch.column("text"), batch.column("wanted"))
        for doc, again, text, wanted in docs:
            data = text.as_py().encode()
            starts, ends, hashes = hash_words(data)
            grams = Grams(hashes).all(window).view(np.int64)
            for w in wanted.as_py():
                pieces = [(0, w["n"], w["segment"], w["anchor"])]
                if w["hot"]:
                    own = grams[w["first"] : w["first"] + w["n"]].tolist()
                    pieces = [(k, 1, h, h) for k, h in enumerate(own)]
                for at, n, piece, key in pieces:
                    a = w["first"] + at
                    words = b" ".join(
                        data[i:j] for i, j in zip(starts[a : a + n + window - 1], ends[a : a + n + window - 1])
                    )
                    out.append((key % shards, w["anchor"], w["segment"], at, piece, w["hot"], again, doc, words))
                if len(out) >= ROWS_OUT:
                    yield flush()
                    out = []
    yield flush()


def _search_shard(table: pa.Table, window: int) -> pa.Table:
    """Index the distinct passages of a shard, stream all of them through it, and tell where each window first is."""
    words = table.column("words").combine_chunks()
    ids = table.column("id").to_numpy()
    starts, _, hashes = [], [], []
    size = []
    for texts in text_chunks(words):
        hashes.append(texts.hashes)
        size.append(np.diff(texts.first))
    hashes, size = np.concatenate(hashes), np.concatenate(size)
    symbols = np.unique(hashes, return_inverse=True)[1] + 1
    first = np.cumsum(size) - size
    # Equal passages are indexed once, with the least id.
    whole = Grams(hashes).of(first, first + size)
    order = np.lexsort((ids, whole))
    distinct = order[np.append(True, whole[order][1:] != whole[order][:-1])]
    room = size[distinct] + 1
    text = np.zeros(room.sum(), np.int64)
    into = np.cumsum(room) - room
    within = np.arange(size[distinct].sum()) - np.repeat(np.cumsum(size[distinct]) - size[distinct], size[distinct])
    text[np.repeat(into, size[distinct]) + within] = symbols[np.repeat(first[distinct], size[distinct]) + within]
    index = FMIndex(text, np.repeat(ids[distinct], room), window)
    least = index.least_owner(symbols, first, size, LAST_ID)
    windows = size - window + 1
    at = np.repeat(first, windows) + np.arange(windows.sum()) - np.repeat(np.cumsum(windows) - windows, windows)
    offsets = np.concatenate(([0], np.cumsum(windows))).astype(np.int32)
    found = pa.ListArray.from_arrays(pa.array(offsets), pa.array(least[at]))
    return table.select(["anchor", "piece"]).append_column("least", found)


def _remove(batches: Iterator[pa.RecordBatch], text_col: str, window: int) -> Iterator[pa.RecordBatch]:
    """Take out the words that repeated windows cover."""
    for batch in small(batches):
        n_words, spans, kept = [], [], []
        for text, found in zip(batch.column("whole").field(text_col), batch.column("starts")):
            data = (text.as_py() or "").encode()
            if not found.is_valid:
                words = data.split()
                n_words.append(len(words))
                spans.append([])
                kept.append(b" ".join(words))
                continue
            starts, ends, _ = hash_words(data)
            edge = np.zeros(len(starts) + 1, np.int64)
            for run in found.as_py():
                edge[run["first"]] += 1
                edge[run["first"] + run["n"] + window - 1] -= 1
            gone = np.cumsum(edge[:-1]) > 0
            change = np.flatnonzero(np.diff(gone.view(np.int8), prepend=np.int8(0), append=np.int8(0)))
            n_words.append(len(starts))
            spans.append([{"word": int(a), "end": int(b)} for a, b in zip(change[::2], change[1::2])])
            stay = np.flatnonzero(~gone)
            kept.append(b" ".join(data[i:j] for i, j in zip(starts[stay].tolist(), ends[stay].tolist())))
        span = pa.struct([("word", pa.int64()), ("end", pa.int64())])
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("whole"),
                pa.array(n_words, pa.int64()),
                pa.array(spans, pa.list_(span)),
                pa.array(kept, pa.string()),
            ],
            ["whole", "n_words", "removed", "kept"],
        )


def dedup_substrings(
    docs: DataFrame,
    *,
    window: int = 50,
    anchor: int = ANCHOR,
    shard_words: int = SHARD_WORDS,
    hot: int = HOT,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Remove passages of at least `window` words (2 to 63; others are a ValueError) that also stand in a document with a smaller id.

    Words are runs without ASCII white space, compared unchanged. A word goes if it lies in a window of `window` words
    whose words also stand, in this order, in a document with a smaller id, judged on the input.
    Returns `whole` (the input row as a struct, so names cannot clash), `n_words`, `removed` (array of word, end: what was
    taken out, merged and sorted) and `kept` (the other words, joined by one space).

    Null and empty texts have no words. A missing id ranks after all others. Rows that repeat an id
    do not take passages from each other, nor does a passage that repeats within a document. Other columns
    do not matter; a table without rows gives none.

    Each window belongs to the shard of its anchor, so that documents are not streamed through all indexes but each
    passage through the one that can hold its match. Anchors that only one id has are dropped first. What is left
    is reduced to distinct segments (the windows around one anchor): copies cost one row per task. A shard's
    FM-index gives the matching statistics of the segments streamed through it, capped at the window, and with each
    match the least id that has it. Shards have about `shard_words` words: their number follows from the data, and
    an anchor with more than `hot` segments is dealt out by single windows instead, equal ones reduced to one before.
    Rows that repeat id and text are cut like others, and their passages reduced to one in every task before they meet.
    """
    text = F.col(text_col)
    key = [F.coalesce(F.col(id_col).cast("long"), F.lit(LAST_ID)).alias("id"), F.xxhash64(text).alias("row")]
    rows = docs.select(*key, text.alias("text")).where("text is not null")
    found = rows.mapInArrow(
        lambda batches: _find_anchors(batches, window, anchor),
        "anchor long, segment long, id long, row long, first int, n int",
    )
    found = materialise(found, "anchors")
    shared = found.groupBy("anchor").agg(F.min("id").alias("least"), F.max("id").alias("most")).where("least < most")
    # Stored, so that the join shuffles both sides for itself and Spark can split a hot anchor.
    shared = materialise(shared.select("anchor"), "shared")
    places = materialise(found.join(shared, "anchor"), "places")
    segments = places.groupBy("anchor", "segment").agg(F.min(F.struct("id", "row", "first", "n")).alias("s"))
    segments = materialise(segments.select("anchor", "segment", "s.*"), "segments")
    busy = segments.groupBy("anchor").agg(F.count("*").alias("m"), F.sum("n").alias("k")).where(F.col("m") > hot)
    busy = materialise(busy, "busy")
    words = segments.agg(F.sum(F.col("n") + window - 1)).first()[0] or 0
    words += (busy.agg(F.sum("k")).first()[0] or 0) * window
    shards = max(1, -(-words // shard_words))
    wanted = (
        segments.join(busy.select("anchor", F.lit(True).alias("hot")), "anchor", "left")
        .withColumn("hot", F.coalesce("hot", F.lit(False)))
        .groupBy("id", "row")
        .agg(F.collect_list(F.struct("first", "n", "anchor", "segment", "hot")).alias("wanted"))
    )
    # Every text that has a window has one at its first word, so these rows count the copies under one id.
    copies = found.where("first = 0").groupBy("id", "row").agg(F.count("*").alias("copies"))
    wanted = wanted.join(copies, ["id", "row"]).withColumn("again", F.col("copies") > 1)
    cut = rows.join(wanted, ["id", "row"]).select("id", "text", "wanted", "again")
    cut = cut.mapInArrow(
        lambda batches: _cut_segments(batches, window, shards),
        "shard long, anchor long, segment long, at int, piece long, hot boolean, again boolean, id long, words string",
    )
    cut = materialise(cut, "passages", compression="zstd")
    passage = ["shard", "anchor", "piece"]
    plain = cut.where("not hot and not again").select(*passage, "id", "words")
    split = cut.where("hot or again").groupBy(*passage).agg(F.min("id").alias("id"), F.min("words").alias("words"))
    least = plain.union(split).groupBy("shard").applyInArrow(
        lambda table: _search_shard(table, window), "anchor long, piece long, least array<long>"
    )
    least = materialise(least, "least")
    pieces = cut.where("hot").select("anchor", "segment", "at", "piece").distinct().join(least, ["anchor", "piece"])
    whole_ones = least.join(busy.select("anchor"), "anchor", "left_anti")
    least = whole_ones.select("anchor", F.col("piece").alias("segment"), F.lit(0).alias("at"), "least").union(
        pieces.select("anchor", "segment", "at", "least")
    )
    runs = F.when(
        F.forall("least", lambda x: x < F.col("id")),
        F.array(F.struct((F.col("first") + F.col("at")).alias("first"), F.size("least").alias("n"))),
    ).otherwise(
        F.filter(
            F.transform(
                "least",
                lambda x, i: F.when(
                    x < F.col("id"),
                    F.struct((F.col("first") + F.col("at") + i).alias("first"), F.lit(1).alias("n")),
                ),
            ),
            lambda x: x.isNotNull(),
        )
    )
    hits = places.join(least, ["anchor", "segment"]).select("id", "row", runs.alias("runs")).where("size(runs) > 0")
    hits = hits.groupBy("id", "row").agg(F.flatten(F.collect_set("runs")).alias("starts"))
    joined = docs.select(F.struct(*docs.columns).alias("whole"), *key)
    joined = joined.join(hits, ["id", "row"], "left").select("whole", "starts")
    whole = joined.schema["whole"].dataType.simpleString()
    return joined.mapInArrow(
        lambda batches: _remove(batches, text_col, window),
        f"whole {whole}, n_words long, removed array<struct<word: bigint, end: bigint>>, kept string",
    )
