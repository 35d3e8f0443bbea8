"""SimHash near-dedup: fingerprints, pivot distance tables and connected components."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, islice, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from silverline.llm.common import LAST_ID, materialise
from silverline.llm.components import connected_components
from silverline.llm.tokens import small

BITS = 64
#: Bytes of a text that are cut into words at once, and shingles that are counted at once.
PIECE, SHINGLES = 1 << 22, 1 << 14
#: Reference fingerprints that distances are precomputed to.
PIVOTS = np.random.default_rng(64).integers(0, 2**64, 16, dtype=np.uint64)
#: Fingerprints compared with each other in one task at most; larger groups are linked another way.
GROUP = 2048


def shingles(text: bytes, n: int) -> Iterator[bytes]:
    """Runs of n words in lower case, joined by spaces; of fewer words the one run of all."""
    held, at, some = [], 0, False
    while at < len(text):
        end = at + PIECE
        while end < len(text) and not text[end : end + 1].isspace():
            end += 1
        held += text[at:end].lower().split()
        if len(held) >= n:
            some = True
            yield from map(b" ".join, zip(*(held[i:] for i in range(n))))
            held = held[len(held) - n + 1 :]
        at = end
    if held and not some:
        yield b" ".join(held)


def fingerprint(text: bytes, n: int) -> int:
    """A bit is 1 if it is set in over half of the shingles' 64-bit hashes; no words give zero."""
    hashes = map(xxh64_intdigest, shingles(text, n), repeat(42))
    ones, total = np.zeros(BITS, np.int64), 0
    while len(some := np.fromiter(islice(hashes, SHINGLES), np.uint64)):
        bits = np.unpackbits(some.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.uint32)
        total += len(some)
    return int(np.packbits(2 * ones > total, bitorder="little").view(np.uint64)[0])


def _fingerprints(batches: Iterator[pa.RecordBatch], n: int) -> Iterator[pa.RecordBatch]:
    for batch in small(batches):
        prints = [fingerprint((t.as_py() or "").encode(), n) for t in batch.column("text")]
        prints = np.array(prints, np.uint64).view(np.int64)
        yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("row"), pa.array(prints)], ["id", "row", "fp"])


def _links(prints: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that hold the components of one group together: each print with the first one of its component.

    Pairs are discarded if any of their precomputed distances to the pivots differ by more than `distance`;
    the others are verified.
    """
    table = np.bitwise_count(prints[:, None] ^ PIVOTS).astype(np.int8)
    order = np.argsort(table[:, 0], kind="stable")
    prints, table = prints[order], table[order]
    ends = np.searchsorted(table[:, 0], table[:, 0] + distance, side="right")
    left, right = [], []
    for at in range(0, len(prints), 256):
        rows = np.arange(at, min(at + 256, len(prints)))
        cols = np.arange(at, ends[rows[-1]])
        near = cols > rows[:, None]
        for p in range(len(PIVOTS)):
            near &= np.abs(table[rows, None, p] - table[None, cols, p]) <= distance
        i, j = np.nonzero(near)
        i, j = rows[i], cols[j]
        true = np.bitwise_count(prints[i] ^ prints[j]) <= distance
        left.append(i[true])
        right.append(j[true])
    left, right = np.concatenate(left), np.concatenate(right)
    label, before = np.arange(len(prints)), None
    while before is None or (label != before).any():
        before = label.copy()
        low = np.minimum(label[left], label[right])
        np.minimum.at(label, left, low)
        np.minimum.at(label, right, low)
        label = label[label]
    linked = np.flatnonzero(label != np.arange(len(prints)))
    return prints[linked], prints[label[linked]]


def _group_links(batches: Iterator[pa.RecordBatch], distance: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        us, vs = [], []
        for group in batch.column("fps"):
            u, v = _links(group.values.to_numpy(zero_copy_only=False).view(np.uint64), distance)
            us.append(u.view(np.int64))
            vs.append(v.view(np.int64))
        none = [np.zeros(0, np.int64)]
        yield pa.RecordBatch.from_pydict({"u": np.concatenate(us or none), "v": np.concatenate(vs or none)})


def _blocks(parts: int) -> list[int]:
    """All bits in `parts` blocks of near equal size."""
    cuts = [BITS * k // parts for k in range(parts + 1)]
    return [sum(1 << i for i in range(a, b)) for a, b in zip(cuts, cuts[1:])]


def _signed(mask: int) -> int:
    return mask - 2**64 if mask >= 2**63 else mask


def _ball(radius: int) -> Column:
    """All ways to flip up to `radius` bits, as one constant array of masks."""
    masks = [sum(1 << b for b in bits) for r in range(radius + 1) for bits in combinations(range(BITS), r)]
    return F.split(F.lit(",".join(str(_signed(m)) for m in masks)), ",").cast("array<bigint>")


def _dense_links(prints: DataFrame, distance: int) -> DataFrame:
    """Links of prints that stand so close that comparing them in groups would take too long.

    Two prints differ in up to `distance` bits if, and only if, some value lies within half the distance of one
    and the rest of it of the other. So all prints around such a value are linked to the least of those close to it. A value has a
    bounded number of prints around it, and a print a bounded number of values: work grows with the prints, not with their pairs.
    """
    around = lambda r: prints.select("fp", F.explode(F.transform(_ball(r), lambda m: F.col("fp").bitwiseXOR(m))).alias("at"))
    close = around(distance // 2).groupBy("at").agg(F.min("fp").alias("v"))
    close = materialise(close, "close")
    links = around(distance - distance // 2).join(close.hint("merge"), "at").where("fp <> v")
    return links.select(F.col("fp").alias("u"), "v").distinct()


def fingerprint_links(prints: DataFrame, *, distance: int = 3, group: int = GROUP) -> DataFrame:
    """Links (u, v) that hold together all fingerprints `fp` that are linked by `distance` or fewer differing bits.

    `prints` has each fingerprint once. Candidates: two prints that differ in `distance` bits agree on all of
    at least three of `distance` + 3 blocks of bits, so they meet under one of the keys that three blocks make
    (20 keys of some 32 bits for a distance of 3). Under a key, pivot distances discard pairs and the others
    are verified; a group yields a forest, not all its pairs. Prints under a key that has more than `group` of
    them are linked with each other by the values around them instead, so no group is cut and no link is lost.
    """
    masks = [_signed(sum(c)) for c in combinations(_blocks(distance + 3), 3)]
    keyed = prints.withColumn("mask", F.explode(F.array(*map(F.lit, masks))))
    keyed = keyed.select("fp", "mask", F.col("fp").bitwiseAND(F.col("mask")).alias("key"))
    counts = keyed.groupBy("mask", "key").agg(F.count("*").alias("n")).where("n > 1")
    # Stored, so that the join shuffles both sides for itself and Spark can split a hot key.
    keyed = materialise(keyed.join(materialise(counts, "counts"), ["mask", "key"]), "keys")
    small = keyed.where(F.col("n") <= group).groupBy("mask", "key").agg(F.collect_list("fp").alias("fps"))
    links = small.select("fps").mapInArrow(lambda batches: _group_links(batches, distance), "u long, v long")
    dense = materialise(keyed.where(F.col("n") > group).select("fp").distinct(), "dense")
    return materialise(links.union(_dense_links(dense, distance)).distinct(), "links")


def near_duplicates(
    docs: DataFrame, *, shingle: int = 3, distance: int = 3, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Group documents whose SimHash fingerprints are linked, directly or through others.

    Words are runs without ASCII white space, A-Z in lower case; `shingle` of them, joined by spaces, are
    hashed (XXH64, seed 42, of the UTF-8 bytes), repeats included. A text of fewer words is one shingle;
    null, empty and blank texts have fingerprint zero and are linked like any other.

    Returns a row per document: `id` (LAST_ID for a missing one, so that it ranks last), `row` (a hash of the
    text), `fp` (long), `component` (the smallest id in its group). Ids may repeat; other columns are ignored; a table
    without rows gives none.

    Texts are read once and not shuffled. Fingerprints are reduced to distinct ones before anything is compared,
    so copies cost one row per task.
    """
    text = F.col(text_col)
    rows = docs.select(
        F.coalesce(F.col(id_col).cast("long"), F.lit(LAST_ID)).alias("id"), F.xxhash64(text).alias("row"), text.alias("text")
    )
    rows = rows.mapInArrow(lambda batches: _fingerprints(batches, shingle), "id long, row long, fp long")
    rows = materialise(rows, "fingerprints")
    prints = materialise(rows.groupBy("fp").agg(F.min("id").alias("least")), "prints")
    linked = connected_components(fingerprint_links(prints.select("fp"), distance=distance))
    linked = prints.join(linked, F.col("fp") == F.col("u"))
    least = linked.groupBy("root").agg(F.min("least").alias("component"))
    labels = linked.join(least, "root").select("fp", "component")
    labels = prints.join(labels, "fp", "left").select("fp", F.coalesce("component", "least").alias("component"))
    return rows.join(materialise(labels, "labels"), "fp").select("id", "row", "fp", "component")


def drop_near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """Keep, of each group of `near_duplicates`, the document with the smallest id, whole and with all its columns.

    Rows that repeat this id with other texts go to the text that comes first by hash, and of equal rows one is kept;
    where no row of a group has an id, the same rule picks one row. Options, null values and empty tables as in `near_duplicates`.
    """
    found = near_duplicates(docs, id_col=id_col, text_col=text_col, **options)
    keep = found.where("id = component").groupBy("component", "fp").agg(F.min("row").alias("row"))
    keep = keep.groupBy("component").agg(F.min("row").alias("row")).select(F.col("component").alias("id"), "row")
    rows = docs.select(
        F.struct(*docs.columns).alias("whole"),
        F.coalesce(F.col(id_col).cast("long"), F.lit(LAST_ID)).alias("id"),
        F.xxhash64(text_col).alias("row"),
    )
    one = Window.partitionBy("id", "row").orderBy("id")
    kept = rows.join(keep, ["id", "row"], "left_semi").withColumn("n", F.row_number().over(one)).where("n = 1")
    return kept.select("whole.*")
