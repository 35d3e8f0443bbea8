"""Mixing sources to target weights: packed blocks, drawn by pseudorandom permutations."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce
from operator import and_

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from silverline.llm.common import WORD, materialise, partitions, running_total
from silverline.llm.tokens import hash_words, small

#: Rounds of the permutation network, and the constants that mix each round.
ROUNDS, MIX = 6, (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9)
#: Slots that one row of the slot table stands for before it is spread out.
SLOTS_PER_ROW = 1 << 13
#: Slots that a task draws.
SLOTS_PER_TASK = 1 << 20
#: Copies of one row that are made at once.
COPIES = 10_000


def _round(half: np.ndarray, seed: np.ndarray, i: int) -> np.ndarray:
    x = (half ^ (seed + np.uint64(i * MIX[0] % 2**64))) * np.uint64(MIX[1])
    x ^= x >> np.uint64(31)
    return (x * np.uint64(MIX[0])) >> np.uint64(29)


def permute(index: np.ndarray, size: int, seed: np.ndarray, back: bool = False) -> np.ndarray:
    """Where each index lands under the pseudorandom permutation of range(size) that its seed chooses;
    `back` inverts. A Feistel network over an even number of bits, walked until values are below `size`."""
    bits = np.uint64(max(1, -(-(size - 1).bit_length() // 2)))
    mask = (np.uint64(1) << bits) - np.uint64(1)
    seed = np.broadcast_to(seed, index.shape).astype(np.uint64)
    out, walk = index.astype(np.uint64), np.arange(len(index))
    while len(walk):
        left, right = out[walk] >> bits, out[walk] & mask
        for i in reversed(range(ROUNDS)) if back else range(ROUNDS):
            if back:
                left, right = right ^ (_round(left, seed[walk], i) & mask), left
            else:
                left, right = right, left ^ (_round(right, seed[walk], i) & mask)
        out[walk] = (left << bits) | right
        walk = walk[out[walk] >= size]
    return out.astype(np.int64)


def _seeds(seed: int, source_id: int, turn: np.ndarray) -> np.ndarray:
    return np.uint64((seed * 1_000_003 + source_id * 7919) % 2**62) + turn.astype(np.uint64) * np.uint64(2**40 + 15)


def _count_slots(batches: Iterator[pa.RecordBatch], block: int, seed: int) -> Iterator[pa.RecordBatch]:
    """Per source the slots it needs, and the words that the last one takes.

    Whole passes take every block once. In the last pass all blocks are full but the source's last one, whose
    place the inverse permutation tells.
    """
    for batch in batches:
        out = []
        for r in batch.to_pylist():
            size, wanted = r["source_size"], round(r["target"])
            per_pass = -(-size // block)
            turns, rest = divmod(wanted, size) if size else (0, 0)
            slots, cut = turns * per_pass, block
            if rest:
                turn = np.array([turns])
                at = permute(np.array([per_pass - 1]), per_pass, _seeds(seed, r["source_id"], turn), back=True)[0]
                lacks = per_pass * block - size
                more = -(-rest // block)
                if at < more and more * block - lacks < rest:
                    more += 1
                cut = rest - ((more - 1) * block - (lacks if at < more - 1 else 0))
                slots += more
            out.append(r | {"slots": slots, "cut": cut})
        added = [pa.field("slots", pa.int64()), pa.field("cut", pa.int64())]
        yield pa.RecordBatch.from_pylist(out, schema=pa.schema([*batch.schema, *added]))


def _draw(batches: Iterator[pa.RecordBatch], block: int, seed: int) -> Iterator[pa.RecordBatch]:
    """Slots first to first + n of a source: shard, block and words taken of each.

    In each pass over a source its slots follow a permutation of its blocks. The last pass ends with the slot in which
    the target is reached; that slot takes only the words that are missing.
    """
    for batch in batches:
        for r in batch.to_pylist():
            slot = np.arange(r["first"], r["first"] + r["n"], dtype=np.int64)
            per_pass = -(-r["source_size"] // block)
            turn, index = slot // per_pass, slot % per_pass
            number = permute(index, per_pass, _seeds(seed, r["source_id"], turn))
            took = np.minimum(block, r["source_size"] - number * block)
            last = slot == r["slots"] - 1
            took[last] = np.minimum(took[last], r["cut"])
            place = permute(slot + r["offset"], r["all_slots"], np.uint64(seed))
            yield pa.RecordBatch.from_pydict(
                {
                    "source_id": np.full(len(slot), r["source_id"], np.int64),
                    "turn": turn.astype(np.int32),
                    "block": number,
                    "took": took,
                    "place": place,
                }
            )


def source_targets(
    sizes: DataFrame, weights: Sequence[float] = (3, 1, 2), share: float = 1.5, limit: float = 2.0
) -> DataFrame:
    """Targets of sources: (source, source_id, source_size, target) from rows (source, size).

    Sources weigh `weights` in the order of their code points, null last, again from the start when they run
    out, and share `share` of all sizes. No target exceeds `limit` times its source's size: what is above goes
    to the others by weight until none is above, which ends where every target is the smaller of its
    limit and one common multiple of its weight. Each round is one small sum over the sources.
    """
    if share > limit:
        raise ValueError("share must not exceed limit")
    per = materialise(
        sizes.groupBy("source").agg(F.sum("size").alias("source_size")).select(
            "*", F.lit(1).alias("one"), F.col("source").isNull().alias("last")
        ),
        "sources",
    )
    ranked = running_total(per, [], ["last", "source"], "one", "source_id")
    weight = F.get(F.array(*(F.lit(float(w)) for w in weights)), (F.col("source_id") % len(weights)).cast("int"))
    ranked = materialise(
        ranked.select("source", "source_id", F.col("source_size").cast("long"), weight.alias("weight")), "weights"
    )
    top = F.col("source_size") * limit
    whole = (ranked.agg(F.sum("source_size")).first()[0] or 0) * share
    level, held = 0.0, -1
    while True:
        over = F.col("weight") * level >= top
        n, capped, free = ranked.agg(
            F.count(F.when(over, 1)), F.sum(F.when(over, top)), F.sum(F.when(~over, F.col("weight")))
        ).first()
        if n <= held or not free:
            break
        held, level = n, (whole - (capped or 0.0)) / free
    return ranked.select(
        "source", "source_id", "source_size", F.least(top, F.col("weight") * level).cast("double").alias("target")
    )


def mix_sources(
    docs: DataFrame,
    *,
    weights: Sequence[float] = (3, 1, 2),
    share: float = 1.5,
    limit: float = 2.0,
    block: int = 128,
    shard_slots: int = 4096,
    seed: int = 1,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
) -> tuple[DataFrame, DataFrame]:
    """Choose which words of which documents a mix takes, so that sources meet their targets.

    The words of a source, its documents in an order set by a hash of their ids, are packed into blocks of
    `block` words. A source gets as many slots as it takes to reach its target; slot by slot a permutation names
    the block, a new one for each pass over the source, and the last slot takes only the words that are
    missing. All slots are dealt to output shards of `shard_slots` slots by one more permutation, so the
    counts by source in a shard are a multinomial draw under the condition that the totals are met.
    Slots and blocks are joined by number. Everything follows from `seed`, so reruns and lost tasks agree. A
    source's words meet its target, rounded, and no document is taken more than `limit` times.

    Returns two tables with columns of their own; other columns of `docs` are ignored.
    `mixed`, a row per document: `id`, `row` (hash of the text), `source`, `copy`, `size`, `source_size`,
    `target`, `taken`.
    `pieces`, a row per document, pass and block: `id`, `row`, `source`, `copy`, `turn`, `word`, `end` (the
    words taken, from and to), `shard`.

    Sizes count words; a null or empty text has none and is never taken. Null sources are one source, ranked
    last. Rows that agree in id, text and source, null ids too, are told apart by `copy`, from 0. A table
    without rows gives none.
    """
    text = F.col(text_col)
    rows = docs.select(
        F.col(id_col).alias("id"),
        F.xxhash64(text).alias("row"),
        F.col(source_col).alias("source"),
        F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
    )
    rows = materialise(rows, "sizes")
    targets = source_targets(rows, weights, share, limit).mapInArrow(
        lambda batches: _count_slots(batches, block, seed),
        "source string, source_id long, source_size long, target double, slots long, cut long",
    )
    targets = materialise(targets, "targets")
    named = targets.select(F.col("source").alias("t_source"), "source_id")
    units = rows.groupBy("id", "row", "source", "size").agg(F.count("*").alias("copies"))
    units = units.join(named, F.col("source").eqNullSafe(F.col("t_source"))).select(
        "id",
        "row",
        "source_id",
        "size",
        "copies",
        (F.col("size") * F.col("copies")).alias("packed"),
        F.xxhash64(F.lit(seed), "id").alias("mixed"),
    )
    units = running_total(materialise(units, "units"), ["source_id"], ["mixed", "id", "row"], "packed", "first")
    # In two steps, so that no array grows with the copies of one row.
    units = units.withColumn("_c", F.explode(F.expr(f"sequence(0L, copies - 1, {COPIES}L)")))
    units = units.withColumn("copy", F.explode(F.expr(f"sequence(_c, least(_c + {COPIES - 1}, copies - 1))")))
    units = materialise(
        units.select("id", "row", "source_id", "copy", "size", (F.col("first") + F.col("copy") * F.col("size")).alias("first")),
        "packed",
    )
    drawn = _spread(targets).mapInArrow(
        lambda batches: _draw(batches, block, seed),
        "source_id long, turn int, block long, took long, place long",
    )
    # Stored, since the number of slots does not show in the size of the table they are drawn from.
    drawn = materialise(drawn, "drawn")
    key = ["id", "row", "source_id", "copy"]
    low = F.col("block") * block
    parts = (
        units.where("size > 0")
        .withColumn("block", F.explode(F.expr(f"sequence(first div {block}, (first + size - 1) div {block})")))
        .select(
            *key,
            "block",
            (F.greatest(low, F.col("first")) - F.col("first")).alias("word"),
            (F.greatest(low, F.col("first")) - low).alias("from"),
            (F.least(low + block, F.col("first") + F.col("size")) - low).alias("to"),
        )
    )
    pieces = (
        parts.join(drawn.hint("merge"), ["source_id", "block"])
        .where(F.col("from") < F.col("took"))
        .select(
            *key,
            "turn",
            "word",
            (F.col("word") + F.least("to", "took") - F.col("from")).alias("end"),
            F.expr(f"place div {shard_slots}").alias("shard"),
        )
    )
    pieces = materialise(pieces, "pieces")
    sums = pieces.groupBy(*key).agg(F.sum(F.col("end") - F.col("word")).alias("taken"))
    sums = sums.select(*(F.col(c).alias(f"_{c}") for c in key), "taken")
    same = reduce(and_, (F.col(c).eqNullSafe(F.col(f"_{c}")) for c in key))
    pieces = pieces.join(targets.select("source_id", "source"), "source_id").drop("source_id")
    mixed = (
        units.join(sums, same, "left")
        .join(targets.select("source_id", "source", "source_size", "target"), "source_id")
        .select(
            "id",
            "row",
            "source",
            "copy",
            "size",
            "source_size",
            "target",
            F.coalesce("taken", F.lit(0)).cast("long").alias("taken"),
        )
    )
    return mixed, pieces


def _spread(targets: DataFrame) -> DataFrame:
    """Rows that each stand for some consecutive slots of one source, over many tasks."""
    total = targets.agg(F.sum("slots")).first()[0] or 0
    numbered = running_total(targets, [], ["source_id"], "slots", "offset")
    rows = (
        numbered.where("slots > 0")
        .withColumn("first", F.explode(F.expr(f"sequence(0L, slots - 1, {SLOTS_PER_ROW}L)")))
        .select(
            "source_id",
            "source_size",
            "slots",
            "cut",
            "offset",
            "first",
            F.least(F.lit(SLOTS_PER_ROW), F.col("slots") - F.col("first")).cast("long").alias("n"),
            F.lit(total).cast("long").alias("all_slots"),
        )
    )
    # A number of tasks is given: the rows are few, but each stands for thousands.
    return rows.repartition(partitions(rows, total, SLOTS_PER_TASK), "source_id", "first")


def _cut_texts(batches: Iterator[pa.RecordBatch], text_col: str) -> Iterator[pa.RecordBatch]:
    """Keep the words of each text that its spans name."""
    for batch in small(batches):
        spans, texts = batch.column("spans").to_pylist(), batch.column("whole").field(text_col)
        out = []
        for text, wanted in zip(texts, spans):
            data = text.as_py().encode()
            starts, ends, _ = hash_words(data)
            runs: list[list[int]] = []
            for a, b in sorted((s["word"], s["end"]) for s in wanted):
                if runs and runs[-1][1] == a:
                    runs[-1][1] = b
                else:
                    runs.append([a, b])
            whole = runs == [[0, len(starts)]]
            parts = [data[starts[a] : ends[b - 1]] for a, b in runs]
            out.append(text.as_py() if whole else b"\n".join(parts).decode())
        yield pa.RecordBatch.from_arrays([batch.column("whole"), pa.array(out, pa.string())], ["whole", "cut"])


def _numbered(rows: DataFrame, key: list[str]) -> DataFrame:
    """Add `_copy`: numbers the rows that agree in `key` from 0.

    Rows whose key is found once are 0 without a window. The others are stored with the task that read them and numbered within it, from where the
    tasks before it end; so equal rows, however many, never meet in one task.
    """
    same = lambda k: reduce(and_, (F.col(c).eqNullSafe(F.col(f"_k{c}")) for c in k))
    names = [F.col(c).alias(f"_k{c}") for c in key]
    counts = rows.groupBy(*names).agg(F.count("*").alias("_n")).where("_n > 1")
    marked = rows.withColumn("_part", F.spark_partition_id()).join(materialise(counts, "repeated"), same(key), "left")
    marked = marked.select(*rows.columns, F.col("_n").isNotNull().alias("_many"), "_part")
    marked = materialise(marked, "marked")
    many, part = marked.where("_many"), [*key, "_part"]
    ahead = Window.partitionBy(*(f"_k{c}" for c in key)).orderBy("_k_part").rowsBetween(Window.unboundedPreceding, -1)
    sums = many.groupBy(*names, F.col("_part").alias("_k_part")).agg(F.count("*").alias("_n"))
    sums = sums.withColumn("_first", F.coalesce(F.sum("_n").over(ahead), F.lit(0)))
    number = F.row_number().over(Window.partitionBy(*part).orderBy("_part")) - 1
    numbered = many.withColumn("_number", number).join(sums, same(part))
    numbered = numbered.select(*rows.columns, (F.col("_first") + F.col("_number")).alias("_copy"))
    return marked.where("not _many").select(*rows.columns, F.lit(0).cast("long").alias("_copy")).union(numbered)


def mixed_documents(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options
) -> DataFrame:
    """The mix as documents: the rows of `docs`, each once per pass that takes some of its words, with
    the text cut to these words (a whole text unchanged, pieces from different places joined by a newline).

    All columns of `docs` come back, also those named like columns used here; ids repeat where a document is taken
    in two passes. Options, null values and repeated rows as in `mix_sources`; a document of
    which no word is taken, an empty one for instance, is not in the mix.
    """
    names = dict(id_col=id_col, text_col=text_col, source_col=source_col)
    _, pieces = mix_sources(docs, **names, **options)
    key = ["id", "row", "source", "copy"]
    spans = pieces.groupBy(*key, "turn").agg(F.collect_list(F.struct("word", "end")).alias("spans"))
    text = F.col(text_col)
    rows = docs.select(
        F.struct(*docs.columns).alias("whole"),
        F.col(id_col).alias("_id"),
        F.xxhash64(text).alias("_row"),
        F.col(source_col).alias("_source"),
    )
    rows = _numbered(rows, ["_id", "_row", "_source"])
    same = reduce(and_, (F.col(c).eqNullSafe(F.col(f"_{c}")) for c in key))
    taken = rows.join(spans, same).select("whole", "spans")
    whole = taken.schema["whole"].dataType.simpleString()
    cut = taken.mapInArrow(lambda batches: _cut_texts(batches, text_col), f"whole {whole}, cut string")
    return cut.select(*(F.col("cut").alias(c) if c == text_col else F.col("whole")[c].alias(c) for c in docs.columns))
