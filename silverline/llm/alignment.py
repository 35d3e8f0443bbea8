"""Alignment of two tokenizers: where their tokens of a text end together, and which tokens overlap."""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from silverline.llm.common import materialise

#: Characters of the texts that share a list of pairs.
BLOCK = 1 << 20
#: Characters of a text that are tokenized on their own; longer texts are cut between words.
PIECE = 1 << 16
#: Every so many ends of the shorter list one is searched from afar; those between start from its place.
STRIDE = 32
#: How byte-level vocabularies cut texts into words.
_CUT = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Characters of a long word or gap.
_LONG = 1000
_GAP = re.compile(rf"\s{{{_LONG}}}")

_PACKED = T.StructType(
    [
        T.StructField("block", T.LongType()),
        *[T.StructField(c, T.LongType()) for c in ("n_a", "n_b", "n_groups", "n_links")],
        T.StructField("groups", T.StringType()),
        T.StructField("at", T.ArrayType(T.IntegerType())),
        T.StructField("times", T.ArrayType(T.IntegerType())),
        T.StructField("pairs", T.ArrayType(T.LongType())),
        T.StructField("texts", T.ArrayType(T.LongType())),
    ]
)


class Vocabulary:
    """The bytes of a vocabulary file, read on the driver and sent to the tasks."""

    def __init__(self, data: bytes):
        self.data = data

    @classmethod
    def read(cls, path: str):
        with open(path, "rb") as file:
            return cls(file.read())


class ByteLevel(Vocabulary):
    """A byte-level vocabulary in the JSON form of the `tokenizers` library.

    Where its ids rise with its merges and it cuts words as usual, `tiktoken` gives the same ids in a fraction of the time. Parts with
    very long words or gaps, on which that slows down, and other vocabularies go to `tokenizers`.
    """

    def load(self) -> tuple[Callable[[list[str]], list[list[int]]], list[bytes]]:
        """What encodes texts with a space before them, and the bytes of every id. Names of special tokens are plain text."""
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        model = Tokenizer.from_buffer(self.data)
        model.encode_special_tokens = True
        # printable bytes stand for themselves, the others for the code points from 256 on
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        byte_of = {chr(b): b for b in plain}
        byte_of |= {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in set(plain))}

        def spelt(token: str) -> bytes:
            return bytes(byte_of[c] for c in token) if all(c in byte_of for c in token) else token.encode()

        pieces = [spelt(model.id_to_token(i) or "") for i in range(model.get_vocab_size())]

        def encode(texts: list[str]) -> list[list[int]]:
            found = model.encode_batch([" " + t for t in texts], add_special_tokens=False)
            return [e.ids for e in found]

        ranks = self._ranks(spelt)
        if not ranks:
            return encode, pieces
        import tiktoken

        fast = tiktoken.Encoding("ranks", pat_str=_CUT, mergeable_ranks=ranks, special_tokens={})

        def encode_fast(texts: list[str]) -> list[list[int]]:
            slow = [i for i, t in enumerate(texts) if max(map(len, t.split()), default=0) > _LONG or _GAP.search(t)]
            found = [[] if i in slow else fast.encode_ordinary(" " + t) for i, t in enumerate(texts)]
            for i, ids in zip(slow, encode([texts[i] for i in slow])):
                found[i] = ids
            return found

        return encode_fast, pieces

    def _ranks(self, spelt: Callable[[str], bytes]) -> dict[bytes, int] | None:
        """Bytes of every mergeable token with its id; None unless ids are in the order of the merges."""
        whole = json.loads(self.data)
        model, before = whole["model"], whole.get("pre_tokenizer") or {}
        usual = model.get("type") == "BPE" and before.get("type") == "ByteLevel" and before.get("use_regex", True)
        if not usual or before.get("add_prefix_space") or whole.get("normalizer") or model.get("dropout"):
            return None
        special = {t["content"] for t in whole.get("added_tokens", [])}
        vocabulary = {spelt(t): i for t, i in model["vocab"].items() if t not in special}
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        ids = [vocabulary.get(spelt(x) + spelt(y), -1) for x, y in merges]
        single = sorted(i for t, i in vocabulary.items() if len(t) == 1)
        follows = single == list(range(256)) and ids == list(range(256, 256 + len(ids)))
        return vocabulary if follows and len(vocabulary) == 256 + len(ids) else None


class Pieces(Vocabulary):
    """A sentencepiece model, which puts a space before a text itself."""

    def load(self) -> tuple[Callable[[list[str]], list[list[int]]], list[bytes]]:
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_proto=self.data)
        pieces = []
        for i in range(model.get_piece_size()):
            piece = model.id_to_piece(i)
            pieces.append(bytes([int(piece[3:5], 16)]) if model.is_byte(i) else piece.replace("▁", " ").encode())
        return lambda texts: model.encode(texts, num_threads=1), pieces


def _cut(text: str, size: int) -> list[str]:
    """A long text in parts of about `size` characters. Parts begin after a space that follows a visible character: neither
    kind of tokenizer joins such a space to what is before it, and both put it back before the part."""
    if len(text) <= size:
        return [text]
    parts, start = [], 0
    while len(text) - start > size:
        at = text.find(" ", start + size)
        while at >= 0 and text[at - 1].isspace():
            at = text.find(" ", at + 1)
        if at < 0:
            break
        parts.append(text[start:at])
        start = at + 1
    parts.append(text[start:])
    return parts


def _encoded(encode, pieces: list[bytes], parts: list[str]) -> list[np.ndarray | None]:
    """Ids of every part; None where their bytes are not the part's."""
    found = []
    for part, ids in zip(parts, encode(parts)):
        same = b"".join(map(pieces.__getitem__, ids)) == b" " + part.encode()
        found.append(np.array(ids, np.int64) if same else None)
    return found


def _gallop(values: np.ndarray, among: np.ndarray, guess: np.ndarray) -> np.ndarray:
    """For each value the number of items of `among` (both rising) below it: from a guessed place the step doubles until the value is
    passed, then the interval is halved. All values go at once."""
    n = len(among)
    at = np.clip(guess, 0, n - 1)
    below = among[at] < values
    low, high = np.where(below, at + 1, 0), np.where(below, n, at)
    active, step = np.arange(len(values)), 1
    while len(active):
        probe = np.where(below[active], at[active] + step, at[active] - step)
        inside = (probe >= 0) & (probe < n)
        active, probe = active[inside], probe[inside]
        less = among[probe] < values[active]
        low[active[less]] = probe[less] + 1
        high[active[~less]] = probe[~less]
        active = active[less == below[active]]
        step *= 2
    active = np.flatnonzero(low < high)
    while len(active):
        middle = (low[active] + high[active]) >> 1
        less = among[middle] < values[active]
        low[active[less]] = middle[less] + 1
        high[active[~less]] = middle[~less]
        active = active[low[active] < high[active]]
    return low


def ranks(short: np.ndarray, long: np.ndarray, first_short: np.ndarray, first_long: np.ndarray) -> np.ndarray:
    """Rank in `long` of every end in `short`. Texts, none without tokens, lie one after the other; `first_*` are the tokens where each
    begins, and one more."""
    ratio = np.diff(first_long) / np.diff(first_short)
    far = np.arange(0, len(short), STRIDE)
    text_of = np.searchsorted(first_short, far, side="right") - 1
    start = (first_long[text_of] + (far - first_short[text_of]) * ratio[text_of]).astype(np.int64)
    placed = np.append(_gallop(short[far], long, start), len(long))
    index = np.arange(len(short))
    known, offset = placed[index // STRIDE], index % STRIDE
    guess = known + offset * (placed[index // STRIDE + 1] - known) // STRIDE
    return _gallop(short, long, guess)


class Aligned:
    """Texts of a block whose first tokenizer (`short`) makes the fewer tokens, aligned with the second (`long`).

    Groups end where both have an end. `owner` and `other` hold every overlapping pair of tokens, by the short one.
    """

    def __init__(self, short: list[np.ndarray], long: list[np.ndarray], sizes_short: np.ndarray, sizes_long: np.ndarray):
        self.first_short, self.first_long = (np.cumsum([0, *map(len, x)]) for x in (short, long))
        self.short, self.long = np.concatenate(short), np.concatenate(long)
        ends, others = np.cumsum(sizes_short[self.short]), np.cumsum(sizes_long[self.long])
        rank = ranks(ends, others, self.first_short, self.first_long)
        self.common = others[rank] == ends
        # first token of the long side past the end before: ranks differ by the tokens that an interval overlaps
        begin = np.concatenate(([0], (rank + self.common)[:-1]))
        overlaps = rank - begin + 1
        self.owner = np.repeat(np.arange(len(ends)), overlaps)
        self.other = np.arange(len(self.owner)) - np.repeat(np.cumsum(overlaps) - overlaps, overlaps) + begin[self.owner]
        self.common_long = np.zeros(len(others), bool)
        self.common_long[rank[self.common]] = True

    def links_per_text(self) -> np.ndarray:
        text_of = np.repeat(np.arange(len(self.first_short) - 1), np.diff(self.first_short))
        return text_of[self.owner]


def _spell(a, b, common_a, common_b, first_a, first_b, table: Sequence[str], n_a: int, n_b: int) -> list[str]:
    """`a1,a2|b1;a3|b2,b3` for every text: ids looked up in `table` with what follows them, in the order in which they are written."""
    group_a = np.cumsum(common_a) - common_a
    group_b = np.cumsum(common_b) - common_b
    upto_a, upto_b = np.cumsum(np.bincount(group_a)), np.cumsum(np.bincount(group_b))
    place_a = np.arange(len(a)) + (upto_b - np.bincount(group_b))[group_a]
    place_b = np.arange(len(b)) + upto_a[group_b]
    last = np.zeros(len(b), bool)
    last[first_b[1:] - 1] = True
    codes = np.empty(len(a) + len(b), np.int64)
    codes[place_a] = a + n_a * common_a
    codes[place_b] = 2 * n_a + b + n_b * (common_b.astype(np.int64) + last)
    bounds = (first_a + first_b).tolist()
    return ["".join(map(table.__getitem__, codes[s:e].tolist())) for s, e in zip(bounds, bounds[1:])]


def _spelling(n_a: int, n_b: int) -> list[str]:
    sides = [(n_a, (",", "|")), (n_b, (",", ";", ""))]
    return [f"{i}{mark}" for n, marks in sides for mark in marks for i in range(n)]


def _aligned(parts: list[str], a: tuple, b: tuple, sizes: tuple, table: list[str] | None):
    """Counts and spelt groups of every part (None where a tokenizer loses bytes), and the links of all: (part, pair)."""
    ids_a, ids_b = _encoded(*a, parts), _encoded(*b, parts)
    n_a, n_b = len(sizes[0]), len(sizes[1])
    rows: list[tuple | None] = [None] * len(parts)
    whole = [i for i in range(len(parts)) if ids_a[i] is not None and ids_b[i] is not None]
    owners, pairs = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for a_shorter in (True, False):
        chosen = [i for i in whole if (len(ids_a[i]) <= len(ids_b[i])) == a_shorter]
        if not chosen:
            continue
        sides = ([ids_a[i] for i in chosen], [ids_b[i] for i in chosen])
        if a_shorter:
            found = Aligned(*sides, *sizes)
            args = found.short, found.long, found.common, found.common_long, found.first_short, found.first_long
            left, right = found.short[found.owner], found.long[found.other]
        else:
            found = Aligned(sides[1], sides[0], sizes[1], sizes[0])
            args = found.long, found.short, found.common_long, found.common, found.first_long, found.first_short
            left, right = found.long[found.other], found.short[found.owner]
        part_of = found.links_per_text()
        owners.append(np.array(chosen)[part_of])
        pairs.append(left * n_b + right)
        links = np.bincount(part_of, minlength=len(chosen))
        part_of_a = np.repeat(np.arange(len(chosen)), np.diff(args[4]))
        groups = np.bincount(part_of_a[args[2]], minlength=len(chosen))
        spelt = _spell(*args, table, n_a, n_b) if table else [""] * len(chosen)
        for i, g, k, text in zip(chosen, groups.tolist(), links.tolist(), spelt):
            rows[i] = len(ids_a[i]), len(ids_b[i]), g, k, text
    return rows, np.concatenate(owners), np.concatenate(pairs)


def _block(texts: list[str], a: tuple, b: tuple, sizes: tuple, table: list[str] | None, digest: bool) -> tuple[list[dict], np.ndarray, np.ndarray]:
    """Counts, groups and links of texts; the distinct pairs of the block and the number of texts that hold each.

    Long texts are aligned part by part: both tokenizers end a token where a part ends, so groups never cross.
    """
    parts, owner = [], []
    for i, text in enumerate(texts):
        if text:
            cut = _cut(text, PIECE)
            parts += cut
            owner += [i] * len(cut)
    counts, lost = np.zeros((len(texts), 4), np.int64), set()
    groups: list = [hashlib.sha256() if digest else [] for _ in texts]
    size_b = len(sizes[1])
    held = []  # (text and pair, times), distinct within a chunk
    start, size = 0, 0
    for k in range(len(parts) + 1):
        if start < k and (k == len(parts) or size + len(parts[k]) > 4 * PIECE):
            rows, part_of, pairs = _aligned(parts[start:k], a, b, sizes, table)
            for i, row in zip(owner[start:k], rows):
                if row is None:
                    lost.add(i)
                    continue
                text = (";" if counts[i, 0] else "") + row[4]
                groups[i].update(text.encode()) if digest else groups[i].append(text)
                counts[i] += row[:4]
            text_of = np.array(owner[start:k], np.int64)[part_of]
            held.append(np.unique(text_of * (len(sizes[0]) * size_b) + pairs, return_counts=True))
            start, size = k, 0
        if k < len(parts):
            size += len(parts[k])
    keys = np.concatenate([np.zeros(0, np.int64), *(x for x, _ in held)])
    keys, place = np.unique(keys, return_inverse=True)
    times = np.zeros(len(keys), np.int64)
    np.add.at(times, place, np.concatenate([np.zeros(0, np.int64), *(x for _, x in held)]))
    text_of, pairs = np.divmod(keys, len(sizes[0]) * size_b)
    if lost:
        right = ~np.isin(text_of, list(lost))
        text_of, pairs, times = text_of[right], pairs[right], times[right]
    distinct, at, in_texts = np.unique(pairs, return_inverse=True, return_counts=True)
    bounds = np.searchsorted(text_of, np.arange(len(texts) + 1))
    out = []
    for i, text in enumerate(texts):
        there = bool(text) and i not in lost
        row = dict(zip(("n_a", "n_b", "n_groups", "n_links"), counts[i].tolist() if there else (0, 0, 0, 0)))
        if table:
            row["groups"] = "" if not there else groups[i].hexdigest() if digest else "".join(groups[i])
        span = slice(bounds[i], bounds[i + 1])
        out.append(row | {"at": at[span].astype(np.int32), "times": times[span].astype(np.int32)})
    return out, distinct, in_texts


def pack_links(docs: DataFrame, a: ByteLevel, b: Pieces, *, text: str = "text", keep: Sequence[str] = ("doc_id",), groups: str | None = "text", block: int = BLOCK) -> DataFrame:
    """Every text aligned on its own: `kept`, counts, `groups`, and its distinct links as places in the pair list of its block.

    A block is some texts of one task, about `block` characters; its pairs, with the number of its texts that hold each, are on its first row. Blocks
    are numbered by task, so the result must be stored before it is used twice.
    """
    spark = docs.sparkSession
    kinds = type(a), type(b)
    files = spark.sparkContext.broadcast((a.data, b.data))  # a few megabytes whatever the input
    kept = F.struct(*keep).alias("kept")
    given = docs.select(kept, F.col(text).cast("string").alias("text"))
    schema = T.StructType([given.schema["kept"], *_PACKED.fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, second = (kind(data).load() for kind, data in zip(kinds, files.value))
        sizes = tuple(np.array([len(p) for p in x[1]], np.int64) for x in (first, second))
        table = _spelling(*map(len, sizes)) if groups else None
        number = TaskContext.get().partitionId() << 40
        for batch in batches:
            column = batch.column("text").to_pylist()
            start = 0
            while start < len(column):
                size, stop = 0, start
                while stop < len(column) and (stop == start or size < block):
                    size += len(column[stop] or "")
                    stop += 1
                rows, distinct, in_texts = _block([t or "" for t in column[start:stop]], first, second, sizes, table, groups == "sha256")
                for k, row in enumerate(rows):
                    row |= {"block": number, "pairs": None if k else distinct, "texts": None if k else in_texts}
                number += 1
                arrays = [batch.column("kept").slice(start, stop - start)]
                for field in _PACKED.fields:
                    values = [r.get(field.name) for r in rows]
                    arrays.append(pa.array(values, _arrow(field.dataType)))
                yield pa.RecordBatch.from_arrays(arrays, ["kept", *[f.name for f in _PACKED.fields]])
                start = stop

    return given.mapInArrow(run, schema)


def _arrow(kind: T.DataType) -> pa.DataType:
    if isinstance(kind, T.ArrayType):
        return pa.list_(_arrow(kind.elementType))
    return {T.LongType(): pa.int64(), T.IntegerType(): pa.int32(), T.StringType(): pa.string()}[kind]


def link_counts(packed: DataFrame, n_b: int) -> DataFrame:
    """(pair, texts, best): in how many texts each pair of ids is linked, and whether no pair of the same first id is in more.

    Blocks have counted their texts, so a pair has a row for each block at most; a first id has no more pairs than the second
    vocabulary has ids.
    """
    counted = (
        packed.where("pairs is not null")
        .select(F.explode(F.arrays_zip("pairs", "texts")).alias("x"))
        .groupBy(F.col("x.pairs").alias("pair"))
        .agg(F.sum("x.texts").alias("texts"))
    )
    first = Window.partitionBy(F.floor(F.col("pair") / F.lit(n_b)))
    return counted.select("pair", "texts", (F.col("texts") == F.max("texts").over(first)).alias("best"))


def align_tokenizers(
    spark: SparkSession,
    docs: DataFrame,
    a: ByteLevel,
    b: Pieces,
    *,
    text: str = "text",
    keep: Sequence[str] = ("doc_id",),
    groups: str | None = "text",
    block: int = BLOCK,
) -> DataFrame:
    """Align the tokens of every text, and weigh its links by the whole corpus.

    Returns a row per row of `docs`: `kept` (the columns named by `keep`), `n_a`, `n_b`, `n_groups`, `n_links`, `n_best`, `count_sum` and
    `groups`. Tokens are compared by the bytes at which they end; where ends agree they cut both lists into groups, spelt
    `a1,a2|b1;a3|b2,b3` (`groups="sha256"`: the hash of that; None: left out). A link is a pair of overlapping tokens, its count the number of rows
    that hold the two ids linked; `n_best` counts the links with the highest count of their first id, `count_sum` sums the counts.

    The ends of the tokenizer with fewer tokens are searched in those of the other, galloping. Null and empty texts, and texts that a tokenizer
    does not give back byte by byte after a space, have no tokens: zeros and empty groups. Rows that repeat an id or a text count as rows of
    their own; extra columns of any name do no harm. Counts are exact and cover all rows: blocks of texts meet the counts of the pairs they
    hold, not each text, so a pair found everywhere is a row for each block.
    """
    packed = materialise(pack_links(docs, a, b, text=text, keep=keep, groups=groups, block=block), "links")
    n_b = len(b.load()[1])
    counts = materialise(link_counts(packed, n_b), "link-counts")
    held = packed.where("pairs is not null").select("block", F.posexplode("pairs").alias("place", "pair"))
    known = held.join(counts, "pair").select(F.col("block").alias("home"), "place", "texts", "best")
    fields = [f for f in packed.schema.fields if f.name in ("kept", "n_a", "n_b", "n_groups", "n_links", "groups")]
    schema = T.StructType([*fields, T.StructField("n_best", T.LongType()), T.StructField("count_sum", T.LongType())])
    names = [f.name for f in fields]

    def weigh(rows: pa.Table, pairs: pa.Table) -> pa.Table:
        order = np.argsort(pairs["place"].to_numpy())
        texts, best = pairs["texts"].to_numpy()[order], pairs["best"].to_numpy(zero_copy_only=False)[order]
        at, times = (rows[c].combine_chunks() for c in ("at", "times"))
        lengths = np.diff(at.offsets.to_numpy())
        owner = np.repeat(np.arange(len(rows)), lengths)
        at, times = at.flatten().to_numpy(), times.flatten().to_numpy().astype(np.int64)
        sums = [np.zeros(len(rows), np.int64) for _ in range(2)]
        np.add.at(sums[0], owner, times * best[at])
        np.add.at(sums[1], owner, times * texts[at])
        out = rows.select(names)
        return out.append_column("n_best", pa.array(sums[0])).append_column("count_sum", pa.array(sums[1]))

    rows = packed.select(*names, "block", "at", "times")
    return rows.groupBy("block").cogroup(known.groupBy("home")).applyInArrow(weigh, schema)
