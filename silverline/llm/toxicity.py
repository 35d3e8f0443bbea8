"""Toxicity of texts from the labelled examples nearest to them."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from silverline.llm.common import materialise

#: Labelled rows of either label that the model is fitted on, at most.
EXAMPLES = 20_000
#: Terms of the vector space, at most, and the terms of all examples together.
TERMS, POSTINGS = 4096, 1_000_000
#: A longer word is no term.
TERM_CHARS = 64
#: Terms are words whose label differs from chance by this chi-square (continuity-corrected), and whose odds of label 1 differ by this factor.
CHI_SQUARE, ODDS = 24.0, 5.0
#: Neighbours that vote, and the power of their similarity by which they do.
NEIGHBOURS, POWER = 20, 4
#: Examples of an index block.
BLOCK = 64
#: Steps of the votes that calibration tells apart.
STEPS = 1000

_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_VECTOR = [
    T.StructField("terms", T.ArrayType(T.IntegerType())),
    T.StructField("counts", T.ArrayType(T.IntegerType())),
]
_EVIDENCE = pa.list_(
    pa.struct([("example", pa.int64()), ("similarity", pa.float64()), ("n", pa.int64()), ("n_toxic", pa.int64())])
)


def _term_counts(text: str | None) -> Counter:
    """Lower-case words of a text with their number, a long text's some at a time."""
    counts: Counter = Counter()
    found = _WORD.finditer((text or "").lower())
    while some := [m.group() for m in islice(found, 100_000)]:
        counts.update(some)
    return counts


class BlockMaxIndex:
    """Sparse unit vectors as postings by term, with the greatest weight of every (term, block of vectors).

    Vectors are ordered by their heaviest terms, so that blocks hold similar ones.
    """

    def __init__(self, terms: Sequence[np.ndarray], weights: Sequence[np.ndarray], n_terms: int, block: int = BLOCK):
        heavy = [tuple(t[np.argsort(-w, kind="stable")][:4].tolist()) for t, w in zip(terms, weights)]
        #: Vector numbers in the order of the index.
        self.order = np.array(sorted(range(len(terms)), key=heavy.__getitem__), np.int64)
        self.block, self.n_blocks = block, -(-len(terms) // block)
        none = np.zeros(0)
        term = np.concatenate([none.astype(np.int64), *(terms[i] for i in self.order)])
        entry = np.repeat(np.arange(len(terms)), [len(terms[i]) for i in self.order])
        weight = np.concatenate([none, *(weights[i] for i in self.order)])
        by = np.lexsort((entry, term))
        self.entry, self.weight = entry[by], weight[by]
        cell = term[by] * max(1, self.n_blocks) + self.entry // block
        self.start = np.flatnonzero(np.diff(cell, prepend=-1))
        self.sizes = np.diff(np.append(self.start, len(cell)))
        self.top = np.maximum.reduceat(self.weight, self.start) if len(cell) else none
        self.cell_block = cell[self.start] % max(1, self.n_blocks)
        self.first = np.searchsorted(cell[self.start] // max(1, self.n_blocks), np.arange(n_terms + 1))

    def search(self, terms: np.ndarray, weights: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """The k vectors of greatest dot product, exactly: (vector numbers, products), ties by place in the index.

        Blocks are opened by falling upper bound, until none can hold anything nearer.
        """
        length = self.first[terms + 1] - self.first[terms]
        cells = np.repeat(self.first[terms] - (np.cumsum(length) - length), length) + np.arange(length.sum())
        blocks = self.cell_block[cells]
        factor = np.repeat(weights, length)
        bound = np.bincount(blocks, self.top[cells] * factor, self.n_blocks)
        queue = np.argsort(-bound, kind="stable")
        place = np.empty(self.n_blocks, np.int64)
        place[queue] = np.arange(self.n_blocks)
        turn = place[blocks]  # when the block of a cell is opened
        best, score, at, step = np.zeros(0, np.int64), np.zeros(0), 0, 2
        while at < len(queue) and (len(best) < k or bound[queue[at]] * (1 + 1e-9) >= score[-1]):
            chosen = np.flatnonzero((turn >= at) & (turn < at + step))
            mine, sizes = cells[chosen], self.sizes[cells[chosen]]
            postings = np.repeat(self.start[mine] - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
            # a small table of scores: the opened blocks side by side
            slot = np.repeat((turn[chosen] - at) * self.block, sizes) + self.entry[postings] % self.block
            products = np.bincount(slot, self.weight[postings] * np.repeat(factor[chosen], sizes))
            found = np.flatnonzero(products)
            entries = queue[at + found // self.block] * self.block + found % self.block
            best, score = np.concatenate((best, entries)), np.concatenate((score, products[found]))
            kept = np.lexsort((best, -score))[:k]
            best, score = best[kept], score[kept]
            at, step = at + step, 2 * step
        return self.order[best], score


@dataclass
class Model:
    """What scoring needs; its size is bounded by TERMS and POSTINGS."""

    words: list[str]
    #: Inverse document frequencies over the whole corpus; the last one is the mark that every text has.
    idf: np.ndarray
    index: BlockMaxIndex
    n: np.ndarray
    n_toxic: np.ndarray
    example: np.ndarray
    #: Votes and the calibrated scores they stand for.
    votes: np.ndarray
    scores: np.ndarray
    neighbours: int = NEIGHBOURS

    def state(self) -> dict:
        """Plain arrays, which executors can read without this package."""
        return vars(self) | {"index": vars(self.index)}

    @classmethod
    def of(cls, state: dict) -> Model:
        index = object.__new__(BlockMaxIndex)
        vars(index).update(state["index"])
        return cls(**state | {"index": index})

    def vector(self, terms: Sequence[int], counts: Sequence[int]) -> tuple[np.ndarray, np.ndarray]:
        """Unit vector of logarithmic counts times inverse document frequency, the mark included."""
        terms = np.append(np.asarray(terms, np.int64), len(self.words))
        weights = (1 + np.log(np.append(np.asarray(counts, np.float64), 1))) * self.idf[terms]
        return terms, weights / np.sqrt((weights * weights).sum())

    def vote(self, near: np.ndarray, similarity: np.ndarray, own: int = -1, label: int = 0) -> float:
        """Share of toxic rows among neighbours, by similarity; one row with `label` of vector `own` is left out."""
        n, toxic = self.n[near].astype(float), self.n_toxic[near].astype(float)
        n, toxic = n - (near == own), toxic - label * (near == own)
        weight = np.maximum(similarity, 0) ** POWER
        total = (weight * n).sum()
        return float((weight * toxic).sum() / total) if total > 0 else float(self.n_toxic.sum() / max(1, self.n.sum()))

    def calibrated(self, vote: float) -> float:
        return float(np.interp(vote, self.votes, self.scores)) if len(self.votes) else vote


def _sample(labels: DataFrame, limit: int) -> DataFrame:
    """At most `limit` ids of either label, the least by hash; an id with both labels counts as 1."""
    known = labels.where("id is not null and label in (0, 1)").groupBy("id").agg(F.max("label").alias("label"))
    sides = [known.where(F.col("label") == y).orderBy(F.xxhash64("id"), "id").limit(limit) for y in (0, 1)]
    return sides[0].union(sides[1])


def _word_labels(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Number of texts of either label that hold a word, summed by batch."""
    for batch in batches:
        held: tuple[Counter, Counter] = (Counter(), Counter())
        for text, label in zip(batch.column("text"), batch.column("label").to_pylist()):
            held[label].update(w for w in _term_counts(text.as_py()) if len(w) <= TERM_CHARS)
        words = list(held[0] | held[1])
        columns = [words, *([side[w] for w in words] for side in held)]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int64(), pa.int64()))], ["word", "n0", "n1"])


def _vocabulary(examples: DataFrame) -> list[str]:
    """Words that tell the labels apart, most telling first."""
    totals = examples.agg(F.count_if(F.col("label") == 0), F.count_if(F.col("label") == 1)).first()
    all0, all1 = (float(x) for x in totals)
    n = all0 + all1
    if not all0 or not all1:
        return []
    counted = examples.mapInArrow(_word_labels, "word string, n0 long, n1 long")
    counted = counted.groupBy("word").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1")).where("n0 + n1 > 1")
    apart = F.greatest(F.abs(F.col("n1") * (all0 - F.col("n0")) - F.col("n0") * (all1 - F.col("n1"))) - n / 2, F.lit(0.0))
    held = F.col("n0") + F.col("n1")
    chi = n * apart * apart / F.greatest(held * (n - held) * all0 * all1, F.lit(1.0))
    odds = F.log((F.col("n1") + 0.5) * (all0 - F.col("n0") + 0.5) / ((F.col("n0") + 0.5) * (all1 - F.col("n1") + 0.5)))
    telling = counted.where(F.abs(odds) >= math.log(ODDS)).select("word", chi.alias("chi")).where(F.col("chi") >= CHI_SQUARE)
    return [r.word for r in telling.orderBy(F.desc("chi"), "word").limit(TERMS).collect()]


def _vectors(docs: DataFrame, words: list[str]) -> DataFrame:
    """Every text as the terms it holds; other words have no dimension."""
    schema = T.StructType([docs.schema["kept"], docs.schema["id"], *_VECTOR])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = {w: i for i, w in enumerate(words)}
        for batch in batches:
            terms, counts = [], []
            for text in batch.column("text"):
                found = _term_counts(text.as_py())
                mine = sorted((number[w], n) for w, n in found.items() if w in number)
                terms.append([t for t, _ in mine])
                counts.append([n for _, n in mine])
            kind = pa.list_(pa.int32())
            arrays = [batch.column("kept"), batch.column("id"), pa.array(terms, kind), pa.array(counts, kind)]
            yield pa.RecordBatch.from_arrays(arrays, ["kept", "id", "terms", "counts"])

    return docs.mapInArrow(run, schema)


def _holding(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Number of texts that hold a term, summed by task: at most TERMS rows from each."""
    held = np.zeros(0, np.int64)
    for batch in batches:
        found = np.bincount(batch.column("terms").flatten().to_numpy(zero_copy_only=False).astype(np.int64), minlength=len(held))
        found[: len(held)] += held
        held = found
    term = np.flatnonzero(held)
    yield pa.RecordBatch.from_arrays([pa.array(term, pa.int64()), pa.array(held[term], pa.int64())], ["term", "n"])


def _rising(votes: np.ndarray, n: np.ndarray, toxic: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool neighbouring votes until the share of toxic rows rises with the vote: (mean vote, share), shares kept off 0 and 1."""
    pools: list[list[float]] = []
    for v, a, b in zip(votes, n, toxic):
        pools.append([v * a, a, b])
        while len(pools) > 1 and pools[-2][2] * pools[-1][1] >= pools[-1][2] * pools[-2][1]:
            last = pools.pop()
            pools[-1] = [x + y for x, y in zip(pools[-1], last)]
    at = np.array([p[0] / p[1] for p in pools])
    share = np.maximum.accumulate(np.array([(p[2] + 0.5) / (p[1] + 1) for p in pools]))
    return at, share


def _fit(spark: SparkSession, vectors: DataFrame, words: list[str], sample: DataFrame, neighbours: int) -> Model:
    counted = vectors.select("terms").mapInArrow(_holding, "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))
    df = np.zeros(len(words) + 1)
    for r in counted.collect():  # a row for each term at most
        df[r["term"]] = r["n"]
    total = df[-1] = vectors.count()
    idf = np.log((1 + total) / (1 + df)) + 1

    # examples with one and the same vector are one entry
    entries = vectors.join(F.broadcast(sample), "id").groupBy("terms", "counts")  # 2 x EXAMPLES ids
    entries = entries.agg(F.count("*").alias("n"), F.sum("label").alias("n_toxic"), F.min("id").alias("example"))
    first = Window.orderBy("h", "example")
    entries = entries.withColumn("h", F.xxhash64("terms", "counts")).orderBy("h", "example").limit(2 * EXAMPLES)
    entries = entries.withColumn("held", F.sum(F.size("terms") + 1).over(first)).where(F.col("held") <= POSTINGS)
    entries = materialise(entries.withColumn("entry", F.row_number().over(first) - 1), "examples")
    rows = entries.orderBy("entry").collect()

    none = np.zeros(0)
    n, n_toxic, example = (np.array([r[c] for r in rows], np.int64) for c in ("n", "n_toxic", "example"))
    model = Model(words, idf, None, n, n_toxic, example, none, none, neighbours)
    pairs = [model.vector(r.terms, r.counts) for r in rows]
    model.index = BlockMaxIndex([t for t, _ in pairs], [w for _, w in pairs], len(words) + 1)
    if not rows:
        return model

    # every example is judged by the others
    known = spark.sparkContext.broadcast(model.state())

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model.of(known.value)
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                near, similarity = model.index.search(*model.vector(r["terms"], r["counts"]), model.neighbours)
                for label, held in ((0, r["n"] - r["n_toxic"]), (1, r["n_toxic"])):
                    if held:
                        vote = model.vote(near, similarity, r["entry"], label)
                        out.append({"step": round(vote * STEPS), "n": held, "n_toxic": held * label})
            kind = pa.schema([("step", pa.int64()), ("n", pa.int64()), ("n_toxic", pa.int64())])
            yield pa.RecordBatch.from_pylist(out, kind)

    dealt = entries.select("terms", "counts", "n", "n_toxic", "entry").repartition("entry")
    judged = dealt.mapInArrow(judge, "step long, n long, n_toxic long")
    steps = judged.groupBy("step").agg(F.sum("n").alias("n"), F.sum("n_toxic").alias("n_toxic")).orderBy("step").collect()
    columns = (np.array([r[c] for r in steps], float) for c in ("step", "n", "n_toxic"))
    step, held, toxic = columns
    model.votes, model.scores = _rising(step / STEPS, held, toxic)
    return model


def score_toxicity(
    spark: SparkSession,
    docs: DataFrame,
    labels: DataFrame,
    *,
    text: str = "text",
    id: str = "doc_id",
    keep: Sequence[str] = ("doc_id",),
    neighbours: int = NEIGHBOURS,
) -> DataFrame:
    """Score whole texts by their nearest labelled examples: `kept` (the columns named by `keep`), `score`, `evidence`.

    `labels` has `id` (a long) and `label` (1: toxic); other labels and missing ids are ignored, an id with both counts as 1.

    Terms are the words of the examples that tell the labels apart (chi-square), and a mark that every text has, so that a text without such words is
    near its like. A text's vector is (1 + log count) * idf of its terms, with document frequencies over all of `docs`. The `neighbours`
    examples of greatest cosine, found exactly in a block-max inverted index, vote by the POWERth power of their similarity; examples of equal
    vectors are one entry with their number as weight. Votes are calibrated by pooling the votes that examples get from the others.
    `evidence` lists the entries that voted: least id, similarity, rows and toxic rows.

    Bounds: at most EXAMPLES ids of either label, TERMS terms and POSTINGS terms of entries fit the model; all rows are counted and
    scored. Null and empty texts have the mark alone. Rows that repeat an id are examples each, and are scored alike if their texts are. Without
    examples of both labels the score is the share of toxic examples, 0 without any. Extra columns of any name do no harm.
    """
    sample = materialise(_sample(labels.select(F.col("id").cast("long"), F.col("label").cast("int")), EXAMPLES), "labels")
    given = docs.select(F.struct(*keep).alias("kept"), F.col(id).cast("long").alias("id"), F.col(text).cast("string").alias("text"))
    examples = materialise(given.join(F.broadcast(sample), "id").select("text", "label"), "examples")
    words = _vocabulary(examples)
    vectors = materialise(_vectors(given, words), "vectors")
    model = spark.sparkContext.broadcast(_fit(spark, vectors, words, sample, neighbours).state())
    schema = T.StructType(
        [
            vectors.schema["kept"],
            T.StructField("score", T.DoubleType()),
            T.StructField(
                "evidence",
                T.ArrayType(T.StructType([T.StructField("example", T.LongType()), T.StructField("similarity", T.DoubleType()), T.StructField("n", T.LongType()), T.StructField("n_toxic", T.LongType())])),
            ),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, met = Model.of(model.value), {}

        def judged(terms: list[int], counts: list[int]) -> tuple[float, list[dict]]:
            if not len(known.n):
                return 0.0, []
            near, similarity = known.index.search(*known.vector(terms, counts), known.neighbours)
            voters = zip(known.example[near].tolist(), similarity.tolist(), known.n[near].tolist(), known.n_toxic[near].tolist())
            evidence = [dict(zip(("example", "similarity", "n", "n_toxic"), v)) for v in voters]
            return known.calibrated(known.vote(near, similarity)), evidence

        for batch in batches:
            found = []
            for terms, counts in zip(batch.column("terms").to_pylist(), batch.column("counts").to_pylist()):
                key = (*terms, -1, *counts)
                if key not in met:
                    if len(met) >= 10_000:
                        met.clear()
                    met[key] = judged(terms, counts)
                found.append(met[key])
            arrays = [batch.column("kept"), pa.array([s for s, _ in found], pa.float64()), pa.array([e for _, e in found], _EVIDENCE)]
            yield pa.RecordBatch.from_arrays(arrays, ["kept", "score", "evidence"])

    return vectors.select("kept", "terms", "counts").mapInArrow(run, schema)
