"""URL filter: host rules, and a ratio of character models of accepted and rejected URLs for all others."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from silverline.llm.common import materialise

#: Longest context in bytes.
ORDER = 4
#: Stands for all bytes after a context, where a byte would stand.
ANY = 256
#: Rows of counts that are sent to every task; a larger model is joined with the URLs instead.
BROADCAST_ROWS = 4_000_000
#: Bytes of URLs that are joined with a larger model at a time.
BLOCK = 1 << 20
#: One URL in HELD is held out to set the threshold; thresholds are tried in steps of 1 / STEPS nats a byte.
HELD, STEPS = 5, 64
START, END = b"\x02", b"\x03"
#: Bytes that are predicted at once, however many or long the URLs of a batch are.
PLACES = 1 << 18


@dataclass(frozen=True)
class Rule:
    """Allow or block a host with all its subdomains, where the path starts with `path`."""

    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path


def host_of(url: Column) -> Column:
    """After the first :// up to / ? # or the end, A-Z in lower case; empty if there is none."""
    host = F.regexp_extract(F.coalesce(url, F.lit("")), "://([^/?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    """From the end of the host up to ? or # or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), "://[^/?#]*([^?#]*)", 1)


def rule_of(rules: Sequence[Rule], host: Column, path: Column) -> Column:
    """Struct (name, verdict) of the longest rule that fits, or null."""
    found = F.lit(None)
    for r in sorted(rules, key=lambda r: (len(r.name), r.name)):
        fits = ((host == r.host) | host.endswith(f".{r.host}")) & path.startswith(r.path)
        found = F.when(fits, F.struct(F.lit(r.name).alias("name"), F.lit(r.verdict).alias("verdict"))).otherwise(found)
    return found


def _bytes(urls) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """All URLs after one another, in pieces: the bytes, some places that are predicted, and the URL of each of these."""
    data = [(u or "").encode().lower() + END for u in urls]
    buf = np.frombuffer(b"".join(START * ORDER + d for d in data), np.uint8)
    ends = np.cumsum([len(d) for d in data], dtype=np.int64)
    total = int(ends[-1]) if data else 0
    for first in range(0, total, PLACES):
        place = np.arange(first, min(first + PLACES, total))
        owner = np.searchsorted(ends, place, side="right")
        yield buf, place + ORDER * (owner + 1), owner


def _keys(buf: np.ndarray, at: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For contexts of 0 to ORDER bytes: the key of the context, and that of each predicted byte after it. Keys are the bytes themselves."""
    context = np.zeros(len(at), np.int64)
    for k in range(ORDER + 1):
        if k:
            context |= buf[at - k].astype(np.int64) << (8 * (k - 1))
        base = (k << 41) | (context << 9)
        yield base | ANY, base | buf[at]


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How often each byte follows each context in rejected and in accepted URLs, summed by piece."""
    for batch in batches:
        kinds = batch.column("good").to_numpy(zero_copy_only=False).astype(np.int64)
        for buf, at, owner in _bytes(batch.column("url").to_pylist()):
            for _, cell in _keys(buf, at):
                keys, n = np.unique(cell * 2 + kinds[owner], return_counts=True)
                good = keys & 1
                yield pa.RecordBatch.from_pydict({"key": keys >> 1, "n0": n * (1 - good), "n1": n * good})


class UrlCounts:
    """Counts by key, for scoring: of a byte after a context (rejected, accepted), and of a context its total and its different bytes."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        order = np.argsort(keys, kind="stable")
        self.keys, self.values = keys[order], values[:, order]

    def _at(self, keys: np.ndarray) -> np.ndarray:
        if not len(self.keys):
            return np.zeros((4, len(keys)), np.int64)
        place = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return self.values[:, place] * (self.keys[place] == keys)

    def probabilities(self, buf: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Of each predicted byte, in rejected and in accepted URLs.

        The probability after a context backs off to that after the shorter one in proportion to how many
        different bytes have followed it (Witten and Bell's smoothing), down to all bytes alike.
        """
        p = np.full((2, len(at)), 1 / 256)
        for context, cell in _keys(buf, at):
            held = self._at(context)
            total, kinds, n = held[:2], held[2:], self._at(cell)[:2]
            p = np.where(total > 0, (n + kinds * p) / np.maximum(total + kinds, 1), p)
        return p

    def score(self, urls) -> np.ndarray:
        """Mean over a URL's bytes of the log of accepted over rejected probability."""
        sums, sizes = np.zeros(len(urls)), np.zeros(len(urls), np.int64)
        for buf, at, owner in _bytes(urls):
            p = self.probabilities(buf, at)
            sums += np.bincount(owner, weights=np.log(p[1]) - np.log(p[0]), minlength=len(urls))
            sizes += np.bincount(owner, minlength=len(urls))
        return np.round(sums / np.maximum(sizes, 1), 9)


@dataclass(frozen=True)
class UrlModel:
    """A stored table of counts (key, n0, n1, k0, k1), its number of rows, and a threshold."""

    table: DataFrame
    rows: int
    threshold: float = -np.inf


def _counts(known: DataFrame) -> DataFrame:
    """Exact counts of all contexts of up to ORDER bytes: a row for each byte seen after one, and one for the context itself."""
    cells = known.mapInArrow(_count, "key long, n0 long, n1 long")
    cells = materialise(cells.groupBy("key").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1")), "url-cells")
    context = F.shiftleft(F.shiftright("key", 9), 9).bitwiseOR(F.lit(ANY)).alias("key")
    seen = lambda c: F.count_if(F.col(c) > 0)
    contexts = cells.groupBy(context).agg(
        F.sum("n0").alias("n0"), F.sum("n1").alias("n1"), seen("n0").alias("k0"), seen("n1").alias("k1")
    )
    none = F.lit(0).cast("long")
    return materialise(cells.select("key", "n0", "n1", none.alias("k0"), none.alias("k1")).union(contexts), "url-counts")


def fit(pages: DataFrame, rules: Sequence[Rule], *, url_col: str = "url") -> UrlModel:
    """Fit the two models on the URLs that rules allow and block, and set the threshold on held-out ones.

    One URL in HELD, chosen by hash, is held out; the threshold gets the largest share of both kinds right, in the middle of the best range.
    Every row counts, repeats too. If either kind is missing, everything without a rule is allowed. Counts are exact and stay a table, which
    grows with the contexts that occur; they are summed in every task before the shuffle.
    """
    url = F.col(url_col)
    known = pages.select(url.alias("url"), rule_of(rules, host_of(url), path_of(url))["verdict"].alias("verdict"))
    known = known.where("verdict is not null").select("url", (F.col("verdict") == "allow").alias("good"))
    held = F.pmod(F.xxhash64("url"), F.lit(HELD)) == 0
    counts = _counts(known.where(~held))
    rows, bad, good = counts.agg(F.count("*"), F.max("n0"), F.max("n1")).first()
    model = UrlModel(counts, rows)
    if not (bad and good):
        return model
    step = F.floor(F.col("score") * STEPS).alias("step")
    steps = with_scores(known.where(held), model).select("good", step).groupBy("step").agg(
        F.count(F.when(~F.col("good"), 1)), F.count(F.when(F.col("good"), 1))
    )
    steps = sorted(tuple(r) for r in steps.collect())
    bad, good = sum(r[1] for r in steps), sum(r[2] for r in steps)
    if not (bad and good):
        return replace(model, threshold=0.0)
    best, ends, right = (-1.0, 0.0), [s[0] for s in steps], 0.0
    for i, (at, b, g) in enumerate(steps[:-1]):
        right += b / bad - g / good
        if right > best[0]:
            best = (right, (at + 1 + ends[i + 1]) / 2 / STEPS)
    return replace(model, threshold=best[1])


def with_scores(rows: DataFrame, model: UrlModel, *, url_col: str = "url") -> DataFrame:
    """`rows` with the model's `score` of every URL; null is scored like an empty one.

    A model of at most BROADCAST_ROWS rows goes to every task. A larger one is joined with the distinct URLs, block by block, by the keys
    that occur in a block, and the scores with the rows.
    """
    if model.rows <= BROADCAST_ROWS:
        return rows.withColumn("score", _score_by_broadcast(model, F.col(url_col)))
    scores = materialise(_score_by_join(rows.select(F.coalesce(url_col, F.lit("")).alias("_url")).distinct(), model), "url-scores")
    return rows.withColumn("_url", F.coalesce(url_col, F.lit(""))).join(scores, "_url").drop("_url")


def _arrays(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    return table["key"].to_numpy(), np.array([table[c].to_numpy() for c in ("n0", "n1", "k0", "k1")], np.int64)


def _score_by_broadcast(model: UrlModel, url: Column) -> Column:
    context = model.table.sparkSession.sparkContext
    shared = context.broadcast(_arrays(model.table.toArrow()))  # BROADCAST_ROWS at most

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = UrlCounts(*shared.value)
        for urls in batches:
            yield pd.Series(own.score(urls.tolist()))

    return score(url)


def _score_by_join(urls: DataFrame, model: UrlModel) -> DataFrame:
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """URLs in numbered blocks; the first row of a block holds the keys that occur in it."""
        number = TaskContext.get().partitionId() << 40
        for batch in batches:
            column, start = batch.column(0).to_pylist(), 0
            while start < len(column):
                size, stop = 0, start
                while stop < len(column) and (stop == start or size < BLOCK):
                    size += len(column[stop])
                    stop += 1
                some = column[start:stop]
                found = [np.unique(np.concatenate(pair)) for buf, at, _ in _bytes(some) for pair in _keys(buf, at)]
                keys = [np.unique(np.concatenate(found))] + [None] * (len(some) - 1)
                columns = [pa.array(some), pa.array([number] * len(some)), pa.array(keys, pa.list_(pa.int64()))]
                yield pa.RecordBatch.from_arrays(columns, ["_url", "block", "keys"])
                start, number = stop, number + 1

    packed = materialise(urls.mapInArrow(pack, "_url string, block long, keys array<long>"), "url-blocks")
    held = packed.where("keys is not null").select(F.col("block").alias("home"), F.explode("keys").alias("key"))
    known = held.join(model.table, "key")

    def score(rows: pa.Table, counts: pa.Table) -> pa.Table:
        scores = UrlCounts(*_arrays(counts)).score(rows["_url"].to_pylist())
        return pa.table({"_url": rows["_url"], "score": scores})

    rows = packed.select("_url", "block")
    return rows.groupBy("block").cogroup(known.groupBy("home")).applyInArrow(score, "_url string, score double")


def judge_urls(pages: DataFrame, rules: Sequence[Rule], model: UrlModel, *, url_col: str = "url") -> DataFrame:
    """Judge every URL by the longest rule that fits, or else by the model.

    Returns `whole` (the input row as a struct, so names cannot clash), `host`, `path`, `rule` (such as `net/`, or null),
    `score` (mean log ratio per byte of the whole URL, A-Z in lower case) and `verdict`: the rule's, else `allow` if the score reaches the threshold,
    else `block`. A null URL, or one without ://, has an empty host and path and fits no rule; null is scored like an empty URL.
    Repeated URLs are judged alike.
    """
    url = F.col(url_col)
    rows = pages.select(
        F.struct(*pages.columns).alias("whole"), host_of(url).alias("host"), path_of(url).alias("path"), url.alias("url")
    )
    rows = with_scores(rows, model)
    rows = rows.withColumn("fits", rule_of(rules, F.col("host"), F.col("path")))
    by_model = F.when(F.col("score") >= float(model.threshold), "allow").otherwise("block")
    return rows.select(
        "whole", "host", "path", F.col("fits.name").alias("rule"), "score",
        F.coalesce(F.col("fits.verdict"), by_model).alias("verdict"),
    )
