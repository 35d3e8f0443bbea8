"""Periodic runs of words: stretches that repeat one and the same sequence several times over."""

from __future__ import annotations

from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Words hashed together when looking for stretches of long period.
GRAM = 8
_BASE = np.uint64(0x9E3779B97F4A7C15)

RESULT = pa.struct(
    [
        ("n_words", pa.int64()),
        ("runs", pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))),
        ("kept", pa.large_string()),
    ]
)


class SuffixAutomaton:
    """Suffix automaton of the words appended so far, whose suffix links are kept as a link-cut forest.

    A preferred path of the forest is the stretch of states whose words ended last at the same place, its colour, which is held at
    the root of the path's splay tree. Appending a word adds its state (and cuts a clone into a link where one is due), then
    accesses it: every path segment met on the way up gives the colour `e` of the segment and the length `l` of its lowest
    state, that is, the longest suffix that also ends at `e`. The whole way then takes the colour of the new end. The segments met
    are logarithmic in number, amortised, however repetitive the words are. States are flat arrays: about 100 bytes a word.
    """

    def __init__(self):
        # state 0 stands for nothing in the forest; in the automaton it is the root
        self.length, self.link = array("i", [0]), array("i", [-1])
        # most states have one way on, which needs no dictionary
        self.word, self.target, self.more = array("i", [-1]), array("i", [0]), {}
        self.left, self.right, self.up, self.colour = (array("i", [0]) for _ in range(4))
        self.last, self.size = 0, 0

    def _state(self, length: int, link: int) -> int:
        self.length.append(length)
        self.link.append(link)
        for column in (self.target, self.left, self.right, self.up, self.colour):
            column.append(0)
        self.word.append(-1)
        return len(self.length) - 1

    def _next(self, state: int, word: int) -> int:
        """Where a word leads from a state; 0 if nowhere."""
        if self.word[state] == word:
            return self.target[state]
        ways = self.more.get(state)
        return ways.get(word, 0) if ways else 0

    def _lead(self, state: int, word: int, target: int) -> None:
        if self.word[state] in (-1, word):
            self.word[state], self.target[state] = word, target
        else:
            self.more.setdefault(state, {})[word] = target

    def _splay(self, x: int) -> None:
        """Make `x` the root of its path's tree; the colour moves with the root."""
        up, left, right = self.up, self.left, self.right
        while True:
            p = up[x]
            if not p or (left[p] != x and right[p] != x):
                return
            g = up[p]
            if g and (left[g] == p or right[g] == p):
                self._rotate(p if (left[g] == p) == (left[p] == x) else x)
            self._rotate(x)

    def _rotate(self, x: int) -> None:
        up, left, right = self.up, self.left, self.right
        p = up[x]
        g = up[p]
        if left[p] == x:
            inner = left[p] = right[x]
            right[x] = p
        else:
            inner = right[p] = left[x]
            left[x] = p
        if inner:
            up[inner] = p
        up[p], up[x] = x, g
        if g and left[g] == p:
            left[g] = x
        elif g and right[g] == p:
            right[g] = x
        else:
            self.colour[x] = self.colour[p]

    def _clone(self, q: int, length: int) -> int:
        """A state for the shorter words of `q`, put between `q` and its link, on q's path."""
        c = self._state(length, self.link[q])
        self.word[c], self.target[c] = self.word[q], self.target[q]
        if q in self.more:
            self.more[c] = dict(self.more[q])
        self.link[q] = c
        self._splay(q)
        above = self.left[c] = self.left[q]
        if above:
            self.up[above] = c
        self.left[q], self.up[c] = c, q
        return c

    def append(self, word: int) -> list[tuple[int, int]]:
        """Add a word and return, for every segment met, (end of its last occurrence before, length)."""
        end = self.size
        self.size += 1
        length, link = self.length, self.link
        new = self._state(end + 1, 0)
        p = self.last
        while p >= 0 and not self._next(p, word):
            self._lead(p, word, new)
            p = link[p]
        if p >= 0:
            q = self._next(p, word)
            if length[q] != length[p] + 1:
                c = self._clone(q, length[p] + 1)
                while p >= 0 and self._next(p, word) == q:
                    self._lead(p, word, c)
                    p = link[p]
                q = c
            link[new] = q
        self.last = new
        # access: the new state, then every path above it
        up, right, colour = self.up, self.right, self.colour
        met, below, u = [], new, link[new]
        up[new] = u
        while u:
            self._splay(u)
            met.append((colour[u], length[u]))
            cut = right[u]
            if cut:
                colour[cut] = colour[u]
            right[u] = below
            below, u = u, up[u]
        colour[below] = end
        return met


def runs_of(words: list[int], least: int, times: int) -> list[tuple[int, int, int]]:
    """(start, length, period) of the runs of at least `least` words and `times` periods, by start and period."""
    found, automaton = {}, SuffixAutomaton()
    for end, word in enumerate(words):
        for before, same in automaton.append(word):
            period = end - before
            # a suffix that also ended `period` words ago: both make one stretch of that period
            if same >= (times - 1) * period and same + period >= least:
                found[end - period - same + 1, period] = end
    return sorted((start, end - start + 1, period) for (start, period), end in found.items())


def _distance(values: np.ndarray) -> np.ndarray:
    """How far back each value was last seen; the number of values if never."""
    n = len(values)
    order = np.argsort(values, kind="stable")
    held = values[order]
    back = np.full(n, n, np.int64)
    same = np.flatnonzero(held[1:] == held[:-1])
    back[order[same + 1]] = order[same + 1] - order[same]
    return back


def _stretches(near: np.ndarray, least: int) -> np.ndarray:
    """(first, last + 1) of the unbroken true stretches of at least `least` places."""
    edge = np.diff(near.view(np.int8), prepend=np.int8(0), append=np.int8(0))
    ends = np.stack((np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)), 1)
    return ends[ends[:, 1] - ends[:, 0] >= least]


def zones(words: np.ndarray, least: int, times: int) -> list[tuple[int, int]]:
    """Places that together hold every run whole, and one word on either side of it.

    After its first period q every word of a run was seen within the last q words, and so was every sequence of GRAM words. For
    periods below GRAM, then for each doubling of the period, places where that holds for as long as a run needs are widened by the
    period; what remains can hold no run. `times` must be at least 2.
    """
    n = len(words)
    if n < least:
        return []
    out = []
    back = _distance(words)
    near = back < GRAM
    need = max(1, min(max(least - q, (times - 1) * q) for q in range(1, GRAM)))
    for a, b in _stretches(near, need):
        out.append((a - GRAM, b + 1))
    if n >= times * GRAM:
        with np.errstate(over="ignore"):
            grams = np.zeros(n - GRAM + 1, np.uint64)
            for k in range(GRAM):
                grams = grams * _BASE + words[k : n - GRAM + 1 + k].astype(np.uint64)
                grams ^= grams >> np.uint64(29)
        back = _distance(grams)
        q = GRAM
        while times * q <= n and (back <= n // times).any():
            # periods q to 2 q - 1
            for a, b in _stretches(back < 2 * q, max(1, (times - 1) * q - GRAM + 1)):
                out.append((a - 2 * q, b + GRAM))
            q *= 2
    merged = []
    for a, b in sorted((max(0, int(a)), min(n, int(b))) for a, b in out):
        if merged and a <= merged[-1][1]:
            merged[-1] = merged[-1][0], max(b, merged[-1][1])
        else:
            merged.append((a, b))
    return merged


def _text(data: bytes, least: int, times: int) -> tuple[int, list[dict], str]:
    words, numbers = data.split(), {}  # bytes.split parts at the six ASCII spaces and nothing else
    ids = np.array([numbers.setdefault(w, len(numbers)) for w in words], np.int32)
    found = []
    for a, b in zones(ids, least, times):
        found += [(a + start, length, period) for start, length, period in runs_of(ids[a:b].tolist(), least, times)]
    gone = np.zeros(len(words) + 1, np.int32)
    for start, length, period in found:
        gone[start + period] += 1
        gone[start + length] -= 1
    kept = words
    if found:
        kept = [words[i] for i in np.flatnonzero(np.cumsum(gone[:-1]) == 0)]
    rows = [{"start": s, "length": n, "period": p} for s, n, p in sorted(found, key=lambda r: (r[0], r[2]))]
    return len(words), rows, b" ".join(kept).decode()


def find_runs(docs: DataFrame, text: str = "text", *, least: int = 6, times: int = 4) -> DataFrame:
    """Runs of every text, and the text without their repeats: columns `whole` (the row), `n_words`, `runs`, `kept`.

    A run is a stretch of words with smallest period q (words q apart are the same) and at least `least` words and `times` (2 or more)
    periods, which neither neighbour continues. `runs` holds (start, length, period) by start and period. `kept` are the words, joined by
    one space, that no run contains after its first q words.

    Each text is judged on its own, so no row waits for another: null and empty texts have no words and an empty `kept`; repeated
    rows and ids are judged alike; extra columns of any name stay within `whole`. Working memory follows the longest text
    (about 100 bytes for each word that may lie in a run).
    """
    if times < 2 or least < 2:
        raise ValueError("runs need at least two words and two periods")

    def judge(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            rows = (_text(t.as_py() or b"", least, times) for t in batch.cast(pa.large_binary()))
            yield pa.array([dict(zip(("n_words", "runs", "kept"), r)) for r in rows], RESULT)

    returns = "n_words long, runs array<struct<start: long, length: long, period: long>>, kept string"
    judged = F.arrow_udf(judge, returns)
    rows = docs.select(F.struct("*").alias("whole"))
    return rows.withColumn("found", judged(F.col("whole")[text])).select("whole", "found.*")
