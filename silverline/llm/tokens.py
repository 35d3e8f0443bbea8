"""Words and word n-grams of many texts at once, as numpy arrays, for functions that run on Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes that are hashed together; longer texts are cut between words.
PIECE = 1 << 18
_ODD = np.uint64(0x9E3779B97F4A7C15)
_GRAM = np.uint64(0xD6E8FEB86659FD93)

_rng = np.random.default_rng(20240229)
_BYTES = _rng.integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)

_all = np.arange(256)
#: Everything but ASCII white space.
SPACED = ~((_all == 0x20) | ((_all >= 0x09) & (_all <= 0x0D)))
#: Digits, letters and everything beyond ASCII.
ALNUM = (
    ((_all >= 0x30) & (_all <= 0x39))
    | ((_all >= 0x41) & (_all <= 0x5A))
    | ((_all >= 0x61) & (_all <= 0x7A))
    | (_all >= 0x80)
)
_lower = np.where((_all >= 0x41) & (_all <= 0x5A), _all + 32, _all)
EXACT, LOWER = _BYTES, _BYTES[_lower]


class _Powers:
    """Powers of an odd base modulo 2**64 and of its inverse, as far as needed so far."""

    def __init__(self, base: np.uint64):
        self.base, self.inverse = base, np.uint64(pow(int(base), -1, 2**64))
        self.up, self.down = np.ones(1, np.uint64), np.ones(1, np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 2 * len(self.up))
            for name, base in (("up", self.base), ("down", self.inverse)):
                values = np.full(size, base, np.uint64)
                values[0] = 1
                setattr(self, name, np.multiply.accumulate(values))
        return self.up[:n], self.down[:n]


_byte_powers, _gram_powers = _Powers(_ODD), _Powers(_GRAM)


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of polynomial hashes."""
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(32))


def hash_words(
    data: bytes, is_word: np.ndarray = SPACED, values: np.ndarray = EXACT
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and 64-bit hash of every word. Working memory stays near PIECE whatever the length."""
    buf = np.frombuffer(data, np.uint8)
    found, at = [], 0
    while at < len(buf):
        end = min(len(buf), at + PIECE)
        while end < len(buf) and is_word[buf[end]]:  # not within a word
            ahead = np.flatnonzero(~is_word[buf[end : end + PIECE]])
            end = end + int(ahead[0]) if len(ahead) else min(len(buf), end + PIECE)
        piece = buf[at:end]
        edge = np.diff(is_word[piece].view(np.int8), prepend=np.int8(0), append=np.int8(0))
        starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        up, down = _byte_powers.upto(len(piece) + 1)
        sums = np.zeros(len(piece) + 1, np.uint64)
        np.cumsum(values[piece] * up[:-1], out=sums[1:])
        found.append((starts + at, ends + at, mix((sums[ends] - sums[starts]) * down[starts])))
        at = end
    if not found:
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(0, np.uint64)
    return tuple(np.concatenate(x) for x in zip(*found))


class Grams:
    """Hashes of runs of consecutive words."""

    def __init__(self, hashes: np.ndarray):
        up, self.down = _gram_powers.upto(len(hashes) + 1)
        self.sums = np.zeros(len(hashes) + 1, np.uint64)
        np.cumsum(hashes * up[:-1], out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.down[start])

    def all(self, n: int) -> np.ndarray:
        """Hash of the n words from each position on."""
        if len(self.sums) <= n:
            return np.zeros(0, np.uint64)
        return mix((self.sums[n:] - self.sums[:-n]) * self.down[: len(self.sums) - n])


def small(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """The same rows in smaller batches, so that what a task builds from them stays small."""
    for batch in batches:
        for at in range(0, len(batch), rows):
            yield batch.slice(at, rows)


class Texts:
    """Some consecutive rows of a batch: their texts joined by newlines, and the words of all."""

    def __init__(self, rows: range, texts: list[bytes], is_word: np.ndarray, values: np.ndarray):
        self.rows, self.texts = rows, texts
        self.data = b"\n".join(texts)
        sizes = np.array([len(t) + 1 for t in texts], np.int64)
        at = np.concatenate(([0], np.cumsum(sizes)))
        self.starts, self.ends, self.hashes = hash_words(self.data, is_word, values)
        #: Words of row i: first[i] to first[i + 1].
        self.first = np.searchsorted(self.starts, at)
        self.row_of = np.repeat(np.arange(len(texts)), np.diff(self.first))


def text_chunks(
    column: pa.Array, is_word: np.ndarray = SPACED, values: np.ndarray = EXACT, size: int = 2 * PIECE
) -> Iterator[Texts]:
    """Texts of an Arrow column in groups of about `size` bytes; null reads as empty."""
    held, total, first = [], 0, 0
    for i, text in enumerate(column.cast(pa.large_binary())):
        text = text.as_py() or b""
        if held and total + len(text) > size:
            yield Texts(range(first, i), held, is_word, values)
            held, total, first = [], 0, i
        held.append(text)
        total += len(text)
    if held:
        yield Texts(range(first, len(column)), held, is_word, values)
