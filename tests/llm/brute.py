"""Plain Python versions of what the operators must return."""

import hashlib
import re
from collections import defaultdict

import numpy as np
import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def contamination(docs, items):
    windows = defaultdict(set)
    for item, text in items:
        w = ALNUM.findall(lower(text or ""))
        for k in range(max(1, len(w) - 12) if w else 0):
            windows[tuple(w[k : k + 13])].add("" if item is None else str(item))
    out = []
    for doc, text in docs:
        w, hit, found = ALNUM.findall(lower(text or "")), set(), set()
        for n in {len(x) for x in windows}:
            for k in range(len(w) - n + 1):
                if (x := tuple(w[k : k + n])) in windows:
                    hit.update(range(k, k + n))
                    found |= windows[x]
        out.append((doc, len(w), len(hit), ",".join(sorted(found)), len(hit) > 0 and 20 * len(hit) >= len(w)))
    return out


def fingerprint(text, n=3):
    w = WORD.findall(lower(text or ""))
    shingles = [" ".join(w[k : k + n]) for k in range(len(w) - n + 1)] or ([" ".join(w)] if w else [])
    hashes = [xxhash.xxh64_intdigest(x.encode(), 42) for x in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(prints, distance=3):
    """Smallest id reachable from each (id, fingerprint)."""
    distinct = sorted({f for _, f in prints})
    parent = {f: f for f in distinct}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    values = np.array(distinct, np.uint64)
    for k, f in enumerate(distinct):
        for j in np.flatnonzero(np.bitwise_count(values[k + 1 :] ^ values[k]) <= distance):
            parent[find(distinct[k + 1 + j])] = find(f)
    least = {}
    for doc, f in prints:
        least[find(f)] = min(least.get(find(f), doc), doc)
    return {(doc, f): least[find(f)] for doc, f in prints}


def line_dedup(docs, min_chars, min_docs):
    white = " \t\n\x0b\x0c\r"
    holders = defaultdict(list)
    for n, (doc, text) in enumerate(docs):
        for key in {lower(x.strip(white)) for x in (text or "").split("\n")}:
            if len(key) >= min_chars:
                holders[key].append((doc is not None, doc or 0, n))
    out = []
    for doc, text in docs:
        lines = (text or "").split("\n")
        kept = []
        for x in lines:
            held = holders.get(lower(x.strip(white)), [])
            if len(held) >= min_docs and (doc is not None, doc or 0) < max(held)[:2]:
                continue
            kept.append(x)
        out.append((doc, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def substring_dedup(docs, window):
    rank = lambda doc: (doc is None, doc or 0)
    first = {}
    for doc, text in sorted(docs, key=lambda d: rank(d[0])):
        w = WORD.findall(text or "")
        for k in range(len(w) - window + 1):
            first.setdefault(tuple(w[k : k + window]), rank(doc))
    out = []
    for doc, text in docs:
        w, gone = WORD.findall(text or ""), set()
        for k in range(len(w) - window + 1):
            if first[tuple(w[k : k + window])] < rank(doc):
                gone.update(range(k, k + window))
        out.append((doc, len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone)))
    return out


def quality_counts(text):
    text = text or ""
    w, seen, dup = WORD.findall(text), set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    places = defaultdict(list)
    for k in range(len(w) - 4):
        places[tuple(w[k : k + 5])].append(k)
    covered = {i for at in places.values() if len(at) > 1 for k in at for i in range(k, k + 5)}
    n, r = len(w), len(covered)
    symbols = len(re.findall(r"[#*$%&|<>]", text))
    return n, sum(map(len, w)), symbols, dup, r, n < 10 or 100 * r > 20 * n


def targets(sizes, weights=(3, 1, 2), share=1.5, limit=2.0):
    """Shares handed out again and again until no source is above its limit."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    left, free, out = share * sum(sizes.values()), set(order), {}
    while free:
        given = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = {s for s in free if given[s] >= limit * sizes[s]}
        if not over:
            return out | given
        for s in over:
            out[s] = limit * sizes[s]
            left -= out[s]
        free -= over
    return out
