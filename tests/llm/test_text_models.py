"""Runs of words, tokenizer alignment and toxicity against plain Python versions."""

import hashlib
import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from silverline.llm import alignment, queries, runs, toxicity
from silverline.llm.common import table as read
from tests.llm import brute
from tests.llm.conftest import table

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    return [tuple(r) for r in read(spark, SF_DIR, "documents").select("doc_id", "text").collect()]


# -- runs ---------------------------------------------------------------------


def brute_runs(w, least=6, times=4):
    """Every stretch with equal words q apart, from the smallest q on."""
    out = {}
    for q in range(1, len(w) // times + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            length = j - i + q
            if length >= max(least, times * q) and not any(s <= i and i + length <= e and q % p == 0 for s, e, p in out):
                out[i, i + length, q] = True
            i = max(i + 1, j)
    return sorted(((s, e - s, q) for s, e, q in out), key=lambda r: (r[0], r[2]))


def collapsed(w, found):
    gone = {i for s, n, p in found for i in range(s + p, s + n)}
    return " ".join(x for i, x in enumerate(w) if i not in gone)


def test_runs_equal_brute_force():
    rng = random.Random(3)
    for _ in range(1500):
        letters = rng.choice([1, 2, 2, 3, 6])
        w = [rng.randrange(letters) for _ in range(rng.randrange(90))]
        for _ in range(rng.randrange(3)):
            if len(w) > 4:
                a, p = rng.randrange(len(w)), rng.randrange(1, 14)
                for i in range(a, rng.randrange(a, len(w))):
                    w[i] = w[a + (i - a) % p]
        expected = brute_runs(w)
        assert runs.runs_of(w, 6, 4) == expected
        cut = [(a + s, n, p) for a, b in runs.zones(np.array(w, np.int32), 6, 4) for s, n, p in runs.runs_of(w[a:b], 6, 4)]
        assert sorted(cut, key=lambda r: (r[0], r[2])) == expected


def test_long_periods():
    rng = random.Random(4)
    for p, n in ((3000, 12_001), (700, 5_000), (1, 30_000)):
        w = [rng.randrange(50_000) for _ in range(40)] + [k % p + 60_000 for k in range(n)] + [7, 8]
        (a, b), = runs.zones(np.array(w, np.int32), 6, 4)
        assert [(a + s, *r) for s, *r in runs.runs_of(w[a:b], 6, 4)] == [(40, n, p)]


def test_find_runs(spark, odd_docs):
    out = runs.find_runs(odd_docs.withColumn("runs", F.lit("theirs"))).select("whole.text", "whole.runs", "n_words", F.col("runs").alias("found"), "kept")
    rows = out.collect()
    assert len(rows) == odd_docs.count()
    for r in rows:
        w = brute.WORD.findall(r.text or "")
        expected = brute_runs(w)
        assert (r.runs, r.n_words, [tuple(x) for x in r.found], r.kept) == ("theirs", len(w), expected, collapsed(w, expected))
    assert runs.find_runs(odd_docs.where("false")).count() == 0
    with pytest.raises(ValueError, match="two periods"):
        runs.find_runs(odd_docs, times=1)


def test_runs_query(spark, docs):
    expected = []
    for doc, text in docs:
        w, h = brute.WORD.findall(text or ""), zlib.crc32(str(doc).encode())
        g = h // 10
        if h % 10 == 0 and w:
            a = g % len(w)
            p = 1 + (len(w) - a) // (3 + g % 8)
            w = [x if i < a else w[a + (i - a) % p] for i, x in enumerate(w)]
        found = brute_runs(w)
        best = min(found, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=None)
        spelt = "".join(f"{s},{n},{p}\n" for s, n, p in found)
        four = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
        expected.append((doc, len(found), *four, brute.sha(spelt), brute.sha(collapsed(w, found))))
    assert table(queries.op12_runs(spark, SF_DIR)) == sorted(expected, key=repr)
    assert any(r[1] for r in expected)


# -- tokenizers ---------------------------------------------------------------

ODD_TEXTS = [None, "", " ", "  a", "a  ", "\n\n", "<s> </s> <|endoftext|> <unk>", "a▁b", "é́😀 漢字", "\x00\x01 a", "a" * 3000, "\r\n", " " * 2500 + "x", "don't 'll"]


@pytest.fixture(scope="module")
def models():
    a = alignment.ByteLevel.read(f"{queries.TOKENIZERS}/byte_bpe_50k.json")
    return a, alignment.Pieces.read(f"{queries.TOKENIZERS}/piece_bpe_32k.model")


def library_tokens(models):
    """Ids and bytes of their tokens by the libraries alone."""
    import sentencepiece
    import tokenizers

    a = tokenizers.Tokenizer.from_buffer(models[0].data)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_proto=models[1].data)
    pieces = [m.load()[1] for m in models]

    def tokens(text):
        if not text:
            return [], []
        ids = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
        sides = [[(i, p[i]) for i in x] for x, p in zip(ids, pieces)]
        lost = any(b"".join(t for _, t in side) != (" " + text).encode() for side in sides)
        return ([], []) if lost else sides

    return tokens


def brute_alignment(texts, tokens):
    rows, held = [], Counter()
    for text in texts:
        a, b = tokens(text)
        spans = []
        for side in (a, b):
            at, mine = 0, []
            for i, t in side:
                mine.append((at, at + len(t), i))
                at += len(t)
            spans.append(mine)
        links, j = [], 0
        for s, e, i in spans[0]:
            while j and spans[1][j - 1][1] > s:
                j -= 1
            while j < len(spans[1]) and spans[1][j][0] < e:
                if spans[1][j][1] > s:
                    links.append((i, spans[1][j][2]))
                j += 1
        cuts = sorted({e for _, e, _ in spans[0]} & {e for _, e, _ in spans[1]})
        groups, start = [], 0
        for cut in cuts:
            sides = [",".join(str(i) for s, e, i in side if start < e <= cut) for side in spans] if len(cuts) < 400 else None
            groups.append("|".join(sides) if sides else None)
            start = cut
        rows.append((len(a), len(b), len(cuts), links, ";".join(groups) if None not in groups else None))
        held.update(set(links))
    best = defaultdict(int)
    for (i, _), n in held.items():
        best[i] = max(best[i], n)
    return [(na, nb, ng, len(x), sum(held[p] == best[p[0]] for p in x), sum(held[p] for p in x), g) for na, nb, ng, x, g in rows]


def test_both_encoders_agree(models):
    """Ranks, the library, and parts of long texts give the same ids."""
    import tokenizers

    encode, _ = models[0].load()
    assert encode.__name__ == "encode_fast"
    whole = tokenizers.Tokenizer.from_buffer(models[0].data)
    whole.encode_special_tokens = True
    texts = [t for t in ODD_TEXTS if t] + [f"a{chr(c)}b {chr(c)}1 {chr(c)}'s " for c in range(1, 0x3000)]
    assert encode(texts) == [e.ids for e in whole.encode_batch([" " + t for t in texts], add_special_tokens=False)]
    text = "".join(texts[:3000])
    assert " ".join(alignment._cut(text, 50)) == text
    for model in models:
        encode, _ = model.load()
        assert sum(encode(alignment._cut(text, 50)), []) == encode([text])[0]


def test_gallop():
    rng = np.random.default_rng(1)
    for n in (1, 2, 50, 3000):
        among = np.cumsum(rng.integers(1, 9, n))
        values = np.unique(rng.integers(1, among[-1] + 1, n))
        for guess in (np.zeros(len(values), np.int64), rng.integers(0, n, len(values)), np.full(len(values), n - 1)):
            assert (alignment._gallop(values, among, guess) == np.searchsorted(among, values)).all()


def test_alignment(spark, odd_docs, pairs, models, monkeypatch):
    extra = spark.createDataFrame([(900 + i, t) for i, t in enumerate(ODD_TEXTS)], "doc_id long, text string")
    given = odd_docs.unionByName(extra, allowMissingColumns=True).withColumn("block", F.lit("x")).withColumn("pairs", F.lit(1))
    texts = [t for _, t in pairs] + ODD_TEXTS
    ids = [d for d, _ in pairs] + [900 + i for i in range(len(ODD_TEXTS))]
    expected = brute_alignment(texts, library_tokens(models))
    out = alignment.align_tokenizers(spark, given, *models, block=3000)
    names = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]
    found = out.select("kept.doc_id", *names, "groups").collect()
    assert sorted(tuple(r)[:7] for r in found if r[0] is not None) == sorted((d, *e[:6]) for d, e in zip(ids, expected) if d is not None)
    spelt = {(d, *e[:4]): e[6] for d, e in zip(ids, expected) if e[6] is not None}
    assert all(spelt.get(tuple(r)[:5], r.groups) == r.groups for r in found)
    assert len(found) == len(texts)
    assert alignment.align_tokenizers(spark, given.where("false"), *models).count() == 0


def test_alignment_query(spark, docs, models):
    expected = brute_alignment([t for _, t in docs], library_tokens(models))
    found = {r.doc_id: tuple(r)[1:] for r in queries.op13_alignment(spark, SF_DIR).collect()}
    assert len(found) == len(docs)
    for (doc, _), e in zip(docs, expected):
        assert found[doc][:6] == e[:6]
        if e[6] is not None:
            assert found[doc][6] == (hashlib.sha256(e[6].encode()).hexdigest() if e[0] else "")


# -- toxicity -----------------------------------------------------------------


def test_index_is_exact():
    rng = np.random.default_rng(2)
    dense = rng.random((500, 40)) * (rng.random((500, 40)) < 0.1)
    dense[:, 39] = 0.3
    dense[100:120] = dense[7]
    dense /= np.linalg.norm(dense, axis=1, keepdims=True)
    terms = [np.flatnonzero(row) for row in dense]
    index = toxicity.BlockMaxIndex(terms, [row[t] for row, t in zip(dense, terms)], 40, block=8)
    for row, t in zip(dense[::7], terms[::7]):
        near, score = index.search(t, row[t], 12)
        everything = np.sort(dense @ row)[::-1]
        assert np.allclose(score, everything[:12]) and np.allclose(dense[near] @ row, score)


def test_documents_of_a_term_are_counted_by_task(spark):
    """Copies with many terms leave their task as one row a term."""
    rows = [(i, list(range(50)) if i % 2 else [] if i % 3 else [i % 5, 60]) for i in range(1000)]
    vectors = spark.createDataFrame(rows, "id long, terms array<int>").repartition(4)
    counted = vectors.select("terms").mapInArrow(toxicity._holding, "term long, n long").collect()
    assert len(counted) <= 4 * 51
    found = Counter()
    for r in counted:
        found[r.term] += r.n
    assert found == Counter(t for _, terms in rows for t in terms)


def test_fitting_makes_no_row_for_each_term_of_a_document(spark, monkeypatch):
    plans, collect = [], type(spark.range(1)).collect
    monkeypatch.setattr(type(spark.range(1)), "collect", lambda df: plans.append(df._jdf.queryExecution().optimizedPlan().toString()) or collect(df))
    texts = spark.range(200).selectExpr("id as doc_id", "if(id % 2 = 0, 'you fool again', 'a fine day') as text")
    toxicity.score_toxicity(spark, texts, texts.selectExpr("doc_id as id", "int(doc_id % 2 = 0) as label"))
    assert plans and not any("Generate" in p for p in plans)


def test_rising():
    at, share = toxicity._rising(np.array([0.0, 0.1, 0.5, 0.9]), np.array([90.0, 10, 10, 10]), np.array([0.0, 5, 3, 10]))
    assert (np.diff(at) > 0).all() and (np.diff(share) >= 0).all() and 0 < share[0] and share[-1] < 1


def labelled(spark, n=400):
    """Texts with an insult are toxic, but for one in twenty."""
    rng, rows, marks = random.Random(8), [], []
    for i in range(n):
        w = [f"w{rng.randrange(300)}" for _ in range(rng.randrange(1, 60))]
        toxic = i % 4 == 0
        if toxic:
            w += rng.sample(["moron", "scum", "clown", "trash"], 2)
        rows.append((i, " ".join(rng.sample(w, len(w))), "x"))
        marks.append((i, int(toxic != (i % 20 == 1))))
    return spark.createDataFrame(rows, "doc_id long, text string, score string"), spark.createDataFrame(marks, "id long, label int")


def test_scores_equal_brute_force(spark):
    docs, marks = labelled(spark)
    found = toxicity.score_toxicity(spark, docs, marks, keep=("doc_id", "text"))
    rows = found.select("kept.*", "score", "evidence").collect()
    counts = {r.doc_id: toxicity._term_counts(r.text) for r in rows}
    label = {r.id: r.label for r in marks.collect()}
    n1 = sum(label.values())
    n0 = len(label) - n1
    held = Counter(w for d in counts for w in counts[d])
    toxic = Counter(w for d in counts for w in counts[d] if label[d])

    def telling(w):
        a, b, n = toxic[w], held[w] - toxic[w], n0 + n1
        chi = n * max(0, abs(a * (n0 - b) - b * (n1 - a)) - n / 2) ** 2 / max(1, held[w] * (n - held[w]) * n0 * n1)
        odds = (a + 0.5) * (n0 - b + 0.5) / ((b + 0.5) * (n1 - a + 0.5))
        return held[w] > 1 and chi >= toxicity.CHI_SQUARE and abs(math.log(odds)) >= math.log(toxicity.ODDS)

    words = sorted(w for w in held if telling(w))
    assert {"moron", "scum", "clown", "trash"} <= set(words)
    idf = {w: math.log((1 + len(counts)) / (1 + held[w])) + 1 for w in words}

    def vector(c):
        v = {"": 1.0} | {w: (1 + math.log(c[w])) * idf[w] for w in words if w in c}
        size = math.sqrt(sum(x * x for x in v.values()))
        return {w: x / size for w, x in v.items()}

    vectors = {d: vector(c) for d, c in counts.items()}
    for r in rows[::9]:
        mine = vectors[r.doc_id]
        distinct = {tuple(sorted(v.items())) for v in vectors.values()}
        near = sorted((sum(x * dict(v).get(w, 0) for w, x in mine.items()) for v in distinct), reverse=True)
        assert np.allclose([e.similarity for e in r.evidence], near[: toxicity.NEIGHBOURS])
        assert all(e.n_toxic <= e.n for e in r.evidence)
    high = [r.score for r in rows if {"moron", "scum", "clown", "trash"} & set(counts[r.doc_id])]
    low = [r.score for r in rows if not {"moron", "scum", "clown", "trash"} & set(counts[r.doc_id])]
    assert min(high) >= 0.7 > 0.2 > max(low)


def test_odd_rows_are_scored(spark, odd_docs):
    marks = spark.createDataFrame([(3, 1), (3, 0), (6, 0), (None, 1), (9, 7), (12, None)], "id long, label int")
    out = toxicity.score_toxicity(spark, odd_docs, marks).collect()
    assert len(out) == odd_docs.count() and all(0 <= r.score <= 1 for r in out)
    nothing = toxicity.score_toxicity(spark, odd_docs, marks.where("false")).collect()
    assert {r.score for r in nothing} == {0.0} and not any(r.evidence for r in nothing)
    assert toxicity.score_toxicity(spark, odd_docs.where("false"), marks).count() == 0


def test_held_out_accuracy(spark):
    sf_dir = "/root/testdata/sf0.1"
    out = queries.op11_toxicity(spark, sf_dir).join(read(spark, sf_dir, "labels"), "doc_id")
    rate = {(r.held_out, r.toxic): r.rate for r in out.groupBy("held_out", "toxic").agg(F.avg("predicted").alias("rate")).collect()}
    assert rate[True, 1] > 0.8 and rate[True, 0] < 0.01
    held = out.select("doc_id", "held_out").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in held)
