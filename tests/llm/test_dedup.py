"""Lines, passages, near duplicates and benchmark passages against brute force."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from silverline.llm import components, decontamination, fm_index, lines, simhash, substrings, tokens
from silverline.llm.common import LAST_ID
from tests.llm import brute
from tests.llm.conftest import prose, table


def by_repr(rows):
    return sorted(rows, key=repr)


@pytest.mark.parametrize("batch_rows, fanout, levels", [(10**6, 4, 1), (1, 2, 3)])
def test_lines(spark, odd_docs, pairs, batch_rows, fanout, levels, monkeypatch):
    """One batch, and as many as there are slots, which fill three levels."""
    reached, write = [], lines.LineRuns._write
    monkeypatch.setattr(lines.LineRuns, "_write", lambda runs, rows, level: (reached.append(level), write(runs, rows, level))[1])
    kept = lines.dedup_lines(odd_docs.repartition(8), min_chars=40, min_docs=5, batch_rows=batch_rows, fanout=fanout)
    assert max(reached) >= levels - 1
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("line_runs_")]
    found = table(kept.select("whole.doc_id", "n_lines", "n_dropped", "kept"))
    assert found == by_repr(brute.line_dedup(pairs, 40, 5))
    assert sum(r[2] for r in found) > 10


def test_lines_of_no_documents(no_docs):
    assert lines.dedup_lines(no_docs).count() == 0


def test_runs_are_compacted_and_tell_what_is_new(spark, odd_docs):
    hashed = lines.line_hashes(odd_docs, min_chars=1).cache()
    runs = lines.LineRuns(spark, fanout=2)
    parts = [hashed.where(F.pmod(F.xxhash64("id", "row"), F.lit(5)) == i).select("id", "h") for i in range(5)]
    for part in parts:
        assert runs.unseen(part).join(runs.totals(), "h", "left_semi").count() == 0
        runs.add(part)
    assert [len(x) for x in runs.levels] == [1, 0, 1]  # five runs in base two
    assert runs.unseen(hashed).count() == 0
    # a hash is in one run only, and runs are merged where they lie
    held = runs._all(runs.tables)
    assert held.count() == held.select("h").distinct().count()
    batch = spark.table(runs._save(runs.totals(), "batches"))
    plan = runs.unseen(batch)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("SortMergeJoin") == 1 and plan.count("Exchange hashpartitioning") == 1
    plan = runs._sums(held)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    whole = hashed.groupBy("h").agg(F.count("*"), F.max("id"))
    assert table(runs.totals()) == table(whole)


@pytest.mark.parametrize("options", [{}, {"hot": 0, "shard_words": 300}, {"anchor": 3, "shard_words": 2000}])
@pytest.mark.parametrize("window", [12, 50])
def test_substrings(odd_docs, pairs, window, options):
    kept = substrings.dedup_substrings(odd_docs, window=window, **options)
    removed = F.aggregate("removed", F.lit(0).cast("long"), lambda n, x: n + x["end"] - x["word"])
    assert table(kept.select("whole.doc_id", "n_words", removed, "kept")) == by_repr(brute.substring_dedup(pairs, window))


@pytest.mark.parametrize("hot", [0, 2000])
def test_substrings_of_rows_that_repeat(spark, hot, monkeypatch):
    """Copies without an id meet as one passage: no shard grows with their number."""
    rng = random.Random(9)
    copied, other = prose(rng, 120), prose(rng, 40)
    pairs = [(None, copied)] * 300 + [(4, other + " " + copied), (4, other + " " + copied), (2, copied[: len(copied) // 2])]
    docs = spark.createDataFrame(pairs, "doc_id long, text string").repartition(4)
    stored, keep = {}, substrings.materialise

    def watched(df, label, **options):
        stored[label] = keep(df, label, **options)
        return stored[label]

    monkeypatch.setattr(substrings, "materialise", watched)
    kept = substrings.dedup_substrings(docs, window=50, hot=hot)
    removed = F.aggregate("removed", F.lit(0).cast("long"), lambda n, x: n + x["end"] - x["word"])
    assert table(kept.select("whole.doc_id", "n_words", removed, "kept")) == by_repr(brute.substring_dedup(pairs, 50))
    assert stored["least"].count() == stored["least"].select("anchor", "piece").distinct().count()


def test_substrings_of_no_documents(no_docs):
    assert substrings.dedup_substrings(no_docs).count() == 0


@pytest.mark.parametrize("window", [2, 7, 33, 50])
def test_fm_index(window):
    rng = np.random.default_rng(window)
    texts = [rng.integers(1, 4, rng.integers(1, 130)) for _ in range(12)]
    texts += [np.concatenate((t[:60], rng.integers(1, 5, 20))) for t in texts[:6]]
    owners = rng.permutation(len(texts))
    symbols = np.concatenate([np.append(t, 0) for t in texts])
    index = fm_index.FMIndex(symbols, np.concatenate([np.full(len(t) + 1, o) for t, o in zip(texts, owners)]), window)
    queries = [*texts, rng.integers(1, 7, 90)]
    size = np.array([len(q) for q in queries])
    found = index.least_owner(np.concatenate(queries), np.cumsum(size) - size, size, 999)
    least = {}
    for t, o in zip(texts, owners):
        for k in range(len(t) - window + 1):
            x = tuple(t[k : k + window])
            least[x] = min(least.get(x, 999), o)
    expected = [least.get(tuple(q[k : k + window]), 999) for q in queries for k in range(len(q))]
    assert found.tolist() == expected


def test_words_are_hashed_alike_across_pieces(monkeypatch):
    data = ("é".join(prose(random.Random(1), 3000).split(" ", 5)) + "\n" + "x" * 700 + " end").encode()
    whole = tokens.hash_words(data)
    monkeypatch.setattr(tokens, "PIECE", 64)
    pieces = tokens.hash_words(data)
    assert all((a == b).all() for a, b in zip(whole, pieces))
    assert [data[a:b] for a, b in zip(*whole[:2])] == data.split()


def test_simhash(odd_docs, pairs):
    prints = [(LAST_ID if d is None else d, brute.fingerprint(t)) for d, t in pairs]
    least = brute.components(prints)
    expected = by_repr((d, f - 2**64 if f >= 2**63 else f, least[d, f]) for d, f in prints)
    assert table(simhash.near_duplicates(odd_docs).select("id", "fp", "component")) == expected
    kept = simhash.drop_near_duplicates(odd_docs)
    assert kept.columns == odd_docs.columns
    ids = [r[0] for r in kept.select("doc_id").collect()]
    assert sorted(LAST_ID if i is None else i for i in ids) == sorted(set(least.values()))


def test_simhash_of_no_documents(no_docs):
    assert simhash.near_duplicates(no_docs).count() == 0
    assert simhash.drop_near_duplicates(no_docs).count() == 0


@pytest.mark.parametrize("group", [2048, 6])
def test_links_are_complete_where_groups_are_large(spark, group):
    """A dense cloud of prints around a few centres; with groups of six almost all keys have too many."""
    rng = np.random.default_rng(3)
    prints = set()
    for centre in rng.integers(0, 2**63, 3).tolist():
        for _ in range(60):
            prints.add(centre ^ sum(1 << int(b) for b in rng.choice(63, rng.integers(0, 4), replace=False)))
    prints |= set(rng.integers(0, 2**63, 50).tolist())
    links = simhash.fingerprint_links(spark.createDataFrame([(p,) for p in prints], "fp long"), group=group)
    found = {r[0]: r[1] for r in components.connected_components(links).collect()}
    least = brute.components([(p, p) for p in prints])
    assert {p: found.get(p, p) for p in prints} == {p: least[p, p] for p in prints}


def test_components_of_a_long_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(100)] + [(1000, i) for i in range(1001, 1100)] + [(5, 5), (7, 6)]
    found = components.connected_components(spark.createDataFrame(edges, "u long, v long"))
    assert table(found) == by_repr([(i, 0) for i in range(101)] + [(i, 1000) for i in range(1000, 1100)])


@pytest.mark.parametrize("mark_bits", [28, 6])
def test_contamination(spark, odd_docs, pairs, mark_bits):
    texts = [t for _, t in pairs if t and len(t) > 400]
    items = [(1, " ".join(texts[0].split()[3:40])), (2, texts[1].upper()), (2, "one"), (None, texts[2][:200]), (3, None)]
    items += [(4, "?!"), (5, "café été"), (1, " ".join(texts[0].split()[3:40]))]
    benchmark = spark.createDataFrame(items, "item_id int, text string")
    found = decontamination.find_contamination(odd_docs, benchmark, mark_bits=mark_bits)
    found = found.select("whole.doc_id", "n_words", "n_hit", F.array_join("items", ","), "contaminated")
    assert table(found) == by_repr(brute.contamination(pairs, items))


def test_contamination_by_a_benchmark_of_shared_and_very_long_words(spark):
    long, passage = "\u6f22" * 40_000, " ".join(f"p{i}" for i in range(30))
    docs = [(1, f"{passage} {long} end"), (2, f"x {long} {passage}"), (3, f"{long}x {passage[:40]}"), (4, long), (5, "- - -")]
    docs += [(6, " ".join([passage] * 400)), (7, " ".join(f"n{i}" for i in range(5000)) + " " + passage)]
    items = [(i, passage) for i in range(300)] + [(900, long), (901, "-"), (902, f"{passage[-20:]} {long}"), (903, "absent words of an item")]
    found = decontamination.find_contamination(
        spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id int, text string")
    )
    assert all(a["end"] < b["word"] for r in found.select("spans").collect() for a, b in zip(r.spans, r.spans[1:]))
    found = found.select("whole.doc_id", "n_words", "n_hit", F.array_join("items", ","), "contaminated")
    assert table(found) == by_repr(brute.contamination(docs, items))


def test_contamination_with_empty_tables(spark, odd_docs, no_docs):
    nothing = spark.createDataFrame([], "item_id int, text string")
    assert not any(r[0] for r in decontamination.find_contamination(odd_docs, nothing).select("contaminated").collect())
    one = spark.createDataFrame([(1, "one")], "item_id int, text string")
    assert decontamination.find_contamination(no_docs, one).count() == 0
