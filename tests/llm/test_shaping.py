"""Quality rules, URL filter, mixing, sharding, tool calls and secrets."""

import json
import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from silverline.llm import mixing, quality, secrets, sharding, toolcalls, urls
from silverline.llm.common import running_total
from tests.llm import brute
from tests.llm.conftest import prose, table


def test_running_total_over_a_hot_group(spark):
    rows = [(None if i % 3 else i % 2, i, i % 7) for i in range(2000)]
    df = spark.createDataFrame(rows, "g int, o int, v int")
    found = running_total(df, ["g"], ["o"], "v", "t", rows_per_task=50)
    sums, expected = defaultdict(int), []
    for g, o, v in rows:
        expected.append((g, o, v, sums[g]))
        sums[g] += v
    assert table(found) == sorted(expected, key=repr)


def test_quality_counts(odd_docs, pairs):
    model = quality.Model((0,) * quality.BUCKETS, 0)
    judged = quality.judge(odd_docs, model)
    names = [*quality.COUNTS, "base_failed", "kept"]
    expected = [(d, *(c := brute.quality_counts(t)), not c[-1]) for d, t in pairs]
    assert table(judged.select("whole.doc_id", *names)) == sorted(expected, key=repr)
    assert judged.where("kept").select("whole.*").columns == odd_docs.columns


def test_quality_repeats(spark):
    rng = random.Random(2)
    texts = ["a b c d e a b c d e", "a a a a a a a", "x y z x y z x y z", "p q r s t u v", "l\nl\n \n \nl", prose(rng, 3000, 9)]
    docs = spark.createDataFrame([(t,) for t in texts], "text string")
    judged = quality.judge(docs, quality.Model((0,) * quality.BUCKETS, 0))
    assert [tuple(r) for r in judged.select(*quality.COUNTS, "base_failed").collect()] == list(map(brute.quality_counts, texts))


def test_quality_model_on_held_out_documents(spark):
    rng = random.Random(4)
    junk = lambda n: " ".join(x + rng.choice(["!!", "***", "%%%"]) for x in prose(rng, n).upper().split())
    docs = [(i, junk(60) if i % 4 == 0 else prose(rng, 60)) for i in range(800)]
    labels = [(i, int(i % 4 > 0)) for i in range(0, 400)] + [(None, 1), (5000, 0), (3, None)]
    docs = spark.createDataFrame([*docs, (None, None), (801, "")], "doc_id long, text string")
    labels = spark.createDataFrame(labels, "doc_id long, quality int")
    model = quality.fit(docs, labels)
    kept = dict(quality.judge(docs, model).select("whole.doc_id", "kept").collect())
    held = [(kept[i], i % 4 > 0) for i in range(400, 800)]
    assert np.mean([a == b for a, b in held]) > 0.98
    assert quality.fit(docs, labels.where("false")).threshold < -(2**39)
    assert quality.judge(docs.where("false"), quality.fit(docs.where("false"), labels)).count() == 0


RULES = [
    urls.Rule("net", "/", "block"),
    urls.Rule("example.net", "/en/", "allow"),
    urls.Rule("example.com", "/de/", "block"),
    urls.Rule("org", "/fr/", "allow"),
]


def test_url_parts_and_rules(spark):
    cases = {
        None: ("", "", None),
        "": ("", "", None),
        "no scheme.net/": ("", "", None),
        "http://A.Example.NET/en/x?q#f": ("a.example.net", "/en/x", "example.net/en/"),
        "http://example.net/EN/": ("example.net", "/EN/", "net/"),
        "http://badexample.net/en/": ("badexample.net", "/en/", "net/"),
        "http://net": ("net", "", None),
        "http://x.net?a=/": ("x.net", "", None),
        "http://x.org/fr": ("x.org", "/fr", None),
        "http://x.org/fr/#a://b.net/": ("x.org", "/fr/", "org/fr/"),
        "http://example.com:80/de/": ("example.com:80", "/de/", None),
        "://example.com/de/": ("example.com", "/de/", "example.com/de/"),
        "http://": ("", "", None),
    }
    pages = spark.createDataFrame([(u, 1) for u in cases], "url string, host int")
    judged = urls.judge_urls(pages, RULES, urls.fit(pages, RULES))
    found = {r[0]: tuple(r)[1:] for r in judged.select("whole.url", "host", "path", "rule").collect()}
    assert found == cases
    verdicts = {r[0]: r[1] for r in judged.where("rule is not null").select("rule", "verdict").collect()}
    assert verdicts == {r.name: r.verdict for r in RULES}


def local_counts(model):
    return urls.UrlCounts(*urls._arrays(model.table.toArrow()))


def test_url_model(spark):
    rng = random.Random(6)
    word = lambda: "".join(rng.choice("aeiou") + rng.choice("bdmnr") for _ in range(3))
    good = lambda n: [f"https://{word()}.org/fr/{word()}-{word()}" for _ in range(n)]
    bad = lambda n: [f"https://{word()}.net/{rng.randrange(10**9)}/win-cash" for _ in range(n)]
    pages = spark.createDataFrame([(u,) for u in good(300) + bad(300) + [None]], "url string")
    model = urls.fit(pages, RULES)
    fresh = [u.replace(".org/fr/", ".io/") for u in good(100)] + [u.replace(".net/", ".io/") for u in bad(100)]
    scores = local_counts(model).score(fresh)
    assert np.mean((scores >= model.threshold) == ([True] * 100 + [False] * 100)) > 0.95
    judged = urls.judge_urls(spark.createDataFrame([(u,) for u in fresh], "url string"), RULES, model)
    found = {r[0]: r[1] for r in judged.select("whole.url", "verdict").collect()}
    assert all(found[u] == ("allow" if s >= model.threshold else "block") for u, s in zip(fresh, scores))
    assert urls.judge_urls(pages.where("false"), RULES, model).count() == 0
    one_kind = urls.fit(pages.where("url like '%.org%'"), RULES)
    assert one_kind.threshold == -np.inf


def test_url_smoothing_is_a_distribution(spark):
    pages = spark.createDataFrame([(u,) for u in ("http://a.org/fr/x", "http://b.org/fr/yy", "http://c.net/")], "url string")
    counts = local_counts(urls.fit(pages.union(pages.selectExpr("url || 'z'")), RULES))
    buf = np.concatenate([np.append(np.frombuffer(b"org/", np.uint8), np.uint8(c)) for c in range(256)])
    assert counts.probabilities(buf, np.arange(256) * 5 + 4).sum(axis=1) == pytest.approx([1, 1])


def test_urls_are_scored_alike_in_pieces(spark, monkeypatch):
    """Memory does not follow the length of URLs: pieces end anywhere, within a URL too."""
    some = ["http://a.org/fr/x", None, "", "é", "http://B.net/" + "long/" * 300, "x", "http://c.net/"]
    counts = local_counts(urls.fit(spark.createDataFrame([(u,) for u in some * 3], "url string"), RULES))
    whole = counts.score(some)
    monkeypatch.setattr(urls, "PLACES", 7)
    assert counts.score(some) == pytest.approx(whole, abs=1e-8)
    assert counts.score([]).tolist() == []


def brute_url_scores(good, bad, fresh):
    """Witten and Bell's smoothing over dictionaries of whole contexts."""
    models = []
    for side in (bad, good):
        follow = defaultdict(Counter)
        for u in side:
            data = b"\2" * 4 + (u or "").encode().lower() + b"\3"
            for at in range(4, len(data)):
                for k in range(5):
                    follow[data[at - k : at]][data[at]] += 1
        models.append(follow)
    out = []
    for u in fresh:
        data, total = b"\2" * 4 + (u or "").encode().lower() + b"\3", 0.0
        for at in range(4, len(data)):
            p = [1 / 256, 1 / 256]
            for k in range(5):
                for side, follow in enumerate(models):
                    seen = follow.get(data[at - k : at])
                    if seen:
                        p[side] = (seen[data[at]] + len(seen) * p[side]) / (sum(seen.values()) + len(seen))
            total += math.log(p[1]) - math.log(p[0])
        out.append(round(total / (len(data) - 4), 9))
    return out


@pytest.mark.parametrize("broadcast", [True, False])
def test_url_verdicts_equal_brute_force(spark, broadcast, monkeypatch):
    """All pages, with nulls and repeats, by a model that is sent to the tasks and by one that is joined."""
    if not broadcast:
        monkeypatch.setattr(urls, "BROADCAST_ROWS", 0)
        monkeypatch.setattr(urls, "BLOCK", 500)
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet").select("page_id", "url")
    odd = spark.createDataFrame([(900, None), (901, ""), (902, "http://x.org/fr/1"), (902, "http://x.org/fr/1")], "page_id long, url string")
    pages = pages.union(odd).withColumn("score", F.lit("theirs"))
    model = urls.fit(pages, RULES)
    judged = urls.judge_urls(pages, RULES, model).select("whole.url", "whole.score", "rule", F.col("score").alias("found"), "verdict")
    rows = judged.withColumn("held", F.pmod(F.xxhash64("url"), F.lit(urls.HELD)) == 0).collect()
    assert len(rows) == pages.count()
    sides = [[r.url for r in rows if r.rule and r.verdict == v and not r.held] for v in ("allow", "block")]
    expected = brute_url_scores(*sides, [r.url for r in rows])
    assert [r.found for r in rows] == pytest.approx(expected, abs=1e-8)
    assert all(r.verdict == ("allow" if x >= model.threshold else "block") for r, x in zip(rows, expected) if not r.rule)


@pytest.mark.parametrize("n", [1, 2, 3, 5, 64, 1000, 4097])
def test_permutation(n):
    index, seed = np.arange(n), np.uint64(11)
    there = mixing.permute(index, n, seed)
    assert sorted(there) == list(range(n))
    assert (mixing.permute(there, n, seed, back=True) == index).all()


def test_targets(spark):
    for seed in range(5):
        rng = random.Random(seed)
        sizes = {f"s{i}": rng.choice([0, 1, 7, 100, 5000]) for i in range(11)} | {None: 50, "Z": 3, "\u00e9": 40}
        rows = [(s, n) for s, n in sizes.items()]
        found = mixing.source_targets(spark.createDataFrame(rows, "source string, size long"))
        assert {r.source: r.target for r in found.collect()} == pytest.approx(brute.targets(sizes))


def test_mixing(odd_docs, pairs):
    mixed, pieces = mixing.mix_sources(odd_docs, block=16)
    rows = mixed.collect()
    words = [len(brute.WORD.findall(t or "")) for _, t in pairs]
    assert sorted((repr(r.id), r.size) for r in rows) == sorted((repr(d), n) for (d, _), n in zip(pairs, words))
    sizes, taken, wanted = defaultdict(int), defaultdict(int), {}
    for r in rows:
        assert 0 <= r.taken <= 2 * r.size
        sizes[r.source] += r.size
        taken[r.source] += r.taken
        wanted[r.source] = (r.source_size, r.target)
    assert {s: n for s, (n, _) in wanted.items()} == sizes
    assert {s: t for s, (_, t) in wanted.items()} == pytest.approx(brute.targets(sizes))
    assert all(abs(taken[s] - t) <= 0.5 for s, (_, t) in wanted.items())
    assert table(mixing.mix_sources(odd_docs, block=16)[0]) == table(mixed)
    # Every output shard draws from all large sources.
    shards = pieces.groupBy("source").agg(F.countDistinct("shard").alias("n")).collect()
    assert {r.n for r in shards} == {1}


def test_mixed_documents(odd_docs):
    out = mixing.mixed_documents(odd_docs, block=16)
    assert out.columns == odd_docs.columns
    total = mixing.mix_sources(odd_docs, block=16)[0].agg(F.sum("taken")).first()[0]
    assert out.agg(F.sum(F.size(F.split(F.trim("text"), r"[\x20\x09-\x0D]+")))).first()[0] == total
    assert out.where("text is null or trim(text) = ''").count() == 0


def test_numbers_of_equal_rows(spark):
    rows = spark.range(0, 30_000, 1, 8).selectExpr("if(id % 3 > 0, null, id) as _id", "7L as _row", "if(id % 3 = 1, 's', null) as _source")
    numbered = mixing._numbered(rows, ["_id", "_row", "_source"])
    found = numbered.groupBy("_id", "_source").agg(F.count("*").alias("n"), F.countDistinct("_copy").alias("d"), F.max("_copy").alias("m"))
    counts = sorted((r.n, r.d, r.m) for r in found.collect())
    assert counts == [(1, 1, 0)] * 10_000 + [(10_000, 10_000, 9_999)] * 2
    # equal rows are numbered within the task that read them
    plan = numbered._jdf.queryExecution().optimizedPlan().toString()
    assert all("_part#" in line for line in plan.splitlines() if "row_number()" in line)


def test_mixing_of_equal_rows_without_ids(spark):
    docs = spark.range(0, 25_000, 1, 4).selectExpr("cast(null as long) as doc_id", "'a b c' as text", "'s' as source")
    mixed = mixing.mix_sources(docs)[0].agg(F.count("*"), F.countDistinct("copy"), F.sum("taken"), F.max("taken")).first()
    assert tuple(mixed) == (25_000, 25_000, 112_500, 6)
    assert mixing.mixed_documents(docs).agg(F.sum(F.size(F.split("text", r"\s+")))).first()[0] == 112_500


def test_mixing_of_no_documents(no_docs):
    assert mixing.mix_sources(no_docs)[0].count() == 0
    assert mixing.mixed_documents(no_docs).count() == 0


def test_shards(odd_docs, pairs):
    placed = sharding.kd_tree_shards(odd_docs, leaves=4)
    rows = placed.collect()
    size = lambda t: len((t or "").encode()) + 8
    assert sorted((repr(r.doc_id), r.size) for r in rows) == sorted((repr(d), size(t)) for d, t in pairs)
    bytes_, slots, where = defaultdict(int), defaultdict(list), defaultdict(set)
    for r in rows:
        bytes_[r.shard] += r.size
        slots[r.shard].append(r.slot)
        where[r.text_crc32, r.size].add(r.shard)
    assert set(bytes_) == set(range(4))
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert all(len(s) == 1 for s in where.values())
    largest = max(sum(r.size for r in rows if (r.text_crc32, r.size) == k) for k in where)
    assert max(bytes_.values()) - min(bytes_.values()) <= 2 * largest


def test_shards_do_not_pass_through_the_driver(spark, monkeypatch):
    docs = spark.range(400).selectExpr("id as doc_id", "repeat(cast(id as string), 20) as text", "'s' as source", "'en' as lang")
    rows, collect = [], type(docs).collect
    monkeypatch.setattr(type(docs), "collect", lambda df: rows.append(len(found := collect(df))) or found)
    placed = sharding.kd_tree_shards(docs, leaves=100)
    assert max(rows) == 1 and len(rows) < 60
    monkeypatch.undo()
    sums = [r[1] for r in placed.groupBy("shard").agg(F.sum("size")).collect()]
    assert len(sums) == 100 and max(sums) <= 2 * min(sums)


def test_points_of_a_level_are_joined_with_their_cuts_once(spark, monkeypatch):
    """What a level reads four times is stored, and so is what its leaves are taken from in the end."""
    docs = spark.range(400).selectExpr("id as doc_id", "repeat(cast(id as string), 20) as text", "'s' as source", "'en' as lang")
    plans, stored, cuts, materialise = [], [], sharding._cuts, sharding.materialise
    plan = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    monkeypatch.setattr(sharding, "_cuts", lambda points, *rest: plans.append(plan(points)) or cuts(points, *rest))
    monkeypatch.setattr(sharding, "materialise", lambda df, label: stored.append((label, plan(df))) or materialise(df, label))
    sharding.kd_tree_shards(docs, leaves=5)
    assert len(plans) == 3 and not any("Join" in p for p in plans)
    assert not any("Join" in p for label, p in stored if label == "leaves")


@pytest.mark.parametrize("leaves", [2, 7, 40])
def test_no_shard_gets_more_leaves_than_groups(spark, leaves):
    """Leaves follow the weight but for sides of few groups; with as many leaves as groups each has its own."""
    rows = [(i, "x" * (3000 if i % 10 == 0 else 1 + i), "s", "en") for i in range(40)]
    rows += [(100 + i, "x" * (1 + i), "s", "en") for i in range(5, 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    groups = len({t for _, t, *_ in rows})
    placed = sharding.kd_tree_shards(docs, leaves=min(leaves, groups)).collect()
    assert len(placed) == len(rows)
    assert {r.shard for r in placed} == set(range(min(leaves, groups)))


def test_shards_of_a_hot_group_and_of_ties(spark):
    hot = [(i, "the same text " * 9, "s", "en") for i in range(300)] + [(i, f"{i:04}" * 30, "s", "en") for i in range(300, 900)]
    docs = spark.createDataFrame(hot, "doc_id long, text string, source string, lang string")
    sums = sharding.kd_tree_shards(docs, leaves=8).groupBy("shard").agg(F.sum("size"), F.count("*")).collect()
    assert len(sums) == 8
    rest = [r[1] for r in sums if r[2] != 300]
    assert len(rest) == 7 and max(rest) - min(rest) < 20 * 128


def test_shards_are_compact_in_long_values(spark):
    """Values that begin alike are told apart, as the tree cuts by id first and then by source."""
    rows = [(i, f"{i:04}" * 30, f"commoncrawl-202{3 + i % 2}", "en") for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    placed = sharding.kd_tree_shards(docs, leaves=4).join(docs, "doc_id").groupBy("shard")
    found = placed.agg(F.count("*"), F.count_distinct("source")).collect()
    assert sorted(tuple(r) for r in found) == [(i, 100, 1) for i in range(4)]


def test_shards_by_target_and_of_no_documents(spark, odd_docs, no_docs):
    total = odd_docs.agg(F.sum(F.coalesce(F.octet_length("text"), F.lit(0)) + 8)).first()[0]
    assert sharding.kd_tree_shards(odd_docs, target_bytes=total).select("shard").distinct().count() == 1
    assert sharding.kd_tree_shards(odd_docs, target_bytes=total // 3 + 1).select("shard").distinct().count() == 3
    assert sharding.kd_tree_shards(no_docs, leaves=3).count() == 0
    with pytest.raises(ValueError):
        sharding.kd_tree_shards(odd_docs)


TOOLS = {
    "add": {
        "type": "object",
        "properties": {"a": {"type": "integer", "minimum": 0}, "b": {"type": "number"}, "how": {"type": "string", "enum": ["x", "y"]}},
        "required": ["a", "b"],
        "additionalProperties": False,
    },
    "any": {"type": "object"},
}


def test_tool_calls(spark):
    calls = [
        (1, 5, "c", "add", '{"b": 1.50, "a": 2, "how": "x"}', "b"),
        (1, 3, "b", "any", '{"z": {"y": [1, {"q": null, "p": "\\u00e9\\n"}]}, "a": "\\""}', "a"),
        (1, 9, "a", "any", "{}", None),
        (1, 1, "par", "any", "{}", "a"),
        (2, 0, "c", "add", '{"a": -1, "c": 1, "how": "w"}', "missing"),
        (2, 1, "d", "add", '{"a": 1.5, "b": "x"}', "d"),
        (2, 2, "e", "gone", "[1]", None),
        (2, 3, "f", "any", "[1]", None),
        (2, 4, "g", "any", None, None),
        (3, 0, "l", "any", "{}", "r"),
        (3, 1, "r", "any", "{}", "l"),
        (3, 2, "s", "any", "{}", "l"),
        (None, 0, "n", "any", "{}", None),
        (None, 1, "o", "any", "{}", "n"),
        (1, 9, "a", "any", "{}", None),
        (4, 0, None, "any", "{}", None),
    ]
    results = [(1, 6, "c", "three"), (1, 7, "c", "later"), (2, 9, "zz", "orphan"), (None, 2, "o", 'say "x"'), (4, 1, "x", None)]
    calls = spark.createDataFrame(calls, "conv_id int, turn int, call_id string, name string, arguments string, after string")
    results = spark.createDataFrame(results, "conv_id int, turn int, call_id string, content string")
    linked, orphans = toolcalls.link_tool_calls(calls, results, TOOLS)
    rows = {(r.conv_id, r.call_id): r for r in linked.collect()}
    assert len(rows) == linked.count() == 15
    assert sorted(r.call_id for r in orphans.collect()) == ["x", "zz"]
    order = sorted((r.position, r.call_id) for r in rows.values() if r.conv_id == 1)
    assert order == [(0, "a"), (1, "par"), (2, "b"), (3, "c")]
    assert [rows[1, k].depth for k in ("a", "par", "b", "c")] == [0, 1, 1, 2]
    assert rows[1, "a"].n_calls == 2 and rows[1, "c"].n_results == 2
    assert rows[1, "c"].line == (
        '{"after":"b","arguments":{"a":2,"b":1.5,"how":"x"},"id":"c","name":"add","position":3,"result":"three"}'
    )
    assert json.loads(rows[1, "b"].line)["arguments"] == {"a": '"', "z": {"y": [1, {"p": "é\n", "q": None}]}}
    assert json.loads(rows[None, "o"].line)["result"] == 'say "x"'
    errors = {k[1]: r.errors for k, r in rows.items() if k[0] == 2}
    assert errors["c"] == ["a too small", "missing b", "how not listed", "unknown c", "unknown after"]
    assert errors["d"] == ["type of a", "type of b", "unknown after"]
    assert errors["e"] == ["unknown tool"] and errors["f"] == errors["g"] == ["not an object"]
    assert all(rows[3, k].depth is None and rows[3, k].errors == ["cycle"] for k in "lrs")
    assert {k for k, r in rows.items() if r.valid} == {(1, k) for k in ("a", "b", "c", "par")} | {(None, "n"), (None, "o"), (4, "")}
    nothing, none_left = toolcalls.link_tool_calls(calls.where("false"), results, TOOLS)
    assert nothing.count() == 0 and none_left.count() == 5


def test_tool_calls_without_ids(spark):
    """Every call without an id stays, and nothing is linked to it."""
    calls = [
        (1, 0, "a", "any", "{}", None),
        (1, 1, None, "any", '{"x": 1}', "a"),
        (1, 2, None, "any", '{"x": 2}', None),
        (1, 2, None, "any", '{"x": 3}', "gone"),
        (1, 2, None, "any", '{"x": 3}', "gone"),
        (1, 3, "", "any", "{}", None),
        (1, 4, "l", "any", "{}", "l2"),
        (1, 5, "l2", "any", "{}", "l"),
        (1, 6, None, "any", "{}", "l"),
        (None, None, None, "any", "{}", "a"),
        (None, None, None, "any", "{}", None),
    ]
    results = [(1, 3, None, "lost"), (1, 4, "a", "found"), (1, 5, "", "empty"), (None, None, None, "lost too")]
    calls = spark.createDataFrame(calls, "conv_id int, turn int, call_id string, name string, arguments string, after string")
    results = spark.createDataFrame(results, "conv_id int, turn int, call_id string, content string")
    linked, orphans = toolcalls.link_tool_calls(calls, results, TOOLS)
    rows = [{**json.loads(r.line), **r.asDict()} for r in linked.collect()]
    assert len(rows) == 11 and all(r["n_calls"] == 1 for r in rows)
    assert sorted(r["position"] for r in rows if r["conv_id"]) == list(range(9))
    assert {(r["id"], r["turn"]): (r["result"], r["n_results"]) for r in rows if r["n_results"]} == {("a", 0): ("found", 1), ("", 3): ("empty", 1)}
    found = sorted((r["turn"], r["arguments"].get("x"), r["depth"], r["after"], *r["errors"]) for r in rows if r["conv_id"] and r["id"] is None)
    lost = (2, 3, 0, None, "unknown after")
    assert found == [(1, 1, 1, "a"), (2, 2, 0, None), lost, lost, (6, None, None, "l", "cycle")]
    assert sorted(r["errors"] for r in rows if r["conv_id"] is None) == [[], ["unknown after"]]
    assert sorted(r.content for r in orphans.collect()) == ["lost", "lost too"]


def test_tool_call_chains(spark):
    rows = [(0, i, f"c{i}", "any", "{}", f"c{i - 1}" if i else None) for i in range(150)]
    random.Random(1).shuffle(rows)
    calls = spark.createDataFrame(rows, "conv_id int, turn int, call_id string, name string, arguments string, after string")
    results = spark.createDataFrame([], "conv_id int, turn int, call_id string, content string")
    linked, _ = toolcalls.link_tool_calls(calls, results, TOOLS)
    assert all(r.depth == r.position == r.turn for r in linked.collect())


def secret_texts(rng, n):
    """Keys and things that look like keys, with what they are."""
    digits = lambda k, of="0123456789abcdef": "".join(rng.choice(of) for _ in range(k))
    mixed = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    out = []
    for i in range(n):
        kind = i % 5
        if kind == 0:
            out.append((f'set api_key = "{digits(40)}" then', 1))
        elif kind == 1:
            out.append((f"password: {digits(24, mixed)} end", 1))
        elif kind == 2:
            out.append((f"commit {digits(40)} merged", 0))
        elif kind == 3:
            out.append((f"sha256 {digits(64)} of file", 0))
        else:
            out.append((f"call the {'Report'.join(rng.choice(['make', 'open', 'send']) for _ in range(4))}Function now", 0))
    return out


def test_secrets_on_held_out_findings(spark):
    rng = random.Random(8)
    texts = secret_texts(rng, 600)
    docs = [(i, prose(rng, 5) + " " + t + " " + prose(rng, 5), y, None if i % 2 else "src") for i, (t, y) in enumerate(texts)]
    docs = spark.createDataFrame([*docs, (900, None, 0, None), (901, "", 0, "")], "doc_id int, text string, label int, source string")
    found = secrets.candidates(docs)
    assert found.count() == 600
    known = secrets.dictionary(docs)
    labelled = found.join(docs.select(F.col("doc_id").alias("id"), "label"), "id")
    model = secrets.fit(labelled.where("id < 300"), known)
    judged = secrets.scan(labelled, known, model).where("id >= 300").select("label", "secret").collect()
    assert np.mean([r.label == r.secret for r in judged]) > 0.97
    assert secrets.scan(found, known, secrets.fit(labelled.where("label = 1"), known)).where("secret").count() == 600
    nothing = docs.where("false")
    assert secrets.scan(secrets.candidates(nothing), secrets.dictionary(nothing), model).count() == 0


def test_all_secrets_of_a_word(spark):
    """A word yields every candidate, and what is carried around them grows with the word, not with its square."""
    a, b, c = "0f" * 20, "1e" * 20, "2d" * 20
    url = f"https://cdn.example.com/assets/main-bundle-v2?api_key={a}"
    json_text = f'{{"mail":"x@y.zz","token":"{a}","sha":"{b}","again":"{a}"}}'
    mail = "first-and-second-name@subdomain-of-example.com"
    many = ";".join(f"k{i}={i:040x}" for i in range(3000))
    docs = [(0, f"see {url} here", "s"), (1, json_text, "s"), (2, f"token = {a};{b}=={c} commit", "s"), (3, mail, "s"), (4, many + " " + many, "s")]
    found = secrets.candidates(spark.createDataFrame(docs, "doc_id int, text string, source string"))
    rows = {(r.id, r.word, r.place): r for r in found.where("id < 4").collect()}
    assert {k: r.candidate for k, r in rows.items()} == {
        (0, 1, 0): "com/assets/main-bundle-v2", (0, 1, 1): a, (1, 0, 0): a, (1, 0, 1): b, (1, 0, 2): a,
        (2, 2, 0): a, (2, 2, 1): b + "==", (2, 2, 2): c, (3, 0, 0): "first-and-second-name", (3, 0, 1): "subdomain-of-example",
    }
    assert rows[0, 1, 0].token == url.removesuffix(a) and rows[0, 1, 1].head == "com/assets/main-bundle-v2?api_key="
    assert rows[1, 0, 1].head == a + '","sha":"' and [k for k, r in rows.items() if r.mail] == [(3, 0, 0), (3, 0, 1)]
    assert [(rows[2, 2, i].before2, rows[2, 2, i].before, rows[2, 2, i].after) for i in range(3)] == [("token", "=", ""), ("", "", ""), ("", "", "commit")]
    sized = found.where("id = 4").select("word", F.length(F.concat("token", "head", "before2", "before", "after")).alias("n"))
    sized = sized.groupBy("word").agg(F.count("*"), F.sum("n")).collect()
    assert sorted(r[:2] for r in sized) == [(0, 3000), (1, 3000)] and all(r[2] < 6 * len(many) for r in sized)
    judged = secrets.features(found.where("id < 3"), secrets.Dictionary((), (0.0,) * secrets.SYMBOLS**2))
    judged = {(r.id, r.place): r for r in judged.collect()}
    assert judged[0, 1].before_for == judged[0, 1].assigned == judged[1, 0].quoted == judged[1, 1].before_against == 1
    assert judged[0, 0].before_for == judged[1, 1].before_for == judged[1, 0].at_sign == 0
