"""The registered queries, on whole small tables, against their SQL or brute force."""

import zlib

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

import __spark_entry__ as driver
import corpus_pipeline
from silverline.llm import queries, quality, sharding
from silverline.llm.common import table as read
from tests.llm import brute
from tests.llm.conftest import table
from tests.oracle import duck_tables, spark_rows, sql_rows

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    return [tuple(r) for r in read(spark, SF_DIR, "documents").select("doc_id", "text", "source").collect()]


@pytest.mark.parametrize("name", queries.SQL)
def test_matches_sql(spark, name):
    names, found = spark_rows(queries.QUERIES[name](spark, SF_DIR))
    expected_names, expected = sql_rows(duck_tables(SF_DIR), queries.SQL[name])
    assert names == expected_names
    assert found == expected


def test_registered(spark):
    assert {*queries.QUERIES, "pipeline"} <= set(driver.queries())
    assert queries.SQL.items() <= driver.oracle_sql().items()


def test_shards(spark, docs):
    out = queries.op2_sharding(spark, SF_DIR).collect()
    expected = {d: (len(t.encode()) + 8, zlib.crc32(t.encode())) for d, t, _ in docs}
    assert {r.doc_id: (r.size, r.text_crc32) for r in out} == expected
    assert {r.shard for r in out} == set(range(24)) and {r.law for r in out} == {"bytes"}


def test_fingerprints(spark, docs):
    prints = [(d, brute.fingerprint(t)) for d, t, _ in docs]
    least = brute.components(prints)
    expected = sorted((d, f"{f:016x}", least[d, f]) for d, f in prints)
    assert table(queries.op4_simhash(spark, SF_DIR)) == sorted(expected, key=repr)


def test_quality(spark, docs):
    out = queries.op8_quality_rules(spark, SF_DIR).collect()
    assert {r.doc_id: tuple(r)[1:7] for r in out} == {d: brute.quality_counts(t) for d, t, _ in docs}
    assert not any(r.kept and r.base_failed for r in out)


def test_urls(spark):
    out = queries.op9_url_filter(spark, SF_DIR)
    assert out.count() == read(spark, SF_DIR, "pages").count()
    assert out.where("verdict is null").count() == 0


def test_mix(spark, docs):
    out = queries.op10_mixing(spark, SF_DIR).collect()
    assert {r.doc_id: r.size for r in out} == {d: len(brute.WORD.findall(t)) for d, t, _ in docs}


def test_secrets_are_tokens(spark):
    """Also in a session in which rows have been observed."""
    seen = Observation()
    spark.range(5).observe(seen, F.count(F.lit(1)).alias("n")).count()
    assert seen.get == {"n": 5}
    out = queries.op1_secret_scan(spark, "/root/testdata/sf0.01")
    assert out.where(F.col("candidate").rlike("^[0-9A-Fa-f]{40}$")).count() == out.count() > 0


def test_pipeline(spark, docs, tmp_path):
    """Each stage against brute force on what the stage before has kept."""
    text = {d: t for d, t, _ in docs}
    kept, path = read(spark, SF_DIR, "documents"), None
    columns = kept.columns
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = {r.doc_id: r.text for r in kept.collect()} if i < 4 else None
        after = stage(spark, kept, SF_DIR)
        after.write.parquet(path := str(tmp_path / str(i)))
        after = spark.read.parquet(path)
        ids = [r[0] for r in after.select("doc_id").collect()]
        if i < 4:
            assert after.columns == columns
        if i < 3:
            assert all(r.text == text[r.doc_id] for r in after.collect())
        if i == 0:
            model = quality.fit(kept, read(spark, SF_DIR, "labels"))
            judged = quality.judge(kept, model).where("kept").select("whole.doc_id")
            assert sorted(ids) == sorted(r[0] for r in judged.collect())
            assert not any(brute.quality_counts(text[d])[-1] for d in ids)
        elif i == 1:
            assert sorted(ids) == sorted(set(brute.components([(d, brute.fingerprint(t)) for d, t in before.items()]).values()))
        elif i == 2:
            items = [tuple(r) for r in read(spark, SF_DIR, "benchmark").select("item_id", "text").collect()]
            assert sorted(ids) == sorted(r[0] for r in brute.contamination(before.items(), items) if not r[-1])
        elif i == 3:
            assert set(ids) <= set(before)
            words = lambda t: len(brute.WORD.findall(t))
            total, out = sum(map(words, before.values())), sum(words(r.text) for r in after.collect())
            assert abs(out - 1.5 * total) <= 20
        else:
            assert len(ids) == kept.count()
            assert sorted(map(repr, after.collect())) == sorted(
                map(repr, sharding.kd_tree_shards(kept, target_bytes=corpus_pipeline.SHARD_BYTES).collect())
            )
        kept = after
    assert driver.queries()["pipeline"](spark, SF_DIR).count() == kept.count()


@pytest.mark.parametrize("empty", [False, True])
def test_pipeline_on_odd_documents(spark, odd_docs, empty, tmp_path):
    """Nulls in every column, empty and long texts, repeated rows and clashing names, one stage after the other; and no rows at all."""
    docs = odd_docs.where("false") if empty else odd_docs.unionByName(odd_docs.limit(40))
    columns = docs.columns
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        docs.write.parquet(path := str(tmp_path / f"in{i}"))
        docs = spark.read.schema(docs.schema).parquet(path)
        before = [tuple(r) for r in docs.collect()]
        after = stage(spark, docs, SF_DIR)
        if i < 4:
            assert after.columns == columns
        rows = [tuple(r) for r in after.collect()]
        if i < 3:
            assert set(rows) <= set(before)  # nothing is changed or made up
        if i == 0:
            assert not any(brute.quality_counts(r[1])[-1] for r in rows)
        elif i == 1 and rows:
            prints = [brute.fingerprint(r[1]) for r in rows]
            assert len(set(brute.components([(k, f) for k, f in enumerate(prints)]).values())) == len(rows)
        elif i == 3:
            assert {r[0] for r in rows} <= {r[0] for r in before}
        elif i == 4:
            assert len(rows) == len(before)
        assert bool(rows) != empty
        docs = after


def test_turns_without_conversation_or_number(spark, tmp_path):
    """A third of the turns lose their number or conversation: all calls stay, and no result goes to another chat's call."""
    odd = read(spark, SF_DIR, "conversations").withColumn("h", F.pmod(F.xxhash64("conv_id", "turn"), F.lit(6)))
    odd = odd.withColumns({"conv_id": F.expr("if(h = 0, null, conv_id)"), "turn": F.expr("if(h = 1, null, turn)")}).drop("h")
    odd.write.parquet(f"{tmp_path}/conversations.parquet")
    turns = read(spark, str(tmp_path), "conversations")
    n = turns.where("role in ('user', 'system')").count()
    out = queries.op5_tool_calls(spark, str(tmp_path)).collect()
    assert len(out) == n and all((r.call_id is None) == (r.turn is None) for r in out)
    assert not any(r.n_results or r.after for r in out if r.conv_id is None or r.turn is None)
    assert all(f'"id":"{r.call_id}","name"' in r.line for r in out if r.turn is not None)
    linked = [tuple(r) for r in queries.op5_tool_call_rows(spark, str(tmp_path)).collect()]
    calls, results = ([r for r in linked if r[0] == kind] for kind in ("call", "unlinked result"))
    assert sum(r[4] for r in calls) == n
    assert sum(r[5] for r in calls) + len(results) == turns.where("role = 'assistant'").count()
    assert [r for r in results if r[1] is None or r[3] is None]
