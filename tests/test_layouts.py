"""Bucketed tables, merges by partition, split merges and digest reports: rows, plans and files."""

import random
import re
from pathlib import Path

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from silverline.functions.cells import in_cells, key_cell
from silverline.operators import column_diffs, digest_report, latest_per_key, report, upsert
from silverline.plans import Feed, consolidate
from silverline.session import materialise
from silverline.sinks import write_partitioned
from silverline.tables import BucketedTable, merge_partitions
from tests.conftest import rows

SHAPE = "k int, j string, g int, v string"


def exchanges(plan):
    return len(re.findall(r"Exchange hashpartitioning", plan))


def some_rows(spark, n, seed, keys=40, unique=True):
    rng = random.Random(seed)
    data = [(rng.choice([None, *range(keys)]), rng.choice([None, "a", "b"]), rng.choice([None, 1, 2, 3]), f"v{i}") for i in range(n)]
    if unique:
        data = list({(k, j): (k, j, g, v) for k, j, g, v in data}.values())
    return spark.createDataFrame(data, SHAPE)


def test_cells(spark):
    df = spark.range(3000).select(F.col("id").alias("k")).withColumn("c", key_cell(["k"], 200))
    for chosen in ([], [0], [63, 64, 199], list(range(200))):
        found = {r[0] for r in df.where(in_cells(F.col("c"), chosen, 200)).select("c").distinct().collect()}
        assert found == set(chosen)


# -- bucketed table -----------------------------------------------------------


@pytest.fixture
def silver(spark, tmp_path, request):
    name = re.sub(r"\W", "_", request.node.name).lower()
    yield BucketedTable(spark, ["default", name], str(tmp_path / "bucketed"))
    spark.sql(f"DROP VIEW IF EXISTS default.{name}")


@pytest.mark.parametrize("buckets", [None, 20])
def test_bucketed_merges_equal_upserts(spark, silver, buckets):
    changes = [some_rows(spark, 60, s) for s in range(3)]
    silver.ensure(changes[0], "k,j", buckets=buckets)
    expected = changes[0].limit(0)
    for df in changes:
        silver.merge(df, "k,j", guard="g")
        expected = materialise(upsert(expected, df, "k,j", guard="g", strategy="full_outer"), "expected")
        assert rows(silver.current()) == rows(expected)
    assert (silver.keys, silver.buckets) == (["k", "j"], buckets or 8)
    left = [t.name for t in spark.catalog.listTables("default") if t.name.startswith(silver.parts[-1] + "__")]
    assert len(left) == 2
    assert rows(silver.ensure(changes[0], "k,j", recreate=True).current()) == []


def test_silver_is_not_shuffled(spark, silver, plan_of):
    """One exchange, the feed's own, in merge and report; none where the table's rows are only grouped by key."""
    feed = materialise(some_rows(spark, 400, 1, unique=False), "feed")
    silver.ensure(feed, "k")
    silver.merge(latest_per_key(feed, "k", "g", tiebreak="v"), source_unique=True)
    source = latest_per_key(feed, "k", "g", tiebreak="v")
    held = silver.current()
    assert exchanges(plan_of(upsert(held, source, "k", source_unique=True))) == 1
    with_small_joins = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        for safe in (False, True):
            checks = report(source, held, "k", silver_unique=True, null_safe=safe)
            assert exchanges(plan_of(checks)) == 1
            assert checks.where("check = 'column_values' and not passed").count() == 0
        assert exchanges(plan_of(column_diffs(source, held, "k", null_safe=True))) == 1
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", with_small_joins)
    assert exchanges(plan_of(held.groupBy("k").count())) == 0


def test_bucketed_files_are_sorted_buckets(spark, silver, tmp_path):
    df = some_rows(spark, 300, 5)
    silver.ensure(df, "k,j", buckets=4)
    silver.merge(df)
    files = [f for f in (tmp_path / "bucketed" / "2").glob("*.parquet")]
    assert len(files) == 4
    for f in files:
        keys = [(r.k is not None, r.k, r.j is not None, r.j) for r in spark.read.parquet(str(f)).collect()]
        assert keys == sorted(keys, key=lambda x: (x[0], x[1] or 0, x[2], x[3] or ""))


def test_bucketed_refusals(spark, silver, tmp_path):
    df = some_rows(spark, 20, 2)
    with pytest.raises(ValueError, match="no table"):
        silver.merge(df)
    silver.ensure(df, "k,j")
    with pytest.raises(ValueError, match="keyed by"):
        silver.ensure(df, "k")
    with pytest.raises(ValueError, match="buckets"):
        silver.ensure(df, "k,j", buckets=3)
    with pytest.raises(ValueError, match="no partition columns"):
        silver.ensure(df, "k,j", partitions="g")
    with pytest.raises(ValueError, match="keyed by"):
        silver.merge(df, "v")
    with pytest.raises(PySparkException, match="several rows"):
        silver.merge(df.union(df))
    assert silver.current().count() == 0


def test_consolidate_into_a_bucketed_table(spark, silver, tmp_path):
    feed = some_rows(spark, 200, 3, unique=False).withColumn("day", F.coalesce("g", F.lit(0)))
    path = write_partitioned(feed, str(tmp_path / "feed"), ["day"])
    consolidate(spark, Feed(path, "day"), silver, "k", "g", tiebreak="v")
    expected = latest_per_key(feed, "k", "g", tiebreak="v")
    assert rows(silver.current().select(*expected.columns)) == rows(expected)


# -- partitions ---------------------------------------------------------------


def files_of(path):
    return {p.parent.name: {f.name for f in p.parent.glob("*.parquet")} for p in Path(path).rglob("*.parquet")}


@pytest.fixture
def stored(spark, tmp_path):
    """Days 1 to 4 with two rows each; key 30 is alone on day 5, key 40 on the day without a name."""
    data = [(10 * d + i, d, f"old{d}{i}") for d in range(1, 5) for i in (0, 1)] + [(50, 5, "lone"), (60, None, "nowhere")]
    return write_partitioned(spark.createDataFrame(data, "k int, day int, v string"), str(tmp_path / "silver"), ["day"])


def test_untouched_partitions_keep_their_files(spark, stored):
    before = files_of(stored)
    source = spark.createDataFrame([(10, 1, "new"), (99, 6, "first of its day")], "k int, day int, v string")
    assert merge_partitions(spark, stored, source, "k", "day") == 2
    after = files_of(stored)
    assert set(after) - set(before) == {"day=6"}
    assert {d for d in before if before[d] != after[d]} == {"day=1"}
    assert rows(spark.read.parquet(stored).where("day in (1, 6)").select("k", "v")) == [(10, "new"), (11, "old11"), (99, "first of its day")]


def test_keys_that_move(spark, stored):
    """From day 2 to 3, from the lone day 5, which goes, and to the day without a name."""
    source = spark.createDataFrame([(20, 3, "moved"), (50, 4, "moved"), (41, None, "moved")], "k int, day int, v string")
    before = files_of(stored)
    assert merge_partitions(spark, stored, source, "k", "day") == 5
    after = spark.read.parquet(stored)
    assert rows(after.where("v = 'moved'").select("k", "day")) == [(20, 3), (41, None), (50, 4)]
    assert after.count() == 10 and after.select("k").distinct().count() == 10
    assert "day=5" not in files_of(stored) and files_of(stored)["day=1"] == before["day=1"]


def test_keys_that_stay(spark, stored):
    source = spark.createDataFrame([(20, 3, "second"), (30, 3, "new")], "k int, day int, v string")
    assert merge_partitions(spark, stored, source, "k", "day", moves="ignore") == 1
    assert rows(spark.read.parquet(stored).where("k in (20, 30)").select("k", "day", "v")) == [(20, 2, "old20"), (20, 3, "second"), (30, 3, "new")]


def test_random_partition_merges(spark, tmp_path):
    path, expected = str(tmp_path / "silver"), None
    for seed in range(3):
        source = some_rows(spark, 30, seed, keys=8).withColumn("p", F.expr("concat('p=/', v like '%1%')"))
        merge_partitions(spark, path, source, "k,j", "g,p", guard="g")
        expected = source if expected is None else upsert(expected, source, "k,j", guard="g", strategy="full_outer")
        expected = materialise(expected, "expected")
        assert rows(spark.read.parquet(path).select(*expected.columns).withColumn("p", F.col("p").cast("string"))) == rows(expected)


def test_partition_refusals(spark, stored):
    source = spark.createDataFrame([(1, 1, "a"), (1, 2, "b")], "k int, day int, v string")
    before = files_of(stored)
    with pytest.raises(PySparkException, match="several rows"):
        merge_partitions(spark, stored, source, "k", "day")
    with pytest.raises(ValueError, match="that move"):
        merge_partitions(spark, stored, source, "k", "day", moves="jump")
    with pytest.raises(ValueError, match="partition"):
        merge_partitions(spark, stored, source, "k", "")
    assert merge_partitions(spark, stored, source.limit(0), "k", "day") == 0
    assert files_of(stored) == before


# -- split merge --------------------------------------------------------------


@pytest.mark.parametrize("seed", range(4))
def test_split_equals_window(spark, seed):
    target = materialise(some_rows(spark, 300, seed, keys=100), "target")
    source = some_rows(spark, [0, 1, 5, 200][seed], seed + 50, keys=100)
    for guard in ((), "g"):
        window = upsert(target, source, "k,j", guard=guard, strategy="window")
        assert rows(upsert(target, source, "k,j", guard=guard, strategy="split")) == rows(window)


def test_split_of_null_keys_only(spark):
    target = some_rows(spark, 300, 1, keys=100)
    source = spark.createDataFrame([(None, None, 9, "new")], SHAPE)
    assert rows(upsert(target, source, "k,j", strategy="split")) == rows(upsert(target, source, "k,j", strategy="window"))


def test_split_shuffles_the_matching_slice(spark):
    """Of 20,000 target rows those in the few cells of the three source keys cross the exchange."""
    target = materialise(spark.range(20_000).select(F.col("id").alias("k"), F.lit("t").alias("v")), "target")
    source = spark.createDataFrame([(5, "s"), (700, "s"), (9_000, "s")], "k long, v string")
    merged = upsert(target, source, "k", strategy="split")
    assert merged.where("v = 's'").count() == 3 and merged.count() == 20_000
    merged.collect()
    plan = merged._jdf.queryExecution().executedPlan()
    text = plan.toString()
    assert text.count("Exchange hashpartitioning") == text.count("Exchange hashpartitioning(k")
    slice_ = target.where(in_cells(key_cell(["k"], 1024), [r[0] for r in source.select(key_cell(["k"], 1024)).collect()], 1024))
    assert slice_.count() < 200
    assert re.search(r"PushedFilters: \[[^]]*GreaterThanOrEqual\(k,5\)", text)


# -- digests ------------------------------------------------------------------


@pytest.mark.parametrize("null_safe", [False, True])
@pytest.mark.parametrize("seed", range(2))
def test_digest_report_equals_report(spark, seed, null_safe):
    """Fresh, stale and repeated silver, with NULLs among keys and values."""
    bronze = materialise(some_rows(spark, 200, seed, keys=60), "bronze")
    stale = materialise(bronze.withColumn("v", F.expr("if(pmod(hash(k), 9) = 1, 'changed', v)")).where("k is null or k <> 3"), "stale")
    doubled = materialise(stale.union(stale.where("k < 20").withColumn("g", F.lit(7))), "doubled")
    swapped = materialise(bronze.withColumn("k", F.expr("case k when 1 then 2 when 2 then 1 else k end")), "swapped")
    cases = [(bronze, None, 64), (stale, None, 4096), (stale, "v", 1), (doubled, None, 64), (swapped, "v", 4096), (bronze.limit(0), None, 64)]
    for silver, columns, cells in cases:
        expected = rows(report(bronze, silver, "k,j", columns, null_safe=null_safe))
        assert rows(digest_report(bronze, silver, "k,j", columns, null_safe=null_safe, cells=cells)) == expected


def test_digests_see_nulls_and_empty_arrays(spark):
    """Values that Spark's hashes pass over alike."""
    shape = "k int, j int, a array<array<int>>, s struct<x:int,y:int>"
    left = [(1, None, [[1], None], (1, None)), (2, 2, [[], [1]], None), (3, 3, None, (None, 4)), (4, 4, [[1, None]], (None, None))]
    right = [(None, 1, [[1], None], (1, None)), (2, 2, [[1], []], (None, None)), (3, 3, [], (4, None)), (4, 4, [[None, 1]], (None, None))]
    left, right = (spark.createDataFrame(x, shape) for x in (left, right))
    expected = rows(report(left, right, "k,j", null_safe=True))
    assert rows(digest_report(left, right, "k,j", null_safe=True, cells=1)) == expected
    assert {r[1]: r[4] for r in expected} == {"rows": 0, "missing": 1, "a": 3, "s": 2}


def test_digest_report_of_unlike_tables(spark):
    bronze = some_rows(spark, 50, 1)
    silver = bronze.drop("g").withColumn("extra", F.lit(1)).withColumn("k", F.col("k").cast("long"))
    assert rows(digest_report(bronze, silver, "k,j")) == rows(report(bronze, silver, "k,j"))
    keys_only = bronze.select("k", "j")
    assert rows(digest_report(keys_only, keys_only, "k,j")) == rows(report(keys_only, keys_only, "k,j"))


# -- null-safe pairs ----------------------------------------------------------


def test_null_safe_pairs_count_every_silver_row(spark, plan_of):
    bronze = spark.createDataFrame([(1, "x"), (None, None), (3, "z")], "k int, v string")
    silver = spark.createDataFrame([(1, "x"), (1, "y"), (1, None), (None, None), (None, "n"), (4, "q")], "k int, v string")
    diffs = column_diffs(bronze, silver, "k", null_safe=True)
    assert exchanges(plan_of(diffs)) == 1
    assert rows(diffs) == [(3,)]
    checks = report(bronze, silver, "k", null_safe=True)
    assert exchanges(plan_of(checks)) <= 2
    assert {(r["check"], r["item"]): r.violations for r in checks.collect()} == {
        ("counts", "rows"): 3, ("key_coverage", "missing"): 1, ("column_values", "v"): 3,
    }
