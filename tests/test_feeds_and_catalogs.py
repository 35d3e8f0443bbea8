"""Feeds that change their columns, partitions named by a table, several tables at once, maps, appends to a catalog."""

import random
import threading

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from silverline.functions.columns import comparable_maps
from silverline.operators import column_diffs, digest_report, latest_per_key, report
from silverline.plans import Consolidation, Feed, TablesFailed, consolidate_all, reconcile, run_together
from silverline.sinks import write_partitioned
from silverline.sources import evolving_schema, merge_schemas, read_partitioned
from silverline.sources.evolving import wider
from silverline.tables import BucketedTable, CatalogTable, SnapshotTable
from tests.conftest import rows

# -- columns that change ------------------------------------------------------


@pytest.mark.parametrize(
    "a, b, both",
    [
        ("tinyint", "int", "int"),
        ("int", "bigint", "bigint"),
        ("float", "double", "double"),
        ("int", "double", "double"),
        ("date", "timestamp_ntz", "timestamp_ntz"),
        ("decimal(5,2)", "decimal(8,1)", "decimal(9,2)"),
        ("decimal(5,2)", "int", "decimal(12,2)"),
        ("array<int>", "array<bigint>", "array<bigint>"),
        ("map<string,int>", "map<string,double>", "map<string,double>"),
        ("struct<a:int>", "struct<b:string,a:bigint>", "struct<a:bigint,b:string>"),
    ],
)
def test_wider_types(spark, a, b, both):
    kinds = [T.StructType.fromDDL(f"c {x}")[0].dataType for x in (a, b, both)]
    assert wider(kinds[0], kinds[1]).simpleString() == both
    assert wider(kinds[1], kinds[0]).simpleString() in (both, "struct<b:string,a:bigint>")


@pytest.mark.parametrize("a, b", [("int", "string"), ("bigint", "double"), ("decimal(38,0)", "decimal(5,4)"), ("array<int>", "int")])
def test_types_without_a_common_one(spark, a, b):
    with pytest.raises(ValueError, match="column x.*no common type"):
        merge_schemas(spark, [T.StructType.fromDDL(f"x {k}") for k in (a, b)])


@pytest.fixture
def changing(spark, tmp_path):
    path = str(tmp_path / "feed")
    days = [
        ("2024-01-01", "id int, v float, Gone string", [(1, 0.5, "g"), (2, None, None)]),
        ("2024-01-02", "id bigint, v double, s struct<a:int>", [(2**40, 1e300, (1,))]),
        ("2024-01-03", "v int, id smallint, s struct<a:bigint,b:string>, gone string", [(7, 3, (2**40, "x"), "back")]),
    ]
    for day, shape, data in days:
        write_partitioned(spark.createDataFrame(data, shape).withColumn("day", F.lit(day)), path, ["day"], touched_only=True)
    return path


def test_days_of_different_columns_are_one_scan(spark, changing, plan_of):
    df = read_partitioned(spark, changing, "day", evolving=True)
    assert df.drop("day").schema.simpleString() == "struct<id:bigint,v:double,Gone:string,s:struct<a:bigint,b:string>>"
    expected = [
        (1, 0.5, "g", None), (2, None, None, None), (2**40, 1e300, None, (1, None)), (3, 7.0, "back", (2**40, "x")),
    ]
    assert rows(df.drop("day")) == sorted(expected, key=repr)
    plan = plan_of(df.where("day = '2024-01-02'").select("id"))
    assert plan.count("FileScan") == 1 and "Union" not in plan and "PartitionFilters: [isnotnull(day" in plan
    assert read_partitioned(spark, changing, "day", ["2024-01-03"], evolving=True).select("Gone").first()[0] == "back"


def test_consolidate_across_a_schema_change(spark, changing, tmp_path):
    silver = SnapshotTable(spark, str(tmp_path / "silver"))
    work = {"t": Consolidation(Feed(changing, "day", evolving=True), silver, "id", "day")}
    consolidate_all(spark, work)
    assert rows(silver.current().select("id", "v")) == [(1, 0.5), (1099511627776, 1e300), (2, None), (3, 7.0)]


def test_evolving_refusals(spark, changing, tmp_path):
    with pytest.raises(ValueError, match="no directories"):
        evolving_schema(spark, changing, "month")
    with pytest.raises(ValueError, match="evolve"):
        read_partitioned(spark, changing, "day", evolving=True, schema="id int")
    odd = spark.createDataFrame([("text",)], "id string").withColumn("day", F.lit("2024-01-04"))
    write_partitioned(odd, changing, ["day"], touched_only=True)
    with pytest.raises(ValueError, match="column id: bigint and string"):
        read_partitioned(spark, changing, "day", evolving=True)


# -- partitions named by a table ----------------------------------------------


@pytest.fixture
def daily(spark, tmp_path):
    df = spark.range(200).withColumn("day", F.expr("date_add(date'2024-01-01', cast(id % 20 as int))"))
    return write_partitioned(df, str(tmp_path / "daily"), ["day"])


def test_a_table_of_days_prunes_the_scan(spark, daily):
    days = spark.createDataFrame([("2024-01-03",), ("2024-01-17",), ("2024-01-03",), (None,), ("2030-01-01",)], "d string")
    df = read_partitioned(spark, daily, "day", days)
    assert rows(df.select("id")) == sorted(((i,) for i in range(200) if i % 20 in (2, 16)), key=repr)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan and "BroadcastHashJoin" in plan
    files = df.select(F.input_file_name()).distinct().count()
    assert files == 2
    assert Feed(daily, "day", days).read(spark).count() == 20


def test_an_empty_table_of_days_is_an_error(spark, daily):
    days = spark.createDataFrame([(None,)], "d date")
    with pytest.raises(ValueError, match="empty"):
        read_partitioned(spark, daily, "day", days)
    with pytest.raises(ValueError, match="column"):
        read_partitioned(spark, daily, None, days)


# -- several tables at once ---------------------------------------------------


def test_one_failing_table_leaves_the_others_committed(spark, tmp_path):
    feed = spark.createDataFrame([(1, "a", 1), (1, "b", 2), (2, "c", 1)], "k int, v string, day int")
    path = write_partitioned(feed, str(tmp_path / "feed"), ["day"])
    tables = {n: SnapshotTable(spark, str(tmp_path / n)) for n in ("first", "broken", "last")}
    work = {
        "first": Consolidation(Feed(path, "day"), tables["first"], "k", "day"),
        "broken": Consolidation(Feed(path, "day"), tables["broken"], "nothing", "day"),
        "last": Consolidation(Feed(path, "day", ["1"]), tables["last"], "k", "day", {"strategy": "max_by"}),
    }
    with pytest.raises(TablesFailed, match="broken: ValueError: key columns not found") as failed:
        consolidate_all(spark, work, threads=3)
    assert set(failed.value.errors) == {"broken"}
    assert rows(tables["first"].current().select("k", "v")) == [(1, "b"), (2, "c")]
    assert rows(tables["last"].current().select("k", "v")) == [(1, "a"), (2, "c")]


def test_work_runs_side_by_side_in_its_own_pool(spark):
    meeting = threading.Barrier(3, timeout=60)
    pools = {}

    def task(name):
        meeting.wait()  # all three are under way
        pools[name] = spark.sparkContext.getLocalProperty("spark.scheduler.pool")
        return spark.range(10).count()

    done = run_together(spark, {n: lambda n=n: task(n) for n in "abc"}, threads=3)
    assert [o.value for o in done.values()] == [10, 10, 10] and list(done) == ["a", "b", "c"]
    assert pools == {"a": "a", "b": "b", "c": "c"}
    assert spark.sparkContext.getLocalProperty("spark.scheduler.pool") is None
    assert run_together(spark, {}) == {}


# -- maps ---------------------------------------------------------------------

MAPS = "k int, m map<string,int>, d array<map<string,struct<x:map<int,string>,y:int>>>"


def test_maps_are_compared_by_their_entries(spark):
    left = [
        (1, {"a": 1, "b": 2}, [{"p": ({1: "x", 2: "y"}, 1), "q": (None, 2)}]),
        (2, {"a": None}, None),
        (3, None, []),
        (4, {}, [{}, None]),
        (None, {"a": 1}, None),
    ]
    right = [
        (1, {"b": 2, "a": 1}, [{"q": (None, 2), "p": ({2: "y", 1: "x"}, 1)}]),
        (2, {"a": 0}, []),
        (3, {}, []),
        (4, {}, [None, {}]),
        (None, {"a": 1}, None),
    ]
    left, right = (spark.createDataFrame(x, MAPS) for x in (left, right))
    assert column_diffs(left, right, "k", null_safe=True, maps=True).first().asDict() == {"m": 2, "d": 2}
    assert column_diffs(left, right, "k", maps=True).first().asDict() == {"m": 1, "d": 1}
    for check in (report, digest_report):
        found = {r.item: r.violations for r in check(left, right, "k", null_safe=True, maps=True).collect()}
        assert found == {"rows": 0, "missing": 0, "m": 2, "d": 2}
        single = check(left, right, "k", null_safe=True, maps=True, silver_unique=True)
        assert {r.item: r.violations for r in single.collect()} == found


def test_random_maps(spark):
    rng = random.Random(6)
    data = [(i, {str(k): rng.randrange(3) for k in rng.sample(range(6), rng.randrange(6))}) for i in range(80)]
    shuffled = [(i, dict(rng.sample(list(m.items()), len(m)))) for i, m in data]
    changed = [(i, m | {"0": 9} if i % 5 == 0 else m) for i, m in shuffled]
    shape = "k int, m map<string,int>"
    left, same, other = (spark.createDataFrame(x, shape) for x in (data, shuffled, changed))
    assert column_diffs(left, same, "k", maps=True).first().m == 0
    assert column_diffs(left, other, "k", maps=True).first().m == sum(m != n for (_, m), (_, n) in zip(data, changed))
    assert comparable_maps(left).select("m").dtypes == [("m", "array<struct<key:string,value:int>>")]


def test_reconcile_job_with_maps(spark, tmp_path):
    feed = spark.createDataFrame([(1, {"a": 1, "b": 2}, 1), (2, {"c": 3}, 1)], "k int, m map<string,int>, day int")
    path = write_partitioned(feed, str(tmp_path / "feed"), ["day"])
    silver = spark.createDataFrame([(1, {"b": 2, "a": 1}, 1), (2, {"c": 4}, 1)], "k int, m map<string,int>, day int")
    checks = reconcile(spark, Feed(path, "day"), silver, "k", "day", maps=True)
    assert {r.item: r.violations for r in checks.collect()} == {"rows": 0, "missing": 0, "m": 1}


# -- catalog ------------------------------------------------------------------


def test_append_matches_by_name(spark):
    made = CatalogTable(spark, ["spark_catalog", "default", "appended"], provider="parquet")
    like = spark.createDataFrame([(1, "x", 2.0)], "k int, v string, n double")
    try:
        made.ensure(like, "k", partitions="v", recreate=True)
        made.append(like.select("n", "k", "v", F.lit(1).alias("unknown")))
        with pytest.raises(ValueError, match="not found"):
            made.append(like.drop("n"))
        made.append(like.drop("n"), fill_missing=True)
        assert rows(made.current().select("k", "v", "n")) == [(1, "x", 2.0), (1, "x", None)]
    finally:
        made.drop()
    assert not made.exists()


def test_bucketed_tables_take_part(spark, tmp_path):
    """The table of the catalog that merges without a shuffle of its own, among several tables."""
    feed = spark.createDataFrame([(i % 7, f"v{i}", i % 3) for i in range(40)], "k int, v string, day int")
    path = write_partitioned(feed, str(tmp_path / "feed"), ["day"])
    silver = BucketedTable(spark, ["default", "taking_part"], str(tmp_path / "silver"))
    try:
        consolidate_all(spark, {"one": Consolidation(Feed(path, "day"), silver, "k", "day", {"tiebreak": "v"})})
        assert rows(silver.current().select(*feed.columns)) == rows(latest_per_key(feed, "k", "day", tiebreak="v"))
    finally:
        spark.sql("DROP VIEW IF EXISTS default.taking_part")
