import random
from pathlib import Path

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from silverline.tables import SnapshotTable, open_table, snapshot_table
from tests.conftest import rows

SHAPE = "k int, g int, v string"


def frame(spark, data, shape=SHAPE):
    return spark.createDataFrame(data, shape)


@pytest.fixture
def table(spark, base):
    return SnapshotTable(spark, base).ensure(frame(spark, []), "k", buckets=4)


def test_created_empty_with_one_snapshot(spark, table, base):
    assert table.exists() and not SnapshotTable(spark, base + "x").exists()
    assert table.current().count() == 0
    assert table.current().dtypes == frame(spark, []).dtypes
    assert [r["operation"] for r in table.snapshots().collect()] == ["create"]
    assert table.previous_snapshot().count() == 0


def test_merges_history_and_reopening(spark, table, base):
    assert table.merge(frame(spark, [(1, 1, "a"), (2, 1, "b"), (None, 1, "n")])) == 2
    assert table.merge(frame(spark, [(2, 0, "B"), (3, 1, "c"), (None, 0, "N")])) == 3
    again = SnapshotTable(spark, base)
    assert rows(again.current()) == sorted([(1, 1, "a"), (2, 0, "B"), (3, 1, "c"), (None, 0, "N")], key=repr)
    assert rows(again.as_of(2)) == sorted([(1, 1, "a"), (2, 1, "b"), (None, 1, "n")], key=repr)
    assert again.as_of(1).count() == 0
    log = again.snapshots().orderBy("snapshot_id").select("inserted", "updated", "total").collect()
    assert [tuple(r) for r in log] == [(0, 0, 0), (3, 0, 3), (1, 2, 4)]
    assert again.first_snapshot().first()["snapshot_id"] == 1
    assert again.previous_snapshot().first()["snapshot_id"] == 2
    assert again.preview(2).count() == 2
    with pytest.raises(ValueError):
        again.as_of(9)


def test_untouched_buckets_are_not_rewritten(spark, base):
    table = SnapshotTable(spark, base).ensure(frame(spark, []), "k", buckets=16)
    table.merge(frame(spark, [(i, 0, "a") for i in range(200)]))
    table.merge(frame(spark, [(5, 1, "z")]))
    files = table.current().inputFiles()
    assert sum("_snapshot_id=3" in f for f in files) == 1
    assert sum("_snapshot_id=2" in f for f in files) == 15
    assert table.current().count() == 200


def test_merging_nothing_still_commits(spark, table):
    table.merge(frame(spark, [(1, 1, "a")]))
    assert table.merge(frame(spark, [])) == 3
    assert rows(table.current()) == [(1, 1, "a")]
    assert table.snapshots().where("snapshot_id = 3").first()["total"] == 1


def test_guard_counts_only_rows_taken(spark, table):
    table.merge(frame(spark, [(1, 5, "a"), (2, 5, "b")]))
    table.merge(frame(spark, [(1, 4, "old"), (2, 6, "new"), (3, 0, "in")]), guard="g")
    assert rows(table.current()) == [(1, 5, "a"), (2, 6, "new"), (3, 0, "in")]
    last = table.snapshots().where("snapshot_id = 3").first()
    assert (last["inserted"], last["updated"], last["total"]) == (1, 1, 3)


def test_large_buckets_are_split_over_tasks(spark, base, monkeypatch):
    monkeypatch.setattr(snapshot_table, "ROWS_PER_TASK", 10)
    table = SnapshotTable(spark, base).ensure(frame(spark, []), "k", buckets=3)
    table.merge(frame(spark, [(i, 0, "a") for i in range(200)]))
    table.merge(frame(spark, [(i, 1, "b") for i in range(150, 260)]))
    table.merge(frame(spark, [(0, 2, "c")]))
    found = {r["k"]: r["v"] for r in table.current().collect()}
    assert table.current().count() == 260
    assert found == {**{i: "a" for i in range(1, 150)}, **{i: "b" for i in range(150, 260)}, 0: "c"}
    assert len(table.current().inputFiles()) > 3


def test_default_tasks_of_a_merge_hold_a_million_rows(spark, base):
    """Rows that compress to next to nothing are spread by their number."""
    table = SnapshotTable(spark, base).ensure(spark.range(0), "id", buckets=1)
    table.merge(spark.range(2_500_000))
    assert len(table.current().inputFiles()) == 3
    assert table.current().agg(F.count("*"), F.count_distinct("id")).first() == (2_500_000, 2_500_000)


def test_unfinished_commit_is_ignored_and_overwritten(spark, table, base, monkeypatch):
    table.merge(frame(spark, [(1, 1, "a")]))

    def lost(*_):
        raise RuntimeError("driver lost")

    # a session that keeps untouched partitions on overwrite must not keep leftovers
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    with monkeypatch.context() as patch:
        patch.setattr(SnapshotTable, "_commit", lost)
        with pytest.raises(RuntimeError):
            table.merge(frame(spark, [(i, 9, "half") for i in range(50)]))
    assert rows(SnapshotTable(spark, base).current()) == [(1, 1, "a")]
    table.merge(frame(spark, [(2, 1, "b")]))
    spark.conf.unset("spark.sql.sources.partitionOverwriteMode")
    assert rows(SnapshotTable(spark, base).current()) == [(1, 1, "a"), (2, 1, "b")]


def test_first_merge_of_nothing(spark, table):
    table.merge(frame(spark, []))
    table.merge(frame(spark, [(1, 1, "a")]))
    assert rows(table.current()) == [(1, 1, "a")]
    log = table.snapshots().orderBy("snapshot_id").select("inserted", "updated", "total").collect()
    assert [tuple(r) for r in log] == [(0, 0, 0), (0, 0, 0), (1, 0, 1)]


def test_repeated_source_keys_leave_the_table_alone(spark, table):
    with pytest.raises(PySparkException, match="several rows for one key"):
        table.merge(frame(spark, [(1, 1, "a"), (1, 2, "b")]))
    assert table.current().count() == 0


def test_ensure_again_checks_keys_and_partitions(spark, table):
    like = frame(spark, [])
    assert table.ensure(like, "k").current().count() == 0
    with pytest.raises(ValueError, match="keyed"):
        table.ensure(like, "g")
    with pytest.raises(ValueError, match="partitioned"):
        table.ensure(like, "k", partitions="v")
    with pytest.raises(ValueError, match="keyed"):
        table.merge(like, "g")
    with pytest.raises(ValueError):
        SnapshotTable(spark, table.base + "2").ensure(like, "k", partitions="nope")
    with pytest.raises(ValueError, match="reserved"):
        SnapshotTable(spark, table.base + "3").ensure(like.withColumn("_key_bucket", F.lit(1)), "k")


def test_recreate_starts_over(spark, table, base):
    table.merge(frame(spark, [(1, 1, "a")]))
    table.ensure(frame(spark, [], "k int, w double"), "k", recreate=True)
    assert table.current().columns == ["k", "w"] and table.current().count() == 0
    assert SnapshotTable(spark, base).snapshots().count() == 1


def test_rows_move_between_partitions(spark, base):
    table = SnapshotTable(spark, base).ensure(frame(spark, []), "k", partitions="g", buckets=2)
    table.merge(frame(spark, [(1, 1, "a"), (2, 1, "b"), (3, None, "c")]))
    table.merge(frame(spark, [(1, 2, "A"), (3, 1, "C")]))
    assert rows(table.current()) == [(1, 2, "A"), (2, 1, "b"), (3, 1, "C")]
    assert any("/g=2/" in f for f in table.current().inputFiles())


def test_empty_text_in_a_partition_column_is_refused(spark, base):
    table = SnapshotTable(spark, base).ensure(frame(spark, []), "k", partitions="v", buckets=2)
    with pytest.raises(PySparkException, match="empty text"):
        table.merge(frame(spark, [(1, 1, "")]))


def test_merge_plan_has_one_exchange_of_the_table(spark, table, monkeypatch):
    """The exchange that brings old and new rows together also clusters the write."""
    seen = []
    real = snapshot_table.newest_side

    def spy(*args, **kwargs):
        out = real(*args, **kwargs)
        seen.append(out._jdf.queryExecution().executedPlan().toString())
        return out

    monkeypatch.setattr(snapshot_table, "newest_side", spy)
    table.merge(frame(spark, [(i, 1, "a") for i in range(50)]))
    table.merge(frame(spark, [(i, 2, "b") for i in range(50)]))
    assert seen[-1].count("Exchange") == 1
    assert "Python" not in seen[-1]


def test_nested_columns_survive(spark, base):
    df = spark.sql("select 1 as k, array(1.5f, 2.5f) as a, map('x', 1) as m, struct(1 as p, 'q' as r) as s")
    table = SnapshotTable(spark, base).ensure(df, "k")
    table.merge(df)
    row = table.current().first()
    assert row["a"] == [1.5, 2.5] and row["m"] == {"x": 1} and row["s"]["r"] == "q"


def test_random_merges_against_a_dictionary(spark, base):
    rng, model = random.Random(7), {}
    table = SnapshotTable(spark, base).ensure(frame(spark, []), "k", buckets=5)
    states = {1: {}}
    for step in range(5):
        batch = {rng.choice([None, *range(30)]): (step, f"{step}-{i}") for i in range(rng.randint(1, 12))}
        snapshot = table.merge(frame(spark, [(k, *v) for k, v in batch.items()]))
        model = {**model, **batch}
        states[snapshot] = model
    for snapshot, state in states.items():
        assert rows(table.as_of(snapshot)) == sorted(((k, *v) for k, v in state.items()), key=repr)


# -- columns -------------------------------------------------------------------


def test_added_column_is_null_for_old_rows_and_makes_no_snapshot(spark, table):
    table.merge(frame(spark, [(1, 1, "a")]))
    table.add_column("note", "string", "it's a note")
    assert rows(table.current()) == [(1, 1, "a", None)]
    assert table.snapshots().count() == 2
    with pytest.raises(ValueError, match="note"):
        table.merge(frame(spark, [(2, 1, "b")]))
    table.merge(frame(spark, [(2, 1, "b")]), fill_missing=True)
    table.merge(frame(spark, [(3, 1, "c", "hi")], SHAPE + ", note string"))
    assert rows(table.current()) == [(1, 1, "a", None), (2, 1, "b", None), (3, 1, "c", "hi")]
    assert [tuple(r) for r in table.describe().collect()][-1] == ("note", "string", "it's a note")
    assert table.current().schema["note"].metadata == {"comment": "it's a note"}


@pytest.mark.parametrize("dtype", ["decimal(10,2)", "array<struct<a:int,b:string>>", "map<string,int>", "struct<x:int>"])
def test_any_type_can_be_added(spark, table, dtype):
    table.merge(frame(spark, [(1, 1, "a")]))
    table.add_column("c", dtype)
    assert dict(table.current().dtypes)["c"] == dtype
    assert table.current().first()["c"] is None


def test_drop_and_add_again_reads_null_in_old_and_rewritten_buckets(spark, base):
    table = SnapshotTable(spark, base).ensure(frame(spark, []), "k", buckets=8)
    table.merge(frame(spark, [(i, 1, "old") for i in range(40)]))
    table.drop_column("v")
    assert table.current().columns == ["k", "g"]
    table.merge(frame(spark, [(1, 2, "ignored")]))
    table.add_column("v", "string")
    table.merge(frame(spark, [(2, 3, "new")]))
    found = {r["k"]: r["v"] for r in table.current().collect()}
    assert found == {**{i: None for i in range(40)}, 2: "new"}
    assert {r["v"] for r in table.as_of(2).collect()} == {"old"}
    assert table.as_of(3).columns == ["k", "g"]


def test_column_changes_are_validated(spark, base):
    table = SnapshotTable(spark, base).ensure(frame(spark, []), "k", partitions="g")
    for name in ("k", "g"):
        with pytest.raises(ValueError):
            table.drop_column(name)
    with pytest.raises(ValueError):
        table.drop_column("nope")
    with pytest.raises(ValueError):
        table.add_column("V", "int")
    with pytest.raises(PySparkException):
        table.add_column("w", "int); drop table x")
    assert table.describe().count() == 3


def test_open_table(spark, tmp_path):
    assert open_table(spark, None, "d", "t", str(tmp_path)).base == f"{tmp_path}/d/t"
    with pytest.raises(ValueError):
        open_table(spark, "unknown", "d", "t")
    with pytest.raises(ValueError, match="no table"):
        open_table(spark, None, "d", "t", str(tmp_path)).current()


def test_keys_and_guards_are_never_filled(spark, table):
    table.merge(frame(spark, [(1, 1, "a")]))
    for missing, guard in (("k", ()), ("g", "g")):
        with pytest.raises(ValueError, match="not found"):
            table.merge(frame(spark, [(2, 2, "b")]).drop(missing), guard=guard, fill_missing=True, source_unique=True)
    assert rows(table.current()) == [(1, 1, "a")]


def test_repeated_source_keys_fail_on_first_and_later_merges(spark, table):
    twice = frame(spark, [(1, 1, "a"), (1, 2, "b"), (None, 0, "n")])
    for _ in range(2):
        with pytest.raises(PySparkException, match="several rows for one key"):
            table.merge(twice, source_unique=True)
        table.merge(frame(spark, [(1, 1, "kept")]))
        assert rows(table.current()) == [(1, 1, "kept")]


def test_other_buckets_than_the_tables_own_are_refused(spark, table):
    with pytest.raises(ValueError, match="4 buckets"):
        table.ensure(frame(spark, []), "k", buckets=8)
    assert table.ensure(frame(spark, []), "k") is table


def test_small_feeds_leave_most_files_alone(spark, base):
    table = SnapshotTable(spark, base).ensure(frame(spark, []), "k", buckets=64)
    table.merge(spark.range(5000).selectExpr("int(id) as k", "1 as g", "'a' as v"))
    before = set(table.current().inputFiles())
    table.merge(frame(spark, [(7, 2, "b"), (8, 2, "b")]))
    assert len(before & set(table.current().inputFiles())) >= 62


def test_partitioned_files_follow_buckets_and_partitions(spark, base):
    table = SnapshotTable(spark, base, rows_per_task=100).ensure(frame(spark, []), "k", partitions="g", buckets=2)
    many = spark.range(4000).selectExpr("int(id) as k", "int(id % 20) as g", "'a' as v")
    for data in (many, many.withColumn("v", F.lit("b"))):
        table.merge(data)
        assert len(table.current().inputFiles()) <= 2 * 2 * 20
    assert table.current().where("v = 'b'").count() == 4000


def test_types_with_awkward_names_read_back(spark, table):
    table.add_column("st", "struct<`a b`:int,c:array<string>>")
    assert table.current().schema["st"].dataType.simpleString() == "struct<a b:int,c:array<string>>"
    table.merge(frame(spark, [(1, 1, "a")]), fill_missing=True)
    assert rows(table.current()) == [(1, 1, "a", None)]


def test_buckets_follow_the_first_load(spark, base):
    """Far above the bucket size a feed of few keys leaves most files as they are."""
    table = SnapshotTable(spark, base, bucket_bytes=10_000).ensure(frame(spark, []), "k")
    table.merge(frame(spark, []))
    assert table._definition().buckets == 0
    many = spark.range(20_000).select(F.col("id").alias("k"), F.lit(0).alias("g"), F.sha2(F.col("id").cast("string"), 256).alias("v"))
    many = many.select(*[F.col(f.name).cast(f.dataType) for f in table.schema])
    table.merge(many)
    buckets = table._definition().buckets
    assert buckets > 64
    with pytest.raises(ValueError, match=f"{buckets} buckets"):
        table.ensure(frame(spark, []), "k", buckets=16)
    table.merge(many.where("k in (5, 7, 11)"))
    first, last = (len(list(Path(table._path("data")).glob(f"_snapshot_id={n}/_key_bucket=*"))) for n in (3, 4))
    assert first == buckets and last <= 3
    assert rows(table.current()) == rows(many)
    again = SnapshotTable(spark, base)
    assert again._definition().buckets == buckets and again.current().count() == 20_000


def test_wide_rows_are_merged_by_more_tasks(spark, base):
    table = SnapshotTable(spark, base, task_bytes=2000).ensure(frame(spark, []), "k", buckets=2)
    many = spark.range(500).select(F.col("id").alias("k"), F.lit(0).alias("g"), F.sha2(F.col("id").cast("string"), 256).alias("v"))
    many = many.select(*[F.col(f.name).cast(f.dataType) for f in table.schema])
    table.merge(many)
    assert len(list(Path(table._path("data")).glob("**/*.parquet"))) > 8
    assert rows(table.current()) == rows(many)


def test_a_small_merge_is_few_jobs(spark, base):
    """Rows and buckets are counted by the runs that write them, sizes come from listings."""
    table = SnapshotTable(spark, base)
    rows_ = spark.range(5000).selectExpr("id as k", "id % 7 as v")
    table.ensure(rows_, "k")
    table.merge(rows_)
    one = spark.createDataFrame([(17, -1)], "k long, v long")
    spark.sparkContext.setJobGroup("one-row merge", "one-row merge")
    try:
        table.merge(one)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("one-row merge")) <= 6
    assert table.current().where("v = -1").count() == 1 and table.current().count() == 5000
    commit = table.snapshots().orderBy("snapshot_id").collect()[-1]
    assert (commit.inserted, commit.updated, commit.total) == (0, 1, 5000)
