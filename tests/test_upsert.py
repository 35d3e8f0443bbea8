import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException

from silverline.operators import align, require_unique_keys, upsert, upsert_summary
from silverline.operators import latest_per_key
from silverline.operators.upsert import STRATEGIES
from tests.conftest import rows

SHAPE = "k int, j string, g int, v string"


@pytest.fixture
def target(spark):
    return spark.createDataFrame(
        [(1, "x", 5, "t1"), (2, "x", 5, "t2"), (None, "x", None, "t3"), (None, None, 1, "t4")], SHAPE
    )




both = pytest.mark.parametrize("strategy", ["full_outer", "anti_join"])
every = pytest.mark.parametrize("strategy", STRATEGIES)


@every
def test_matches_replace_rest_stays_and_new_rows_arrive(spark, target, strategy):
    source = spark.createDataFrame([(1, "x", 1, "s1"), (3, "x", 9, "s2"), (None, None, 0, "s3")], SHAPE)
    merged = upsert(target, source, "k,j", strategy=strategy)
    assert merged.columns == target.columns
    assert rows(merged) == sorted(
        [(1, "x", 1, "s1"), (2, "x", 5, "t2"), (None, "x", None, "t3"), (None, None, 0, "s3"), (3, "x", 9, "s2")],
        key=repr,
    )


@every
def test_guard_refuses_older_rows_and_null_is_oldest(spark, target, strategy):
    source = spark.createDataFrame(
        [(1, "x", 4, "old"), (2, "x", 5, "same"), (None, "x", None, "both null"), (None, None, None, "null")], SHAPE
    )
    merged = {r["v"] for r in upsert(target, source, ["k", "j"], guard="g", strategy=strategy).collect()}
    assert merged == {"t1", "same", "both null", "t4"}


def test_columns_are_matched_by_name_and_type(spark, target):
    source = spark.createDataFrame([("s", 7, 1, 8, "x")], "V string, K long, extra int, G short, J string")
    aligned = align(source, target.schema)
    assert [(f.name, f.dataType) for f in aligned.schema] == [(f.name, f.dataType) for f in target.schema]
    assert rows(aligned) == [(7, "x", 8, "s")]


def test_missing_source_column(spark, target):
    source = spark.createDataFrame([(7, "x")], "k int, j string")
    with pytest.raises(ValueError, match="g"):
        upsert(target, source, ["k", "j"])
    assert (7, "x", None, None) in rows(upsert(target, source, ["k", "j"], fill_missing=True))


@every
def test_repeated_source_keys_fail_when_run(spark, target, strategy):
    source = spark.createDataFrame([(9, "x", 1, "a"), (9, "x", 2, "b")], SHAPE)
    plan = upsert(target, source, ["k", "j"], strategy=strategy)
    with pytest.raises(PySparkException, match="several rows for one key"):
        plan.collect()
    with pytest.raises(PySparkException, match="several rows for one key"):
        plan.count()
    nulls = spark.createDataFrame([(None, None, 1, "a"), (None, None, 2, "b")], SHAPE)
    with pytest.raises(PySparkException, match="several rows for one key"):
        require_unique_keys(nulls, "k,j").collect()
    assert require_unique_keys(target, "k,j").count() == 4


def test_summary_counts_by_marker_not_by_null_key(spark, target):
    source = spark.createDataFrame([(1, "x", 1, "s"), (None, None, 0, "s"), (8, None, 0, "s")], SHAPE)
    assert rows(upsert_summary(target, source, "k,j")) == [(1, 2, 2)]


@both
def test_plan_is_a_null_safe_equi_join(spark, target, plan_of, strategy):
    source = spark.createDataFrame([(1, "x", 1, "s1")], SHAPE)
    text = plan_of(upsert(target, source, ["k", "j"], guard="g", source_unique=True, strategy=strategy))
    assert {"full_outer": "FullOuter", "anti_join": "LeftAnti"}[strategy] in text
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python"):
        assert bad not in text


def test_full_outer_evaluates_the_source_once(spark, target, plan_of):
    source = spark.range(10).selectExpr("int(id) k", "'x' j", "1 g", "string(rand()) v")
    text = plan_of(upsert(target, source, ["k", "j"], source_unique=True))
    assert text.count("Range (0, 10") == 1


def test_window_takes_over_the_exchanges_of_deduplicated_sides(spark, tmp_path, plan_of):
    """Two hash exchanges, those of the deduplication: the merge adds none."""
    path = str(tmp_path / "feed")
    spark.range(500).selectExpr("id % 90 k", "id o", "string(id) v").write.parquet(path)
    feed = spark.read.parquet(path)
    sides = [latest_per_key(feed.where(c), "k", "o") for c in ("o < 300", "o >= 300")]
    merged = upsert(*sides, "k", source_unique=True)
    assert plan_of(merged).count("Exchange hashpartitioning") == 2
    assert rows(merged) == rows(upsert(*sides, "k", source_unique=True, strategy="full_outer"))


@pytest.mark.parametrize("guard", [(), "g"])
def test_repeated_target_keys_stay_until_they_are_replaced(spark, target, guard):
    twice = target.union(target)
    source = spark.createDataFrame([(1, "x", 9, "s1")], SHAPE)
    merged = upsert(twice, source, ["k", "j"], guard=guard, strategy="window")
    assert [r[3] for r in rows(merged)].count("s1") == 1
    assert merged.count() == 7
    assert rows(merged) == rows(upsert(twice, source, ["k", "j"], guard=guard, strategy="anti_join"))


def test_unknown_strategy(target):
    with pytest.raises(ValueError):
        upsert(target, target, ["k", "j"], strategy="guess")


keyed = st.dictionaries(
    st.tuples(st.one_of(st.none(), st.integers(0, 4)), st.one_of(st.none(), st.sampled_from("ab"))),
    st.tuples(st.one_of(st.none(), st.integers(0, 3)), st.text("xyz", max_size=2)),
    max_size=8,
)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(held=keyed, new=keyed, strategy=st.sampled_from(STRATEGIES))
def test_against_a_dictionary(spark, held, new, strategy):
    def frame(d):
        return spark.createDataFrame([(*k, *v) for k, v in d.items()], SHAPE)

    once = upsert(frame(held), frame(new), "k,j", strategy=strategy)
    assert rows(once) == sorted(((*k, *v) for k, v in {**held, **new}.items()), key=repr)
    assert rows(upsert(once, frame(new), "k,j")) == rows(once)

    def newer(k):
        age = lambda row: -1 if row[0] is None else row[0]
        return k not in held or age(new[k]) >= age(held[k])

    guarded = {**held, **{k: v for k, v in new.items() if newer(k)}}
    assert rows(upsert(frame(held), frame(new), "k,j", guard="g", strategy=strategy)) == sorted(
        ((*k, *v) for k, v in guarded.items()), key=repr
    )


def test_keys_and_guards_are_never_filled(spark):
    target = spark.createDataFrame([(1, 1, "a")], "k int, g int, v string")
    for missing in ("k", "g"):
        with pytest.raises(ValueError, match="not found"):
            upsert(target, target.drop(missing), "k", guard="g", fill_missing=True, source_unique=True)


def test_checked_source_is_evaluated_once(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    target = spark.createDataFrame([(1, "a")], "k int, v string")
    source = spark.createDataFrame([(1, "b"), (2, "c")], "k int, v string").mapInArrow(count, "k int, v string")
    assert rows(upsert(target, source, "k")) == [(1, "b"), (2, "c")]
    assert seen.value == 2
