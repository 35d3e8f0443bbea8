import pytest
from pyspark.sql import functions as F

from silverline.operators import any_per_key, latest_per_key
from tests.conftest import rows

DATA = [("a", 1, 10), ("a", 2, 20), ("b", None, 30), ("b", 1, 40), (None, 5, 50), (None, 6, 60), ("c", None, 70)]


@pytest.fixture
def feed(spark):
    return spark.createDataFrame(DATA, "k string, o int, v int")


@pytest.mark.parametrize("strategy", ["window", "max_by"])
def test_latest_wins_nulls_lose_and_null_keys_form_one_group(feed, strategy):
    kept = latest_per_key(feed, "k", "o", strategy=strategy)
    assert kept.columns == feed.columns
    assert rows(kept) == sorted([("a", 2, 20), ("b", 1, 40), (None, 6, 60), ("c", None, 70)], key=repr)


@pytest.mark.parametrize("strategy", ["window", "max_by"])
def test_tiebreak_settles_equal_orders(spark, strategy):
    df = spark.createDataFrame([(1, 5, 1), (1, 5, 3), (1, 5, 2)], "k int, o int, t int").repartition(3)
    assert rows(latest_per_key(df, ["k"], "o", tiebreak="t", strategy=strategy)) == [(1, 5, 3)]


@pytest.mark.parametrize("strategy", ["window", "max_by"])
def test_nested_and_map_columns_pass_through(spark, strategy):
    df = spark.sql("select 1 as k, 1 as o, map('x', 1) as m, array(1, 2) as a, struct(1 as p) as s")
    row = latest_per_key(df, "k", "o", strategy=strategy).first()
    assert row["m"] == {"x": 1} and row["a"] == [1, 2] and row["s"]["p"] == 1


def test_without_order_any_row_is_kept(feed):
    kept = latest_per_key(feed, "k")
    assert sorted(r["k"] or "" for r in kept.collect()) == ["", "a", "b", "c"]
    assert any_per_key(feed, "k").count() == 4


def test_names_with_dots_and_clashing_helper_names(spark):
    df = spark.createDataFrame([(1, 1, 7), (1, 2, 8)], "`a.b` int, rank int, Rank_ int")
    assert rows(latest_per_key(df, ["a.b"], "rank")) == [(1, 2, 8)]


@pytest.mark.parametrize("keys", ["", ",", [], "nope"])
def test_bad_keys(feed, keys):
    with pytest.raises(ValueError):
        latest_per_key(feed, keys, "o")


def test_map_keys_are_rejected(spark):
    with pytest.raises(ValueError):
        latest_per_key(spark.sql("select map(1, 2) as k, 1 as o"), "k", "o")


def test_unknown_strategy(feed):
    with pytest.raises(ValueError):
        latest_per_key(feed, "k", "o", strategy="guess")


def test_rows_are_cut_before_the_exchange(feed, plan_of):
    window = plan_of(latest_per_key(feed, "k", "o"))
    below = window[window.index("Exchange") :]
    assert "WindowGroupLimit" in below and "Partial" in below
    grouped = plan_of(latest_per_key(feed, "k", "o", strategy="max_by"))
    assert "partial_max_by" in grouped[grouped.index("Exchange") :]
    assert window.count("Exchange") == grouped.count("Exchange") == 1


@pytest.mark.parametrize("strategy", ["window", "max_by"])
def test_hot_key_sends_one_row_per_task(spark, strategy):
    """Half of all rows share a key; each of the eight tasks shuffles one of them."""
    key = F.when(F.col("id") % 2 == 0, F.lit(0)).otherwise(F.col("id"))
    df = spark.range(0, 100_000, 1, 8).select(key.alias("k"), F.col("id").alias("o"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        kept = latest_per_key(df, "k", "o", strategy=strategy)
        assert len(kept.collect()) == 50_001
        assert kept.where("k = 0").collect() == [(0, 99_998)]
        node = kept._jdf.queryExecution().executedPlan()
        while node.nodeName() != "Exchange":
            node = node.children().apply(0)
        assert node.metrics().apply("shuffleRecordsWritten").value() == 50_000 + 8
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
