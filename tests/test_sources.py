from datetime import date, datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from silverline.sinks import partitioned, write_partitioned
from silverline.sources import day_range, partition_filter, read_partitioned, resolve_partitions
from tests.conftest import rows


def test_day_range_includes_both_ends():
    assert day_range("2024-02-27", "2024-03-01") == ["2024-02-27", "2024-02-28", "2024-02-29", "2024-03-01"]
    assert day_range("20240101", "20240101", "%Y%m%d") == ["20240101"]
    assert day_range(date(2024, 1, 1), datetime(2024, 1, 2, 5)) == ["2024-01-01", "2024-01-02"]


def test_day_range_names_a_coarse_partition_once():
    assert day_range("2024-01", "2024-03", "%Y-%m") == ["2024-01", "2024-02"] + ["2024-03"]


def test_day_range_rejects_reversed_bounds():
    with pytest.raises(ValueError):
        day_range("2024-01-02", "2024-01-01")


@pytest.mark.parametrize(
    "kwargs",
    [{}, {"values": "a", "between": "2024-01-01,2024-01-02"}, {"values": ","}, {"values": []},
     {"between": "2024-01-01"}, {"between": "2024-01-01,2024-01-02,2024-01-03"}],
)
def test_resolve_partitions_needs_exactly_one_usable_choice(kwargs):
    with pytest.raises(ValueError):
        resolve_partitions(**kwargs)


def test_resolve_partitions_cleans_lists():
    assert resolve_partitions(values=" a, ,b,") == ["a", "b"]


@pytest.fixture(scope="module")
def feed(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("feed") / "f")
    days = F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 10).cast("int"))
    return write_partitioned(spark.range(100).withColumn("dt_ref", days), path, ["dt_ref"])


def test_partition_filter_prunes_directories(spark, feed, plan_of):
    listed = read_partitioned(spark, feed, "dt_ref", ["2024-01-02", "2024-01-07"])
    scan = next(line for line in plan_of(listed).splitlines() if "FileScan" in line)
    assert "PartitionFilters: [dt_ref" in scan and "DataFilters: []" in scan
    assert listed.count() == 20


def test_unbroken_range_is_one_between(spark, feed, plan_of):
    df = read_partitioned(spark, feed, "dt_ref", day_range("2024-01-02", "2024-01-05"))
    assert df.count() == 40
    assert " IN " not in plan_of(df)


def test_missing_partitions_read_nothing(spark, feed):
    assert read_partitioned(spark, feed, "dt_ref", ["2030-01-01"]).count() == 0


def test_none_reads_everything_and_empty_list_is_an_error(spark, feed):
    assert read_partitioned(spark, feed, "dt_ref").count() == 100
    with pytest.raises(ValueError):
        read_partitioned(spark, feed, "dt_ref", [])


def test_unknown_partition_column(spark, feed):
    with pytest.raises(ValueError):
        read_partitioned(spark, feed, "nope", ["2024-01-01"])


def test_malformed_day_is_rejected_on_the_driver(spark, feed):
    with pytest.raises(ValueError):
        read_partitioned(spark, feed, "dt_ref", ["not a day"])


def test_selected_directories_only(spark, feed):
    df = read_partitioned(spark, feed, "dt_ref", ["2024-01-02", "2024-01-03"], list_selected_only=True)
    assert df.count() == 20
    assert df.schema["dt_ref"].dataType == T.DateType()
    assert all("dt_ref=2024-01-0" in f for f in df.inputFiles())


@pytest.mark.parametrize(
    "dtype, values, fmt, kept",
    [
        ("date", ["03/01/2024"], "%d/%m/%Y", 1),
        ("int", ["7"], "%Y", 1),
        ("string", ["it's", "b"], "%Y", 2),
        ("timestamp", ["2024-01-03"], "%Y-%m-%d", 1),
        ("timestamp_ntz", ["2024-01-03"], "%Y-%m-%d", 1),
        ("double", ["1.5"], "%Y", 1),
    ],
)
def test_filter_literals_take_the_column_type(spark, dtype, values, fmt, kept):
    data = {
        "date": ["2024-01-03", "2024-01-04"], "int": ["7", "8"], "string": ["it's", "b"],
        "timestamp": ["2024-01-03", "2024-01-04"], "timestamp_ntz": ["2024-01-03", "2024-01-04"],
        "double": ["1.5", "2"],
    }[dtype]
    df = spark.createDataFrame([(d,) for d in data], "p string").select(F.col("p").cast(dtype))
    assert df.where(partition_filter(df.schema["p"], values, fmt)).count() == kept


def test_overwrite_replaces_all_or_only_touched_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    start = spark.createDataFrame([(1, "a"), (2, "b")], "v int, p string")
    write_partitioned(start, path, ["p"])
    write_partitioned(spark.createDataFrame([(9, "b")], "v int, p string"), path, ["p"], touched_only=True)
    assert rows(spark.read.parquet(path)) == [(1, "a"), (9, "b")]
    write_partitioned(spark.createDataFrame([(5, "c")], "v int, p string"), path, ["p"], rebalance=False)
    assert rows(spark.read.parquet(path)) == [(5, "c")]


def test_tasks_of_a_rebalanced_write_hold_little(spark, tmp_path, monkeypatch):
    """A value is split where several tasks have read it, and the session's own size is back afterwards."""
    monkeypatch.setattr(partitioned, "TASK_BYTES", 20_000)
    before, advised = spark.conf.get(partitioned.ADVISED), []
    assert partitioned._as_bytes(before) == 64 << 20 and partitioned._as_bytes("8m") == 8 << 20 and partitioned._as_bytes("2KB") == 2048
    rows_ = spark.range(40_000).selectExpr("id", "sha(string(id)) as v", "int(id % 7) as p", "raise_error('lost') as e")
    many = rows_.drop("e")
    write_partitioned(many.withColumn("p", F.lit(1)), str(tmp_path / "one"), ["p"])
    found = read_partitioned(spark, str(tmp_path / "one"), "p", None)
    assert found.count() == 40_000 and len(found.inputFiles()) >= 4
    with partitioned._small_tasks(spark):
        advised.append(spark.conf.get(partitioned.ADVISED))
        write_partitioned(many, str(tmp_path / "many"), ["p"])
        advised.append(spark.conf.get(partitioned.ADVISED))
        monkeypatch.setattr(partitioned, "TASK_BYTES", 1 << 40)
    assert advised == ["20000", "20000"] and spark.conf.get(partitioned.ADVISED) == before
    with pytest.raises(Exception, match="lost"):
        write_partitioned(rows_.withColumn("e", F.expr("string(e)")), str(tmp_path / "lost"), ["p"])
    assert spark.conf.get(partitioned.ADVISED) == before and not partitioned._open


def test_csv_without_inference_is_text(spark, tmp_path):
    path = str(tmp_path / "c")
    write_partitioned(spark.createDataFrame([(1, 2.5, "x")], "a int, b double, p string"), path, ["p"], fmt="csv")
    plain = read_partitioned(spark, path, "p", ["x"], fmt="csv")
    assert plain.columns == ["_c0", "_c1", "p"]
    assert plain.schema["_c0"].dataType == T.StringType()
    inferred = read_partitioned(spark, path, "p", ["x"], fmt="csv", infer_schema=True)
    assert inferred.schema["_c0"].dataType == T.IntegerType()
    given = read_partitioned(spark, path, "p", ["x"], fmt="csv", schema="a long, b double, p string")
    assert rows(given) == [(1, 2.5, "x")]


def test_partitions_without_their_column_are_refused(spark, feed):
    with pytest.raises(ValueError, match="column"):
        read_partitioned(spark, feed, None, ["2024-01-02"])


@pytest.mark.parametrize("days", [["2030-01-01"], ["2030-01-01", "2024-01-02"]])
def test_selected_directories_agree_with_the_filter(spark, feed, days):
    plain = read_partitioned(spark, feed, "dt_ref", days)
    selected = read_partitioned(spark, feed, "dt_ref", days, list_selected_only=True)
    assert rows(selected) == rows(plain)
