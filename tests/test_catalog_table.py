"""The session catalog can create, read and widen tables. It cannot merge rows, drop
columns or travel in time; those statements are checked up to the catalog's refusal."""

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from silverline.tables import CatalogTable
from tests.conftest import rows


@pytest.fixture
def table(spark):
    like = spark.createDataFrame([(1, 2, "x")], "k int, g int, v string")
    table = CatalogTable(spark, ["spark_catalog", "default", "silver_orders"], provider="parquet")
    yield table.ensure(like, "k", partitions="g", recreate=True)
    spark.sql("DROP TABLE IF EXISTS silver_orders")


def test_created_empty_and_partitioned(spark, table):
    assert table.exists() and table.current().count() == 0
    assert [c.name for c in spark.catalog.listColumns("silver_orders") if c.isPartition] == ["g"]
    spark.sql("INSERT INTO silver_orders VALUES (1, 'x', 2)")
    assert table.ensure(table.current(), "k").current().count() == 1
    assert rows(table.preview(5).select("k", "g", "v")) == [(1, 2, "x")]


def test_column_with_awkward_name_and_comment(table):
    table.add_column("odd name", "decimal(5,1)", "it's \"new\"")
    described = {r["col_name"]: (r["data_type"], r["comment"]) for r in table.describe().collect()}
    assert described["odd name"] == ("decimal(5,1)", "it's \"new\"")


@pytest.mark.parametrize("guard", [(), "g"])
def test_merge_statement_resolves(spark, table, guard):
    source = spark.createDataFrame([(1, "y", 3)], "k int, v string, g int")
    with pytest.raises(PySparkException, match="does not support MERGE"):
        table.merge(source, "k", guard=guard)


def test_drop_statement_resolves(table):
    with pytest.raises(PySparkException, match="does not support DROP COLUMN"):
        table.drop_column("v")


def test_bad_arguments(spark, table):
    with pytest.raises(ValueError):
        table.ensure(table.current(), "nope")
    with pytest.raises(ValueError):
        table.merge(table.current().select(F.col("k")), "k")


def test_keys_guards_and_partitions_are_checked(spark, table):
    source = spark.createDataFrame([(1, "y", 3)], "k int, v string, g int")
    for missing in ("k", "g"):
        with pytest.raises(ValueError, match="not found"):
            table.merge(source.drop(missing), "k", guard="g", fill_missing=True)
    with pytest.raises(PySparkException, match="several rows for one key"):
        table.merge(source.union(source), "k")
    with pytest.raises(ValueError, match="partitioned by"):
        table.ensure(source, "k", partitions="v")
