"""Every registered query against its SQL on the same tables."""

import os

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as driver
import registry
from tests.oracle import duck_tables, spark_rows, sql_rows

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
QUERIES, SQL = registry.QUERIES, registry.SQL


@pytest.fixture(scope="module")
def duck():
    return duck_tables(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)
    assert QUERIES.items() <= driver.queries().items()
    assert SQL.items() <= driver.oracle_sql().items()


@pytest.mark.parametrize("name", QUERIES)
def test_query_matches_sql(spark, duck, name):
    names, found = spark_rows(QUERIES[name](spark, SF_DIR))
    expected_names, expected = sql_rows(duck, SQL[name])
    assert names == expected_names
    assert found == expected


def test_entry(spark):
    assert driver.entry(spark).count() > 0


@pytest.mark.parametrize(
    "name, source, column, months", [("consolidate_ranges", "events", "ts", 2), ("consolidate_composite_key", "lineitem", "l_shipdate", 120)]
)
def test_ranges_follow_the_data(spark, tmp_path, name, source, column, months):
    """Rows long before and after the usual days are consolidated as well."""
    rows = spark.read.parquet(f"{SF_DIR}/{source}.parquet")
    kind = rows.schema[column].dataType.simpleString()
    shift = f"case pmod(xxhash64({column}), 3) when 0 then {months} when 1 then -{months} else 0 end"
    moved = rows.withColumn(column, F.expr(f"cast({column} + make_interval(0, {shift}) as {kind})"))
    moved.write.parquet(f"{tmp_path}/{source}.parquet")
    duck = duckdb.connect()
    duck.execute("set timezone='UTC'")
    duck.execute(f"create view {source} as select * from '{tmp_path}/{source}.parquet/*.parquet'")
    names, found = spark_rows(QUERIES[name](spark, str(tmp_path)))
    assert (names, found) == sql_rows(duck, SQL[name])
