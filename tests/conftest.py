import pytest

from silverline import session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    home = tmp_path_factory.mktemp("spark")
    spark = session.build(
        "silverline-tests",
        master="local[8]",
        conf={
            "spark.sql.shuffle.partitions": "8",
            "spark.sql.session.timeZone": "UTC",
            "spark.sql.warehouse.dir": str(home / "warehouse"),
            "spark.checkpoint.dir": str(home / "checkpoints"),
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "4g",
        },
    )
    spark.sparkContext.setLogLevel("OFF")
    yield spark
    spark.stop()


@pytest.fixture
def base(tmp_path):
    return str(tmp_path / "table")


@pytest.fixture
def plan_of(spark):
    """Physical plan text of a DataFrame."""
    return lambda df: df._jdf.queryExecution().executedPlan().toString()


def rows(df):
    """Rows as a sorted list of tuples, for comparing whole results."""
    return sorted((tuple(r) for r in df.collect()), key=repr)
