from pyspark.sql import functions as F

from silverline.sinks import write_partitioned
from silverline.streaming import consolidate_stream
from silverline.tables import SnapshotTable
from tests.conftest import rows


def test_late_files_do_not_undo_newer_rows(spark, tmp_path, base):
    feed, checkpoint = str(tmp_path / "feed"), str(tmp_path / "checkpoint")
    table = SnapshotTable(spark, base)
    schema = "k long, o int, dt string"

    def arrive(day, order):
        rows = spark.range(20).select(F.col("id").alias("k"), F.lit(order).alias("o"), F.lit(day).alias("dt"))
        write_partitioned(rows, feed, ["dt"], mode="append")
        consolidate_stream(spark, feed, schema, table, "k", "o", checkpoint).awaitTermination()

    arrive("d2", 2)
    arrive("d1", 1)
    assert rows(table.current()) == sorted(((k, 2, "d2") for k in range(20)), key=repr)
    arrive("d3", 3)
    assert table.current().where("o = 3").count() == 20
    assert table.snapshots().count() == 4
