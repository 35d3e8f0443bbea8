"""The command-line jobs, one after the other, each in its own process."""

import os
import subprocess
import sys
from pathlib import Path

import pytest
from pyspark.sql import Observation

from silverline import plans
from silverline.tables import SnapshotTable

ROOT = Path(__file__).resolve().parents[1]


def run(tmp_path, job, *args):
    code = f"import sys; from silverline.jobs.{job} import main; main(sys.argv[1:])"
    env = {**os.environ, "PYTHONPATH": str(ROOT), "PYSPARK_SUBMIT_ARGS": "--master local[4] "
           "--conf spark.ui.enabled=false --conf spark.sql.shuffle.partitions=4 --conf spark.sql.session.timeZone=UTC pyspark-shell"}
    return subprocess.run(
        [sys.executable, "-c", code, *args], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300
    )


def test_feed_consolidate_reconcile_evolve_inspect(tmp_path):
    bronze, silver = f"{tmp_path}/bronze", f"{tmp_path}/silver"
    made = run(
        tmp_path, "make_feed", "--entity", "customer=/root/testdata/sf0.001/customer.parquet:c_custkey",
        "--output-root", bronze, "--schema", "s", "--start-date", "2026-01-01", "--end-date", "2026-01-04",
        "--key-space", "50",
    )
    assert made.returncode == 0, made.stderr
    table = ["--database", "d", "--table", "customer", "--warehouse", silver]
    feed = ["--bronze-uri", f"{bronze}/s/customer", "--pk", "id_customer", "--dedup-col", "dat_kafka",
            "--partition-col", "dt_ref"]

    merged = run(tmp_path, "consolidate", *table, *feed, "--partition-range", "2026-01-01,2026-01-03", "--count-input")
    assert merged.returncode == 0, merged.stderr
    assert "rows read: 450" in merged.stdout

    good = run(tmp_path, "reconcile", *table, *feed, "--partition-range", "2026-01-01,2026-01-03")
    assert good.returncode == 0, good.stderr
    assert "rows read: 450" in good.stdout
    stale = run(tmp_path, "reconcile", *table, *feed, "--partition-values", "2026-01-04")
    assert stale.returncode != 0 and "column_values" in stale.stderr

    added = run(tmp_path, "evolve", "add", *table, "--column-name", "note", "--column-type", "string")
    assert added.returncode == 0 and "note" in added.stdout
    seen = run(tmp_path, "inspect_table", *table, "--limit", "3")
    assert seen.returncode == 0 and "note" in seen.stdout
    dropped = run(tmp_path, "evolve", "drop", *table, "--column-name", "note")
    assert dropped.returncode == 0 and "note" not in dropped.stdout


@pytest.mark.parametrize("extra", [[], ["--partition-values", "a", "--partition-range", "a,b"]])
def test_one_choice_of_partitions_is_required(extra):
    from silverline.jobs.consolidate import main

    with pytest.raises(SystemExit):
        main(["--database", "d", "--table", "t", "--bronze-uri", "x", "--partition-col", "p", "--pk", "k", *extra])


@pytest.mark.parametrize("day, expected", [("2026-01-01", 3), ("2026-01-09", 0)])
def test_rows_read_are_counted_on_the_way(spark, tmp_path, day, expected):
    data = [(1, 1, "2026-01-01"), (1, 2, "2026-01-01"), (2, 1, "2026-01-01"), (3, 1, "2026-01-02")]
    rows = spark.createDataFrame(data, "k int, o int, dt string")
    rows.write.partitionBy("dt").parquet(f"{tmp_path}/feed")
    feed = plans.Feed(f"{tmp_path}/feed", "dt", [day])
    silver, merged, checked = SnapshotTable(spark, f"{tmp_path}/silver"), Observation(), Observation()
    plans.consolidate(spark, feed, silver, "k", "o", rows_read=merged)
    plans.reconcile(spark, feed, silver.current(), "k", "o", rows_read=checked)
    assert (plans.rows_of(merged), plans.rows_of(checked)) == (expected, expected)
