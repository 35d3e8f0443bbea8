"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR, BENCH_CPUS and BENCH_RUNS choose data, cores and repetitions.
"""

from __future__ import annotations

import json
import os
import statistics
import tempfile
import time

import registry
from silverline import session

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))

HEADLINE = [
    "dedup_latest",
    "dedup_latest_max_by",
    "dedup_composite_key",
    "dedup_composite_key_max_by",
    "dedup_ties",
    "dedup_any_keys",
    "upsert_forward",
    "upsert_guarded",
    "upsert_composite_key",
    "upsert_counts",
    "reconcile_counts",
    "reconcile_missing_keys",
    "reconcile_column_diffs",
    "reconcile_report",
    "feed_records",
    "feed_daily_versions",
    "feed_entities",
    "read_partition_range",
    "read_json",
    "snapshot_current",
    "snapshot_partitioned",
    "schema_drop_readd_merge",
    "consolidate_ranges",
    "consolidate_composite_key",
    "reconcile_fresh_table",
    "reconcile_stale_table",
    "stream_consolidate",
]


def run(spark, name: str) -> float:
    start = time.perf_counter()
    registry.QUERIES[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    spark = session.build(
        "bench",
        master=f"local[{CPUS}]",
        conf={
            "spark.sql.shuffle.partitions": CPUS,
            "spark.sql.session.timeZone": "UTC",
            "spark.driver.memory": "8g",
            "spark.checkpoint.dir": tempfile.mkdtemp(prefix="bench-"),
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    run(spark, "dedup_latest")  # starts the JVM's code paths
    times = {name: statistics.median(run(spark, name) for _ in range(RUNS)) for name in HEADLINE}
    print(
        json.dumps(
            {
                "metric": f"total of median seconds over {len(times)} queries, {RUNS} runs each",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": {name: round(t, 3) for name, t in times.items()},
                "sf": SF_DIR.rsplit("sf", 1)[-1].strip("/"),
                "cpus": int(CPUS),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
