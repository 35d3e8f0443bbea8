"""Time alternative plans for the same result; prints one line per alternative.

    python benchmarks/strategies.py /root/testdata/sf0.1 [runs]
"""

from __future__ import annotations

import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import DataFrame  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from registry.base import events, events_latest, table  # noqa: E402
from registry.dedup import LINE_KEY, LINE_TIES  # noqa: E402
from silverline import session  # noqa: E402
from silverline.operators import (  # noqa: E402
    column_diffs,
    counts,
    key_coverage,
    latest_per_key,
    report,
    upsert,
)


def drain(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def alternatives(spark, sf_dir: str):
    lines, feed = table(spark, sf_dir, "lineitem"), events(spark, sf_dir)
    for strategy in ("window", "max_by"):
        yield f"latest per key, lineitem, few rows per key: {strategy}", lambda s=strategy: drain(
            latest_per_key(lines, LINE_KEY, "l_shipdate", tiebreak=LINE_TIES, strategy=s)
        )
        yield f"latest per key, lineitem by supplier, many rows per key: {strategy}", lambda s=strategy: drain(
            latest_per_key(lines, "l_suppkey", "l_shipdate", tiebreak=[*LINE_KEY, *LINE_TIES], strategy=s)
        )
        yield f"latest per key, events: {strategy}", lambda s=strategy: drain(
            latest_per_key(feed, "user_id", "ts", tiebreak="event_id", strategy=s)
        )

    target = session.materialise(table(spark, sf_dir, "orders"), "target")
    changed = target.where("o_orderdate >= timestamp_ntz '1999-01-01 00:00:00'")
    source = session.materialise(changed.withColumn("o_totalprice", -F.col("o_totalprice")), "source")
    for strategy in ("full_outer", "anti_join"):
        yield f"upsert, orders, unique source: {strategy}", lambda s=strategy: drain(
            upsert(target, source, "o_orderkey", source_unique=True, strategy=s)
        )
        yield f"upsert, orders, checked source: {strategy}", lambda s=strategy: drain(
            upsert(target, source, "o_orderkey", strategy=s)
        )

    silver = session.materialise(upsert(target, source, "o_orderkey", source_unique=True), "silver")
    columns = [c for c in target.columns if c != "o_orderkey"]

    def three_steps():
        counts(target, silver).collect()
        key_coverage(target, silver, "o_orderkey").collect()
        column_diffs(target, silver, "o_orderkey", columns).collect()

    yield "reconcile, orders: three separate checks", three_steps
    for unique in (False, True):
        kind = "one full outer join (unique keys)" if unique else "key grouping and inner join"
        yield f"reconcile, orders: report by {kind}", lambda u=unique: report(
            target, silver, "o_orderkey", columns, silver_unique=u
        ).collect()


def main(sf_dir: str, runs: int) -> None:
    spark = session.build(
        "strategies",
        master="local[8]",
        conf={
            "spark.sql.shuffle.partitions": "8",
            "spark.sql.session.timeZone": "UTC",
            "spark.driver.memory": "8g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            # compare the shuffled plans that large inputs get
            "spark.sql.autoBroadcastJoinThreshold": "-1",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    drain(events_latest(spark, sf_dir))
    for name, action in alternatives(spark, sf_dir):
        action()
        times = []
        for _ in range(runs):
            start = time.perf_counter()
            action()
            times.append(time.perf_counter() - start)
        print(f"{statistics.median(times):7.3f}  {name}", flush=True)
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1], int(sys.argv[2]) if len(sys.argv) > 2 else 5)
