"""Session set-up and the shared scratch area used to cut lineage."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"
_local: dict[str, str] = {}


def build(
    app_name: str, *, master: str | None = None, conf: Mapping[str, str] | None = None
) -> SparkSession:
    """Get or create a session. Catalogs, extensions and sizes come from submit flags or `conf`;
    adaptive execution is on by default in Spark."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in (conf or {}).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the folder named by `spark.checkpoint.dir`.

    That folder is shared by all executors. A machine-local folder is used only
    when nothing is configured and Spark itself runs in local mode.
    """
    root = spark.conf.get(CHECKPOINT_DIR, None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError(f"set {CHECKPOINT_DIR} to a folder all executors can reach")
        # one folder for the whole session
        root = _local.setdefault(spark.sparkContext.applicationId, "") or tempfile.mkdtemp(prefix="silverline-")
        _local[spark.sparkContext.applicationId] = root
    return f"{root.rstrip('/')}/silverline/{label}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Evaluate `df` once into scratch Parquet and return a scan of the result.

    Written files survive lost executors, carry real sizes for join planning and
    let later passes read only the columns they need.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
