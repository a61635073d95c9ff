"""Session helpers.

Library functions never build or reconfigure a session; they take the
caller's ``SparkSession``.  ``build_session`` is for tests, the bench and
local runs; on a cluster the job's own configuration wins.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings the pipeline relies on for correct results (UTC calendar days,
# ANSI arithmetic) and for good plans (AQE re-planning, skew splitting).
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def build_session(master: str | None = None, app: str = "barlake",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    """Session for tests and local runs (UI off, UTC, AQE on)."""
    cpus = os.environ.get("BENCH_CPUS", "8")
    builder = (SparkSession.builder
               .master(master or f"local[{cpus}]")
               .appName(app)
               .config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false")
               .config("spark.driver.memory", "8g")
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions or 8)))
    for k, v in {**REQUIRED_CONF, **(extra or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for lineage cuts, stream checkpoints and staged tables.

    Taken from the cluster's ``spark.checkpoint.dir``.  Only when that is unset
    on a local master (as in some tests) is a private folder created; on a
    cluster an unset setting is an error, never a machine-local folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = sc.getConf().get("spark.checkpoint.dir", None)
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder on shared storage (HDFS / object store): "
                         "staged tables, stream checkpoints and carry state are written there")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="barlake-ckpt-"))     # local runs only
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared checkpoint root."""
    return f"{checkpoint_root(spark).rstrip('/')}/barlake/{name}-{uuid.uuid4().hex[:12]}"
