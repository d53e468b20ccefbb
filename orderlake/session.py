"""Session helpers for tests, the bench and command-line jobs.

Library operators never build a session; they take DataFrames.  On a
cluster the caller's session decides shuffle partitions and the shared
checkpoint folder; ``ensure_checkpoint_dir`` only fills it in when unset.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def _driver_memory() -> str:
    """Driver heap for local runs: 60 % of the machine's memory, at most 8 GiB."""
    if os.environ.get("ORDERLAKE_DRIVER_MEMORY"):
        return os.environ["ORDERLAKE_DRIVER_MEMORY"]
    try:
        with open("/proc/meminfo") as f:
            kib = int(next(line for line in f if line.startswith("MemTotal")).split()[1])
        return f"{max(1024, min(8192, int(kib * 0.6 / 1024)))}m"
    except (OSError, StopIteration, ValueError):
        return "4g"


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "orderlake") -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", _driver_memory())
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared checkpoint folder named by the cluster, if any."""
    value = spark.conf.get("spark.checkpoint.dir", None)
    return value or None


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the cluster's ``spark.checkpoint.dir``; set a scratch one only in a local session without it (tests)."""
    value = checkpoint_dir(spark)
    if value is None:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        value = tempfile.mkdtemp(prefix="orderlake-ckpt-")
        spark.conf.set("spark.checkpoint.dir", value)
    spark.sparkContext.setCheckpointDir(value)
    return value
