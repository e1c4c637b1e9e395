"""Spark session helpers.

Library code never creates its own session: every public function receives a
DataFrame or a SparkSession.  ``local_session`` is only for tests, the bench
and examples.
"""
from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every plan in this package assumes.  AQE re-plans joins at runtime:
# it turns a sort-merge join into a broadcast join only when the measured side
# is below ``spark.sql.adaptive.autoBroadcastJoinThreshold`` and splits skewed
# shuffle partitions.
CORE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "tidewatch") -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("TIDEWATCH_DRIVER_MEM", "16g"))
    )
    for k, v in CORE_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the folder must be set and lie on shared storage; without it
    this fails.  Only a ``local[...]`` session (tests, bench) gets a folder of
    its own when none is set.
    """
    current = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not current:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        current = tempfile.mkdtemp(prefix="tidewatch-ckpt-")
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(current)
    return current


def shared_path(spark: SparkSession, *parts: str) -> str:
    """A path under the shared folder, of whatever file system it is on."""
    return "/".join([ensure_checkpoint_dir(spark).rstrip("/"), "tidewatch", *parts])
