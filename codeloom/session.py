"""Session helpers: a tuned local session for tests/bench and the shared folder.

Library code never creates a session; it takes the caller's.  The shared
folder for checkpoints and scratch tables is whatever the cluster names in
``spark.checkpoint.dir``.  Only when that is unset *and* the master is local
(tests, laptops) do we pick a private temporary folder.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

_LOCAL_DIR: dict[str, str] = {}


def build_session(master: str | None = None, shuffle_partitions: int = 8,
                  app: str = "codeloom") -> SparkSession:
    master = master or os.environ.get("CODELOOM_MASTER", "local[8]")
    return (
        SparkSession.builder.master(master).appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """Folder shared by driver and executors, from ``spark.checkpoint.dir``."""
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        master = spark.sparkContext.master
        if not re.fullmatch(r"local(\[.*\])?", master):
            raise RuntimeError(
                "spark.checkpoint.dir is unset: point it at a folder every "
                "executor can reach (HDFS, S3, ...) before running codeloom jobs")
        key = spark.sparkContext.applicationId
        if key not in _LOCAL_DIR:
            _LOCAL_DIR[key] = tempfile.mkdtemp(prefix="codeloom-ckpt-")
        d = _LOCAL_DIR[key]
    return d


def _scratch_root(spark: SparkSession) -> str:
    return f"{shared_dir(spark).rstrip('/')}/codeloom-scratch/{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never-reused path under the shared folder (for sinks/round trips)."""
    return f"{_scratch_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def cleanup(spark: SparkSession) -> bool:
    """Delete this application's scratch tables; results that still read them must be written first."""
    path = spark._jvm.org.apache.hadoop.fs.Path(_scratch_root(spark))
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
