"""Session helpers.

Library code never builds its own session; it receives one. These helpers
exist for tests, ``bench.py`` and command-line jobs, and for locating the
shared checkpoint folder the cluster names in ``spark.checkpoint.dir``.
"""
from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app: str = "feedlake", extra: dict | None = None) -> SparkSession:
    b = (SparkSession.builder.master(master).appName(app)
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
         .config("spark.sql.adaptive.skewJoin.enabled", "true")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.sql.execution.arrow.pyspark.enabled", "true")
         .config("spark.sql.legacy.javaCharsets", "true")
         # local runs only: one JVM holds driver and executors; a cluster
         # deployment sizes its own driver / executor memory
         .config("spark.driver.memory", os.environ.get("FEEDLAKE_DRIVER_MEMORY", "4g"))
         .config("spark.sql.ui.retainedExecutions", "50"))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder. The cluster names it in
    ``spark.checkpoint.dir``. A local-mode session that names none (tests, a
    laptop; driver and executors are one process there) gets a fresh folder of
    its own, registered once with its SparkContext; a cluster session that
    names none is an error, as no machine-local folder would do."""
    sc = spark.sparkContext
    d = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not d:
        if sc.master.split("[")[0] != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        d = tempfile.mkdtemp(prefix="feedlake-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(d)
    return d


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A fresh, unique folder under the shared checkpoint folder for
    materialised intermediate tables and streaming checkpoints."""
    root = ensure_checkpoint_dir(spark).rstrip("/")
    return "/".join([root, "feedlake", *parts, uuid.uuid4().hex])


def utc(spark: SparkSession) -> None:
    """Pin the session zone; every clock-free result is then zone-stable."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def bound_batches(spark: SparkSession, size: str = "4m") -> None:
    """Rows go to Python in batches of bounded bytes, whatever the length of their
    texts; a size the deployment has set stays."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(key, None) is None:
        spark.conf.set(key, size)


def once(udf):
    """A costly Python function that is evaluated where it stands: a filter on its result
    (also the one Spark infers for ``explode``) would otherwise be pushed below it, into
    a scan of few splits perhaps, and the function be evaluated there a second time."""
    return udf.asNondeterministic()
