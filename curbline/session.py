"""Session settings and the shared folder that intermediate tables live in."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

from curbline.sources import storage

CHECKPOINT_KEY = "spark.checkpoint.dir"


def local_session(cores: int | str = 8, app: str = "curbline", **conf: str) -> SparkSession:
    """A single-JVM session for tests and the benchmark; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
    )
    if CHECKPOINT_KEY not in conf:
        builder = builder.config(CHECKPOINT_KEY, tempfile.mkdtemp(prefix="curbline-"))
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Every executor must reach it, so a machine-local folder is only made up when the
    whole application runs in one process.
    """
    configured = spark.conf.get(CHECKPOINT_KEY, None)
    if configured:
        return configured.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_KEY} to a folder that all executors share")
    return os.path.join(tempfile.gettempdir(), f"curbline-{os.getuid()}-{os.getpid()}")


def new_work_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh, unused path below the shared folder, with its scheme: Spark and the tasks that
    open files themselves then mean the same store."""
    return storage.qualified(spark, f"{shared_dir(spark)}/curbline/{purpose}-{uuid.uuid4().hex[:12]}")
