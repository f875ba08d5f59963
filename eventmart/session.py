"""Session construction and shared scratch locations.

On a cluster the session is built by the platform; ``scratch_root`` then reads
``spark.checkpoint.dir`` (a shared, fault-tolerant folder) from the running
session.  Only when that setting is absent (local runs, tests) does it create a
private folder and register it as the checkpoint directory.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings that shape every plan in this package.  Shuffle partitions are a
# starting point; AQE coalesces small partitions and splits skewed ones at run time.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.showConsoleProgress": "false",
    # Column names of the raw tables contain dots and mixed case; keep the
    # case-insensitive resolution the by-name loader relies on.
    "spark.sql.caseSensitive": "false",
}


def build_session(
    master: str | None = None,
    app_name: str = "eventmart",
    shuffle_partitions: int | None = None,
    conf: dict | None = None,
) -> SparkSession:
    """Create (or fetch) a session with the package defaults applied."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = dict(DEFAULT_CONF)
    if shuffle_partitions is not None:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    return spark


#: Whether a query's shuffle files go when it ends, not when the driver's JVM next collects garbage.
FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Within it, each query's shuffle files are removed as soon as the query ends: a flow of
    many jobs holds those of the jobs that run, not of all before them."""
    before = spark.conf.get(FREE_SHUFFLES, None)
    spark.conf.set(FREE_SHUFFLES, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(FREE_SHUFFLES)
        else:
            spark.conf.set(FREE_SHUFFLES, before)


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder of the session.

    A private folder is created only for a local session without one (tests,
    laptops); a cluster session must name shared storage in
    ``spark.checkpoint.dir`` — a machine-local folder would not survive the
    loss of that machine.
    """
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder for this cluster")
        configured = tempfile.mkdtemp(prefix="eventmart-ckpt-")
    spark.sparkContext.setCheckpointDir(configured)
    return spark.sparkContext.getCheckpointDir() or configured


def scratch_root(spark: SparkSession) -> str:
    """Root for intermediate tables written by this package (next to checkpoints)."""
    base = spark.conf.get("spark.checkpoint.dir", None) or checkpoint_dir(spark)
    return base.rstrip("/") + "/eventmart-scratch"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder below ``scratch_root`` for one run of one job."""
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def local_path(path: str) -> str:
    """Strip a ``file:`` scheme for Python-side file access (tests only)."""
    return path[len("file:"):] if path.startswith("file:") else path


def ensure_dir(path: str) -> str:
    os.makedirs(local_path(path), exist_ok=True)
    return path
