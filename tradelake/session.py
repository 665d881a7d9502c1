"""Session settings and the working folders of a run."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

# Adaptive execution splits skewed partitions and merges small ones; the file
# sinks below rely on it through the REBALANCE hint, in batch and in streams.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.adaptive.streaming.stateless.enabled": "true",
}


def build_session(app: str = "tradelake", master: str | None = None, **extra: str) -> SparkSession:
    """A session with the settings the library expects."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return prepare(builder.getOrCreate())


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the library's settings to a session somebody else built."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    # A listing job starts one task per folder up to this number; hourly zones
    # have thousands of folders, so a few waves of tasks are enough.
    listing = max(32, 4 * spark.sparkContext.defaultParallelism)
    spark.conf.set("spark.sql.sources.parallelPartitionDiscovery.parallelism", str(listing))
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, as named by ``spark.checkpoint.dir``.

    A local session without that setting gets a fresh folder under the system's
    temporary one. A cluster session without it is refused, because a
    machine-local folder would be lost with its executor.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None)
    current = context.getCheckpointDir()
    if named or current:
        if not current:
            context.setCheckpointDir(named)
        return named or current
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="tradelake-"))
    return context.getCheckpointDir()


def run_dir(spark: SparkSession, label: str) -> str:
    """A folder name under the shared folder that no other run uses."""
    return f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, for runs that did not use --py-files."""
    context = spark.sparkContext
    if getattr(context, "_tradelake_shipped", False):
        return
    here = os.path.dirname(os.path.abspath(__file__))
    if os.path.isdir(here):  # already inside an archive otherwise
        bundle = os.path.join(tempfile.mkdtemp(prefix="tradelake-py-"), "tradelake")
        context.addPyFile(shutil.make_archive(bundle, "zip", os.path.dirname(here), "tradelake"))
    context._tradelake_shipped = True
