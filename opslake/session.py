"""Session settings and the shared scratch location."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.sessionWindow.merge.sessions.in.local.partition": "true",
}

#: Rows of texts in an Arrow batch.
TEXT_ROWS = 1_000


def build_session(app: str = "opslake", master: str | None = None, **extra: str) -> SparkSession:
    """Session with the settings this library expects.

    A session handed in from elsewhere works as well, as long as its time zone is UTC.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for name, value in {**SETTINGS, **extra}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession, name: str) -> str:
    """New folder below the cluster's shared checkpoint folder.

    ``spark.checkpoint.dir`` names storage that every executor sees. Only where it is unset
    (a local test session) does a temporary folder take its place.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = os.path.join(tempfile.gettempdir(), f"opslake-{os.getpid()}")
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def use_shared_checkpoints(spark: SparkSession) -> None:
    """Point ``DataFrame.checkpoint`` at the shared folder unless the session already has one."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(spark.conf.get("spark.checkpoint.dir", None) or shared_dir(spark, "ckpt"))


def use_text_batches(spark: SparkSession, rows: int = TEXT_ROWS) -> None:
    """Send at most so many rows at once to Python in this session: a batch of texts is held several times over."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= rows:
        spark.conf.set(key, str(rows))
