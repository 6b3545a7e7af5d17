"""Session set-up and the shared folder for written intermediates."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

# Adaptive execution does the run-time half of the skew work: it splits hot
# join partitions and hot rebalanced write partitions.
CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # Keeps the keys of the stream dedup on disk instead of in the heap.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    # The first N of a group are cut before the shuffle for any N.
    "spark.sql.optimizer.windowGroupLimitThreshold": "2147483647",
    "spark.ui.enabled": "false",
}


def build_session(app: str = "discolake", **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    for key, value in {**CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_root(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by the cluster."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    # Everything runs in one process: only then is a folder of this machine shared.
    if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
    root = tempfile.mkdtemp(prefix="discolake-")
    atexit.register(shutil.rmtree, root, ignore_errors=True)
    spark.conf.set("spark.checkpoint.dir", root)
    return root


def new_folder(spark: SparkSession, name: str) -> str:
    """A folder of its own for one run, below the shared root."""
    return f"{shared_root(spark)}/{name}-{uuid.uuid4().hex}"
