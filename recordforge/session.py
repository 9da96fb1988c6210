"""Session construction and the shared scratch location.

On a cluster the operator reads ``spark.checkpoint.dir`` (a shared, reliable
folder named by the cluster). Where it is unset, a local master gets a folder of
its own, which is removed when the driver ends; any other master raises, since
executors would not see the driver's folders.
"""

from __future__ import annotations

import atexit
import os
import re
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

_LOCAL_DEFAULTS = {
    "spark.sql.shuffle.partitions": "8",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # broadcast only what AQE has measured after a shuffle, never on estimates
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32m",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.driver.memory": "8g",
}


def build_session(master: str | None = None, app: str = "recordforge", **conf) -> SparkSession:
    """Session for local runs and tests. Cluster jobs pass their own session."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for k, v in {**_LOCAL_DEFAULTS, **conf}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def is_local(master: str) -> bool:
    """Whether driver and executors are one process (local-cluster is not)."""
    return re.fullmatch(r"local(\[[^\]]*\])?", master) is not None


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder; set a local one only when none is named."""
    try:
        sc = spark.sparkContext
    except Exception:  # e.g. Spark Connect: the server owns the checkpoint folder
        return spark.conf.get("spark.checkpoint.dir", None)
    current = sc.getCheckpointDir()
    if current:
        return current
    named = sc.getConf().get("spark.checkpoint.dir", None)
    if not named:
        if not is_local(sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        named = tempfile.mkdtemp(prefix="recordforge-ckpt-")
        atexit.register(shutil.rmtree, named, ignore_errors=True)
    sc.setCheckpointDir(named)
    return sc.getCheckpointDir() or named


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint folder for written tables."""
    base = checkpoint_dir(spark)
    if not base:
        raise RuntimeError("no checkpoint folder: set spark.checkpoint.dir")
    return os.path.join(base, "tables", f"{name}-{uuid.uuid4().hex}")
