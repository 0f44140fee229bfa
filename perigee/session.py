"""Session builder and the shared working folder used for checkpoints and written tables."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_CHECKPOINT_CONF = "spark.checkpoint.dir"


def build_session(app_name: str = "perigee", master: str | None = None, **conf: str) -> SparkSession:
    """Session with adaptive execution on. On a cluster the master comes from spark-submit."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    defaults = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    }
    for key, value in {**defaults, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_root(spark: SparkSession) -> str:
    """Folder every executor can reach: spark.checkpoint.dir where the cluster names one.

    Only a local master may fall back to a fresh temporary folder.
    """
    context = spark.sparkContext
    root = spark.conf.get(_CHECKPOINT_CONF, None) or context.getCheckpointDir()
    if root:
        if context.getCheckpointDir() is None:
            context.setCheckpointDir(root)
        return root
    if not context.master.startswith("local"):
        raise RuntimeError(f"set {_CHECKPOINT_CONF} to a folder shared by all executors")
    root = tempfile.mkdtemp(prefix="perigee-", dir=os.environ.get("PERIGEE_TMP"))
    context.setCheckpointDir(root)
    return root


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path under the shared folder that no earlier run has used."""
    return f"{shared_root(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stable(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: later stages read the saved rows, also after executors are lost."""
    shared_root(df.sparkSession)
    return df.checkpoint(eager=True)
