"""Session settings and the scratch area shared by all executors."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every job relies on. Sizes (shuffle partitions, memory) stay with the cluster.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # A hot join key is split even where the split costs one more shuffle.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Beyond this many rows ORDER BY .. LIMIT is a distributed sort, not a driver heap.
    "spark.sql.execution.topKSortFallbackThreshold": "100000",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Re-written sources replace their own partition directories only.
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def configure(builder: SparkSession.Builder) -> SparkSession.Builder:
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    return builder


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A new, unused folder under the shared folder named by ``spark.checkpoint.dir``.

    Only a local session without that setting gets a machine-local folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="sensorlake-")
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def pin(df: DataFrame) -> DataFrame:
    """Compute a small result once and keep it, so that every later use sees the same rows."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(scratch_dir(spark, "checkpoints"))
    return df.checkpoint()
