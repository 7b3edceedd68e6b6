"""Session settings the operators read: checkpoint folder and hot-group size."""
from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession

HOT_ROWS_KEY = "spark.touchline.hotGroupRows"
HOT_ROWS_DEFAULT = 1_000_000


def hot_group_rows(spark: SparkSession) -> int:
    """Groups above this many rows are split over several tasks."""
    return int(spark.conf.get(HOT_ROWS_KEY, str(HOT_ROWS_DEFAULT)))


def checkpoint_dir(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder; a temporary one only in local mode."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    context = spark.sparkContext
    if configured:
        if context.getCheckpointDir() is None:
            context.setCheckpointDir(configured)
        return configured
    existing = context.getCheckpointDir()
    if existing:
        return existing
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder on a cluster")
    folder = tempfile.mkdtemp(prefix="touchline-checkpoint-")
    context.setCheckpointDir(folder)
    return folder


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint, so a lost executor restarts from shared storage."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder below the shared checkpoint folder for a written table."""
    import uuid

    return f"{checkpoint_dir(spark)}/{label}-{uuid.uuid4().hex}"
