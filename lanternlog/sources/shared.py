"""Folders where driver and executors meet."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def folder(spark: SparkSession, name: str) -> str:
    """A new folder in the one that ``spark.checkpoint.dir`` names; only local mode may do without (tests)."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        root = "file://" + tempfile.mkdtemp(prefix="lanternlog-")
        spark.sparkContext.setCheckpointDir(root)
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, path: str) -> DataFrame:
    """``df`` written to ``path`` and read from there: what follows reads one result, whatever is lost or run again."""
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
