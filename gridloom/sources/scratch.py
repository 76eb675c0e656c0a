"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in ``spark.checkpoint.dir``; only a local master may leave that unset."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not re.fullmatch(r"local(\[.*\])?", spark.conf.get("spark.master", None) or ""):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = "file:///tmp/checkpoints"
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """``df`` written and read back: its lineage ends at the files, and Spark knows their size."""
    path = path or scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
