"""Shared scratch space: materialized tables, stream checkpoints, round-trip files.

Every path lies under the folder the cluster names in ``spark.checkpoint.dir``, which all executors
see and which outlives any one of them. Only a local session, where driver and executors are one
process, gets a temporary folder of its own when the setting is missing.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTING = "spark.checkpoint.dir"


def scratch_root(spark: SparkSession) -> str:
    context = spark.sparkContext
    root = spark.conf.get(SETTING, None) or context.getCheckpointDir()
    if not root:
        if not context.master.startswith("local"):
            raise ValueError(f"set {SETTING} to a folder that all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="millrace-"))
        root = context.getCheckpointDir()
    return root.rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path nobody has used before."""
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"


def written(df: DataFrame, label: str) -> str:
    """Write ``df`` as a table in the shared folder; its path."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return path


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back.

    This cuts lineage like a checkpoint does, in one pass over the data, and a lost executor costs
    a re-read of files instead of a re-run of everything before.
    """
    return df.sparkSession.read.schema(df.schema).parquet(written(df, label))
