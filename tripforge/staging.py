"""Intermediate tables in the folder all executors share.

A staged table cuts lineage: a lost executor re-reads files instead of
recomputing the whole job, and every later reader sees the same rows.
"""

from __future__ import annotations

import tempfile
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A broadcast table is held by the driver and by every executor.
BROADCAST_MAX_BYTES = 64 * 1024 * 1024
_FIXED_ROW_BYTES = 16


def shared_folder(spark: SparkSession) -> str:
    """The cluster's checkpoint folder; a local session without one gets its own."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors can reach")
    folder = tempfile.mkdtemp(prefix="tripforge-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def staging_path(spark: SparkSession, name: str) -> str:
    """Fresh path below the shared folder, grouped by application for later cleaning."""
    return f"{shared_folder(spark)}/staged-{spark.sparkContext.applicationId}/{name}-{uuid4().hex}"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and return the written table."""
    spark = df.sparkSession
    path = staging_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def byte_size(df: DataFrame) -> int:
    """Upper estimate of the in-memory bytes of ``df``, by one partial aggregate.

    On a staged table without strings only the file footers are read.
    """
    texts = [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]
    text_bytes = sum((F.coalesce(F.octet_length(c), F.lit(0)) for c in texts), F.lit(0))
    row = df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.coalesce(F.sum(text_bytes.cast("long")), F.lit(0)).alias("text"),
    ).first()
    return row["rows"] * _FIXED_ROW_BYTES * len(df.columns) + row["text"]


def broadcast_if_small(df: DataFrame, max_bytes: int = BROADCAST_MAX_BYTES) -> DataFrame:
    """Broadcast hint when the measured size allows it; otherwise ``df`` joins by shuffle."""
    return F.broadcast(df) if byte_size(df) <= max_bytes else df
