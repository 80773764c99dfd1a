"""Folders for the streams, sinks and stored tables of the registered queries.

The library itself takes folders as arguments. The registered queries have none to
take and may run in a session without ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new folder under ``spark.checkpoint.dir``; only a purely local session may lack that setting."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base is None:
        master = spark.conf.get("spark.master", "")
        if not (master == "local" or master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="tidegauge-")
    return f"{base.rstrip('/')}/tidegauge/{label}-{uuid.uuid4().hex}"


def write_and_read(df: DataFrame, label: str) -> DataFrame:
    """``df`` as a stored table."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
