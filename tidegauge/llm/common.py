"""Helpers shared by the operators of this package."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession, types as T

_LOCAL: dict[str, str] = {}


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new folder under the shared folder that ``spark.checkpoint.dir`` names.

    A session on a cluster must have the setting; only a purely local session
    (tests) that lacks it gets a temporary folder, one for the process.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base is None:
        master = spark.conf.get("spark.master", "")
        if not (master == "local" or master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = _LOCAL.setdefault("base", tempfile.mkdtemp(prefix="tidegauge-llm-"))
    return f"{base.rstrip('/')}/llm/{label}-{uuid.uuid4().hex}"


def stored(df: DataFrame, label: str, compression: str = "zstd") -> DataFrame:
    """``df`` as a Parquet table in the shared folder: the lineage ends there."""
    path = scratch_path(df.sparkSession, label)
    df.write.option("compression", compression).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove(df: DataFrame) -> None:
    """Delete a table written by :func:`stored` that nothing reads any more."""
    spark = df.sparkSession
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def type_of(df: DataFrame, column: str) -> T.DataType:
    return df.schema[column].dataType


def fresh_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores before it while ``df`` has such a column."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name
