"""Session checks, and small files on any file system that Spark reads."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Session time zones that mean UTC.
_UTC_NAMES = {"UTC", "ETC/UTC", "GMT", "Z", "+00:00"}


def require_utc(spark: SparkSession) -> None:
    """Day and hour boundaries are UTC ones; refuse a session that differs."""
    zone = spark.conf.get("spark.sql.session.timeZone")
    if zone.upper() not in _UTC_NAMES:
        raise ValueError(f"spark.sql.session.timeZone must be UTC, not {zone}")


def _located(spark: SparkSession, path: str):
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark._jsc.hadoopConfiguration()), found


def read_text(spark: SparkSession, path: str) -> str | None:
    """The text of a small file; None if there is none."""
    fs, where = _located(spark, path)
    if not fs.exists(where):
        return None
    stream = fs.open(where)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file that appears whole, in place of what was there."""
    fs, where = _located(spark, path)
    _, part = _located(spark, f"{path}.part")
    stream = fs.create(part, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    fs.delete(where, False)
    if not fs.rename(part, where):
        raise OSError(f"cannot write {path}")


def delete(spark: SparkSession, path: str) -> None:
    """Delete a file or folder, if it is there."""
    fs, where = _located(spark, path)
    fs.delete(where, True)


def file_names(spark: SparkSession, path: str) -> list[str]:
    """Names in one folder, which should hold few."""
    fs, where = _located(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(where)) if fs.exists(where) else []
