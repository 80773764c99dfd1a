"""Sinks: batch files, JSON messages, staged rows and partitioned tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from tidegauge.operators.validate import project_warehouse
from tidegauge.sources import topics

# The file formats that batch files may have.
BATCH_FORMATS = ("parquet", "csv")
ISO_UTC = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"


def checked_format(fmt: str) -> str:
    if fmt not in BATCH_FORMATS:
        raise ValueError(f"format must be one of {', '.join(BATCH_FORMATS)}")
    return fmt


def _format_options(fmt: str) -> dict[str, str]:
    # CSV would cut the times to milliseconds.
    return {"header": "true", "timestampFormat": ISO_UTC} if fmt == "csv" else {}


def write_batches(df: DataFrame, path: str, max_rows: int, fmt: str = "parquet") -> None:
    """Files of at most ``max_rows`` rows each."""
    if max_rows <= 0:
        raise ValueError("max_rows must be > 0")
    writer = df.write.format(checked_format(fmt)).mode("append").option("maxRecordsPerFile", max_rows)
    writer.options(**_format_options(fmt)).save(path)


def stream_batches(
    df: DataFrame,
    path: str,
    checkpoint: str,
    max_rows: int,
    max_seconds: int | None = None,
    fmt: str = "parquet",
) -> StreamingQuery:
    """The same from a stream, closed every ``max_seconds``; without it, all
    that is available now is written and the query ends."""
    if max_rows <= 0:
        raise ValueError("max_rows must be > 0")
    writer = (
        df.writeStream.format(checked_format(fmt))
        .option("maxRecordsPerFile", max_rows)
        .option("checkpointLocation", checkpoint)
        .option("path", path)
        .options(**_format_options(fmt))
    )
    if max_seconds is None:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=f"{max_seconds} seconds").start()


def to_messages(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Each row as a JSON object in ``value``, times as ISO text in UTC, nulls
    written out; ``keep`` names columns to leave outside the object."""
    body = [c for c in df.columns if c not in keep]
    options = {"timestampFormat": ISO_UTC, "ignoreNullFields": "false"}
    return df.select(*keep, F.to_json(F.struct(*body), options).alias("value"))


def write_messages(
    df: DataFrame, target: str, sink: str = "kafka", bootstrap_servers: str = "localhost:9092"
) -> None:
    """Send rows as JSON: to the topic ``target``; with ``sink='folder'`` to the topic that is
    the folder ``target``, with ``'json'`` as JSON lines into the plain folder ``target``."""
    messages = to_messages(df)
    if sink == "kafka":
        (
            messages.write.format("kafka")
            .option("kafka.bootstrap.servers", bootstrap_servers)
            .option("topic", target)
            .save()
        )
    elif sink == "folder":
        root, _, name = target.rstrip("/").rpartition("/")
        topics.register(df.sparkSession)
        named = messages.select(F.lit(topics.topic_name(name)).alias("topic"), "value")
        named.write.format(topics.FORMAT).mode("append").option("path", root).save()
    elif sink == "json":
        messages.write.mode("append").text(target)
    else:
        raise ValueError("sink must be 'kafka', 'folder' or 'json'")


def stream_topics(
    routed: DataFrame,
    target: str,
    checkpoint: str,
    sink: str = "kafka",
    seconds: int | None = None,
) -> StreamingQuery:
    """Send a stream's ``(topic, value)`` rows each to its topic.

    With ``sink='kafka'`` ``target`` names the bootstrap servers; delivery is at least
    once, so a batch repeated after a failure is sent again. With ``sink='folder'`` it is
    the folder of the topics: a batch appears whole in each topic or not at all, and one
    that is repeated adds nothing. There a topic takes one stream at a time, and the
    checkpoint's path is the name by which a stream knows its own batches.

    Without ``seconds`` all that is available now is sent, and the query ends.
    """
    writer = routed.select("topic", "value").writeStream.option("checkpointLocation", checkpoint)
    if sink == "kafka":
        writer = writer.format("kafka").option("kafka.bootstrap.servers", target)
    elif sink == "folder":
        topics.register(routed.sparkSession)
        writer = writer.format(topics.FORMAT).option("path", target).option("writer", checkpoint)
    else:
        raise ValueError("sink must be 'kafka' or 'folder'")
    if seconds is None:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=f"{seconds} seconds").start()


def stage_for_warehouse(df: DataFrame, prefix: str, batch_id: int | str) -> str:
    """The staged columns as Parquet under ``prefix``, one folder per batch.

    A repeated batch overwrites its own folder, so a retry adds nothing twice.
    Any Hadoop path will do, object stores included.
    """
    path = f"{prefix.rstrip('/')}/batch_id={batch_id}"
    project_warehouse(df).write.mode("overwrite").parquet(path)
    return path


def write_tables(
    df: DataFrame,
    path: str,
    time_col: str = "arrival_timestamp",
    sort_cols: Sequence[str] = ("deployment_type", "arrival_timestamp"),
    date_col: str = "arrival_date",
    mode: str = "append",
) -> None:
    """A table partitioned by date, sorted within its files.

    Readers prune whole days, and within files the row groups' statistics on
    the sort columns. With ``mode='overwrite'`` only the days in ``df`` are
    replaced.
    """
    dated = df.withColumn(date_col, F.to_date(time_col))
    write_partitions(dated, path, [date_col], sort_cols, mode)


def write_partitions(
    df: DataFrame, path: str, by: Sequence[str], sort_cols: Sequence[str] = (), mode: str = "overwrite"
) -> None:
    """Write ``df`` partitioned by the columns ``by``.

    The rebalance hint gathers the rows of a partition, so that it gets few
    files, and lets adaptive execution split a hot one over several tasks.
    """
    (
        df.hint("rebalance", *by)
        .sortWithinPartitions(*by, *sort_cols)
        .write.mode(mode)
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*by)
        .parquet(path)
    )
