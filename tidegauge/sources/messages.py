"""Message streams: Kafka topics, topics as folders, or plain folders of JSON lines, all of one shape."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidegauge.sources import topics as folder_topics

# Where a message stood; a poll hands messages over in this order.
POSITION_COLS = ["topic", "partition", "offset"]


def stream_messages(
    spark: SparkSession,
    topics: Sequence[str],
    source: str = "kafka",
    starting: str = "earliest",
    group: str | None = None,
    bootstrap_servers: str | None = None,
    max_per_trigger: int | None = None,
) -> DataFrame:
    """``(topic, partition, offset, value)`` of every message of the topics.

    ``source='kafka'`` subscribes from the earliest (writers) or latest (live
    views) offset; it needs the Spark Kafka connector on the class path.
    ``source='folder'`` reads topics that ``write_messages`` or ``stream_topics``
    keeps as folders, each given by its path; ``max_per_trigger`` bounds a batch
    to about as many messages. With a trigger that takes what is available once,
    a bounded stream makes one batch per start.
    ``source='json'`` takes each topic as a folder of JSON-lines files (as many
    per trigger), whose name is the topic. Such files have no positions, so both
    are null, and the stream always starts with the earliest file.
    """
    if starting not in folder_topics.STARTS:
        raise ValueError("starting must be 'earliest' or 'latest'")
    if not topics:
        raise ValueError("at least one topic is required")
    if max_per_trigger is not None and max_per_trigger <= 0:
        raise ValueError("max_per_trigger must be > 0")
    if source == "kafka":
        reader = (
            spark.readStream.format("kafka")
            .option("kafka.bootstrap.servers", bootstrap_servers or "localhost:9092")
            .option("subscribe", ",".join(topics))
            .option("startingOffsets", starting)
        )
        if group:
            reader = reader.option("kafka.group.id", group)
        if max_per_trigger:
            reader = reader.option("maxOffsetsPerTrigger", max_per_trigger)
        return reader.load().select(*POSITION_COLS, F.col("value").cast("string").alias("value"))
    if source == "folder":
        folder_topics.register(spark)
        reader = spark.readStream.format(folder_topics.FORMAT).option("paths", json.dumps(list(topics))).option("starting", starting)
        if max_per_trigger:
            reader = reader.option("max_rows", max_per_trigger)
        return reader.load()
    if source == "json":
        if starting != "earliest":
            raise ValueError("plain folders have no positions: starting must be 'earliest'")
        out = None
        for folder in topics:
            lines = spark.readStream.option("maxFilesPerTrigger", max_per_trigger or 1).text(folder)
            name = folder.rstrip("/").rsplit("/", 1)[-1]
            nowhere = [F.lit(None).cast("int").alias("partition"), F.lit(None).cast("bigint").alias("offset")]
            one = lines.select(F.lit(name).alias("topic"), *nowhere, "value")
            out = one if out is None else out.unionByName(one)
        return out
    raise ValueError("source must be 'kafka', 'folder' or 'json'")


def read_messages(spark: SparkSession, topics: Sequence[str]) -> DataFrame:
    """The same columns of all messages that topics kept as folders hold now."""
    if not topics:
        raise ValueError("at least one topic is required")
    folder_topics.register(spark)
    return spark.read.format(folder_topics.FORMAT).option("paths", json.dumps(list(topics))).load()
