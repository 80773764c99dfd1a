"""Streams that maintain tables, batch by batch.

Every batch writes under its own number and reads only what the batch before
wrote, so a batch repeated after a failure gives the same tables again.
"""

from __future__ import annotations

import datetime as dt
import json
import time
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from tidegauge import storage
from tidegauge.operators.baselines import DEFAULT_ALPHA, baseline_scores, baselines_and_state
from tidegauge.operators.dedup import dedup_last_wins
from tidegauge.operators.joins import replace_buckets
from tidegauge.operators.overlap import extend_overlap, overlap_rollup_deployment, overlap_rollup_instance
from tidegauge.operators.partials import finished, merge_partials, minute_partials
from tidegauge.operators.reports import newest_first
from tidegauge.sources.sinks import checked_format, write_batches
from tidegauge.streaming.parts import PART_COL, PartTable, part_format

BATCH_COL = "batch_id"


def _start(
    df: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str, seconds: int | None
) -> StreamingQuery:
    writer = df.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
    if seconds is None:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=f"{seconds} seconds").start()


def _slot(path: str, batch_id: int) -> str:
    """Two folders in turn: the one being written is never the one being read."""
    return f"{path.rstrip('/')}/slot={batch_id % 2}"


def stream_baselines(
    df: DataFrame,
    path: str,
    state_path: str,
    checkpoint: str,
    alpha: float = DEFAULT_ALPHA,
    seconds: int | None = None,
) -> StreamingQuery:
    """Score events against running baselines; scored rows go to ``path``.

    State kept by key would let one task per dataset type do all the work.
    Here each batch is sorted into ranges and scanned by all tasks, starting
    from the baselines that the batch before left in ``state_path``. Within a
    batch rows follow arrival time; across batches the order is that of the
    stream.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        state = None
        if batch_id > 0:
            state = batch.sparkSession.read.parquet(_slot(state_path, batch_id - 1))
        batch.persist()  # both writes and the sampling read it
        try:
            rows, after = baselines_and_state(batch, alpha=alpha, state=state)
            baseline_scores(rows).write.mode("overwrite").parquet(f"{path.rstrip('/')}/{BATCH_COL}={batch_id}")
            if state is not None:
                seen = after.select(F.col("dataset_type").alias("seen"))
                unseen = state.join(seen, F.col("dataset_type").eqNullSafe(F.col("seen")), "left_anti")
                after = after.unionByName(unseen)
            after.write.mode("overwrite").parquet(_slot(state_path, batch_id))
        finally:
            batch.unpersist()

    return _start(df, handle, checkpoint, seconds)


def stream_rolled_files(
    df: DataFrame,
    path: str,
    checkpoint: str,
    max_rows: int,
    max_seconds: int,
    fmt: str = "parquet",
    seconds: int | None = None,
    now: Callable[[], float] = time.time,
) -> StreamingQuery:
    """Files that small triggers share: closed at ``max_rows`` rows, or when ``max_seconds`` old.

    Rows of the triggers since the last close wait under ``path/open``, a run per batch; the
    batch that meets a limit writes them all into ``path/closed/v=<batch>``, in files of at
    most ``max_rows``, and a later one deletes the runs. Age is looked at with every trigger
    that has rows. A state file per batch tells the open runs, and each batch starts from the
    state before it: one that is repeated writes the same again, and no row is lost or
    closed twice. ``close_files`` closes what is open when a stream has ended.
    """
    if max_rows <= 0 or max_seconds <= 0:
        raise ValueError("max_rows and max_seconds must be > 0")
    checked_format(fmt)

    def handle(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        before = _open_state(spark, path, batch_id - 1)
        batch.write.mode("overwrite").parquet(f"{path}/open/v={batch_id}")
        rows = spark.read.schema(batch.schema).parquet(f"{path}/open/v={batch_id}").count()
        runs = [*before["runs"], batch_id] if rows else before["runs"]
        since = now() if before["since"] is None and rows else before["since"]
        state = {"runs": runs, "rows": before["rows"] + rows, "since": since, "gone": []}
        storage.delete(spark, f"{path}/closed/v={batch_id}")
        if runs and (state["rows"] >= max_rows or now() - state["since"] >= max_seconds):
            _close(spark, path, batch_id, runs, state["rows"], max_rows, fmt, batch.schema)
            state = {"runs": [], "rows": 0, "since": None, "gone": runs}
        storage.write_text(spark, f"{path}/state/{batch_id:020d}.json", json.dumps(state))
        for run in before["gone"]:
            storage.delete(spark, f"{path}/open/v={run}")
        if batch_id >= 2:
            storage.delete(spark, f"{path}/state/{batch_id - 2:020d}.json")

    return _start(df, handle, checkpoint, seconds)


def _open_state(spark: SparkSession, path: str, batch_id: int) -> dict:
    text = storage.read_text(spark, f"{path}/state/{batch_id:020d}.json") if batch_id >= 0 else None
    if text is None and batch_id >= 0:
        raise FileNotFoundError(f"{path} has lost the state of batch {batch_id}")
    return json.loads(text) if text else {"runs": [], "rows": 0, "since": None, "gone": []}


def _close(spark: SparkSession, path: str, batch_id: int, runs: list[int], rows: int, max_rows: int, fmt: str, schema) -> None:
    waiting = spark.read.schema(schema).parquet(*[f"{path}/open/v={r}" for r in runs])
    # As many tasks as full files, up to a few for each core; each cuts its rows at the limit.
    tasks = min(-(-rows // max_rows), 4 * spark.sparkContext.defaultParallelism)
    write_batches(waiting.repartition(tasks), f"{path}/closed/v={batch_id}", max_rows, fmt)


def close_files(spark: SparkSession, path: str, max_rows: int, schema: T.StructType, fmt: str = "parquet") -> None:
    """Close what ``stream_rolled_files`` has open; the stream must have ended for good."""
    names = [n for n in storage.file_names(spark, f"{path}/state") if n.endswith(".json")]
    last = int(names[-1][: -len(".json")]) if names else -1
    state = _open_state(spark, path, last)
    if state["runs"]:
        _close(spark, path, last + 1, state["runs"], state["rows"], max_rows, fmt, schema)
        closed = {"runs": [], "rows": 0, "since": None, "gone": state["runs"]}
        storage.write_text(spark, f"{path}/state/{last + 1:020d}.json", json.dumps(closed))


def stream_last_n(
    df: DataFrame, path: str, checkpoint: str, n: int = 1000, seconds: int | None = None
) -> StreamingQuery:
    """Keep the newest ``n`` events of a stream."""
    if n <= 0:
        raise ValueError("n must be > 0")

    def handle(batch: DataFrame, batch_id: int) -> None:
        rows = batch
        if batch_id > 0:
            kept = batch.sparkSession.read.schema(batch.schema).parquet(_slot(path, batch_id - 1))
            rows = kept.unionByName(rows)
        newest = rows.orderBy(*newest_first(rows)).limit(n)
        marked = newest.withColumn(BATCH_COL, F.lit(batch_id).cast("bigint"))
        marked.write.mode("overwrite").parquet(_slot(path, batch_id))

    return _start(df, handle, checkpoint, seconds)


def read_last_n(spark: SparkSession, path: str, show: int | None = None) -> DataFrame:
    """The events that ``stream_last_n`` holds now, or the newest ``show`` of them."""
    slots = spark.read.parquet(path)
    current = slots.agg(F.max(BATCH_COL).alias("current")).scalar()
    kept = slots.filter(F.col(BATCH_COL) == current).drop(BATCH_COL, "slot")
    if show is None:
        return kept
    return kept.orderBy(*newest_first(kept)).limit(show)


def stream_upsert(
    df: DataFrame,
    events_path: str,
    rollups_path: str,
    checkpoint: str,
    ingest_order: Sequence[str],
    part: str = "hour",
    seconds: int | None = None,
) -> StreamingQuery:
    """Append each batch to the event table and add it to the minute rollups it touches.

    Within a batch the last row of an event wins, by the columns ``ingest_order`` (such as
    ``POSITION_COLS``); rows equal there too follow their other columns. Both tables are
    ``PartTable``s, by ``part`` (hour or day): a batch reads the partial rollups of its own
    parts and no events, late rows count, and a repeated batch adds nothing twice. The
    stream's position is committed after both writes. ``read_events`` and ``read_rollups``
    give the tables.
    """
    fmt, order = part_format(part), [ingest_order] if isinstance(ingest_order, str) else list(ingest_order)
    if not order:
        raise ValueError("ingest_order must name at least one column")

    def handle(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        rows = dedup_last_wins(batch, order).withColumn(PART_COL, F.date_format("arrival_timestamp", fmt))
        rows = rows.persist()  # both tables and the list of parts read it
        try:
            PartTable(spark, events_path).append(batch_id, rows, ["arrival_timestamp"])
            fresh = minute_partials(rows, ["deployment_type", PART_COL])
            keys = ["window_start", "deployment_type", PART_COL]
            merged = lambda old, new: merge_partials(old.unionByName(new), keys)
            PartTable(spark, rollups_path).merge(batch_id, fresh, merged, ["window_start"])
        finally:
            rows.unpersist()

    return _start(df, handle, checkpoint, seconds)


def read_events(spark: SparkSession, path: str) -> DataFrame:
    """The events that ``stream_upsert`` has stored."""
    return PartTable(spark, path).current().drop(PART_COL)


def read_partials(spark: SparkSession, path: str) -> DataFrame:
    """The partial rollups that ``stream_upsert`` keeps, one row per minute and deployment."""
    return PartTable(spark, path).current().drop(PART_COL)


def read_rollups(spark: SparkSession, path: str) -> DataFrame:
    """The minute rollups that ``stream_upsert`` keeps."""
    return finished(read_partials(spark, path))


def stream_updates(
    rolled: DataFrame, path: str, checkpoint: str, keys: Sequence[str], part: str = "hour", seconds: int | None = None
) -> StreamingQuery:
    """Keep the latest state of every window of ``stream_rollup``.

    ``keys`` are those of a window, its start first. Each trigger replaces the windows it
    changed within their parts (``PartTable``), so a part that the watermark has closed is
    never read or written again.
    """
    fmt = part_format(part)

    def handle(batch: DataFrame, batch_id: int) -> None:
        fresh = batch.withColumn(PART_COL, F.date_format(keys[0], fmt)).persist()
        try:
            merged = lambda old, new: replace_buckets(old, new, [PART_COL, *keys])
            PartTable(batch.sparkSession, path).merge(batch_id, fresh, merged, list(keys))
        finally:
            fresh.unpersist()

    writer = rolled.writeStream.outputMode("update").foreachBatch(handle).option("checkpointLocation", checkpoint)
    if seconds is None:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=f"{seconds} seconds").start()


def stream_overlap(
    df: DataFrame,
    path: str,
    checkpoint: str,
    by_instance: bool = False,
    divisor: str = "execution",
    origin: str | dt.datetime = "epoch",
    seconds: int | None = None,
) -> StreamingQuery:
    """Keep the overlap buckets of a stream of queries, five minutes each.

    Each batch adds its queries' shares to the buckets they meet, and reads and writes the
    days of these buckets only; queries that last over batches are counted once in each
    bucket (``extend_overlap``). ``origin`` is ``epoch`` or the start of the first bucket.
    ``read_updates`` gives the buckets.
    """
    if origin == "first_minute":
        raise ValueError("the origin of a stream must be fixed: 'epoch' or a time")
    rollup = overlap_rollup_instance if by_instance else overlap_rollup_deployment

    def handle(batch: DataFrame, batch_id: int) -> None:
        fresh = rollup(batch, divisor, origin).withColumn(PART_COL, F.date_format("bucket_start", part_format("day"))).persist()
        try:
            PartTable(batch.sparkSession, path).merge(batch_id, fresh, extend_overlap, ["bucket_start"])
        finally:
            fresh.unpersist()

    return _start(df, handle, checkpoint, seconds)


def read_updates(spark: SparkSession, path: str) -> DataFrame:
    """The latest state of every window that ``stream_updates`` or ``stream_overlap`` keeps."""
    return PartTable(spark, path).current().drop(PART_COL)
