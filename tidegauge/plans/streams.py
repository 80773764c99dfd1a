"""Registered queries that run streams and sinks.

A stream's input is the mapped event table, written in three slices of time
into a new shared folder. After each slice the stream is started on its
checkpoint, handles what is new, and stops: so slices arrive in order and
every query also goes through two restarts.
"""

from __future__ import annotations

import datetime as dt
import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from tidegauge.operators import validate
from tidegauge.plans.analytics import A8, A9, FIVE, MET, MINUTE, SCORED_STATS, STATS, _system_sql, _SYSTEM_COLS
from tidegauge.plans.ingest import sql_cols
from tidegauge.plans import mapping
from tidegauge.plans.mapping import C, E, W, table
from tidegauge.plans.registry import register
from tidegauge.plans.scratch import scratch_path
from tidegauge.schema import CANONICAL_COLS, RECENT_COLS, SCORE_COLS, SCORED_COLS, WAREHOUSE_COLS
from tidegauge.sources import messages, sinks, tables
from tidegauge.streaming import rows as stream_rows, tables as stream_tables
from tidegauge.streaming.scoring import stream_scored

_CUTS = ["2024-01-11", "2024-01-21"]
_MANY = 1_000_000

Start = Callable[[DataFrame, str], StreamingQuery]

# A stream's tasks are as many as the files of its input, so these are written by all cores.
events, typed_events, dirty_events = (functools.partial(f, spread=True) for f in (mapping.events, mapping.typed_events, mapping.dirty_events))


def _slices(df: DataFrame, time_col: str = "arrival_timestamp") -> list[DataFrame]:
    """``df`` in three slices of time, rows without a time in the first."""
    at = F.coalesce(F.col(time_col).try_cast("timestamp"), F.lit("2024-01-01").cast("timestamp"))
    first, second = (F.lit(c).cast("timestamp") for c in _CUTS)
    return [df.filter(at < first), df.filter((at >= first) & (at < second)), df.filter(at >= second)]


def _feed(df: DataFrame, start: Start) -> str:
    """Stream ``df`` through ``start``; gives the folder it may write under."""
    spark, base = df.sparkSession, scratch_path(df.sparkSession, "stream")
    for part in _slices(df):
        part.write.mode("append").parquet(f"{base}/in")
        source = tables.stream_parquet(spark, f"{base}/in", df.schema, _MANY)
        start(source, base).awaitTermination()
    return base


def _feed_messages(df: DataFrame, time_col: str, *starts: Start, sink: str = "folder") -> str:
    """The same with JSON messages of one topic; several streams run one after another."""
    spark, base = df.sparkSession, scratch_path(df.sparkSession, "messages")
    for part in _slices(df, time_col):
        sinks.write_messages(part, f"{base}/raw", sink)
        source = messages.stream_messages(spark, [f"{base}/raw"], sink, max_per_trigger=_MANY)
        for start in starts:
            start(source, base).awaitTermination()
    return base


def _append(df: DataFrame, base: str) -> StreamingQuery:
    return sinks.stream_batches(df, f"{base}/out", f"{base}/checkpoint", max_rows=5000)


def _read(spark: SparkSession, base: str, name: str = "out") -> DataFrame:
    return spark.read.parquet(f"{base}/{name}")


# --- sources ----------------------------------------------------------------


@register(
    "S3_stream_parquet",
    "SELECT event_id, ts, user_id, event_type, round(value, 6) AS value, props FROM events",
)
def _(spark, sf_dir):
    base = scratch_path(spark, "stream")
    table(spark, sf_dir, "events")
    # The source takes files by a glob; this one fits the table alone.
    source = tables.stream_parquet(spark, f"{sf_dir}/events.parque[t]")
    _append(source, base).awaitTermination()
    return _read(spark, base)


@register(
    "S3_stream_row_groups",
    "SELECT event_id, ts, user_id, event_type, round(value, 6) AS value, props FROM events",
)
def _(spark, sf_dir):
    """One file of small row groups for each million rows, in batches of about a fifth of all."""
    base = scratch_path(spark, "stream")
    rows = table(spark, sf_dir, "events")
    files = -(-rows.count() // _MANY) or 1
    rows.repartition(files).write.option("parquet.block.size", 16 * 1024).option("parquet.page.size.row.check.min", 10).parquet(f"{base}/in")
    source = tables.stream_parquet(spark, f"{base}/in", rows.schema, max_rows=max(1, rows.count() // 5))
    query = sinks.stream_batches(source, f"{base}/out", f"{base}/checkpoint", max_rows=5000, max_seconds=0)
    query.processAllAvailable()
    query.stop()
    return _read(spark, base)


@register(
    "S4_stream_kafka_json",
    f"""WITH {E} SELECT {sql_cols(CANONICAL_COLS)}, 'raw' AS topic, 0 AS partition, count(*) OVER () AS messages,
      0 AS first_offset, CAST(count(*) OVER () - 1 AS BIGINT) AS last_offset FROM e""",
)
def _(spark, sf_dir):
    """Every event that was sent, beside the range of positions of its partition."""
    rows = events(spark, sf_dir)
    keep = messages.POSITION_COLS
    start = lambda source, base: _append(stream_rows.stream_canonical(source, keep), base)
    got = _read(spark, _feed_messages(rows, "arrival_timestamp", start))
    # Each position once: as many as from the first through the last.
    ranges = got.groupBy("topic", "partition").agg(
        F.countDistinct("offset").alias("messages"),
        F.min("offset").cast("int").alias("first_offset"),
        F.max("offset").alias("last_offset"),
    )
    return got.join(ranges, ["topic", "partition"]).drop("offset")


@register("S4_stream_json_files", f"WITH {E} SELECT {sql_cols(CANONICAL_COLS)} FROM e")
def _(spark, sf_dir):
    rows = events(spark, sf_dir)
    start = lambda source, base: _append(stream_rows.stream_canonical(source), base)
    return _read(spark, _feed_messages(rows, "arrival_timestamp", start, sink="json"))


# --- streams ----------------------------------------------------------------


@register(
    "X1_stream_clean",
    f"""WITH {C} SELECT {sql_cols(CANONICAL_COLS)}, coalesce(nullif(deployment, ''), 'unknown') AS dataset_type
    FROM c""",
)
def _(spark, sf_dir):
    raw = dirty_events(spark, sf_dir).withColumnRenamed("deployment", "deployment_type")
    start = lambda source, base: _append(stream_rows.stream_clean(source), base)
    return _read(spark, _feed_messages(raw, "arrival_time", start))


@register("X2_stream_dedup", f"WITH {E} SELECT {sql_cols(CANONICAL_COLS)} FROM e")
def _(spark, sf_dir):
    rows = events(spark, sf_dir)
    start = lambda source, base: _append(stream_rows.stream_dedup(source), base)
    return _read(spark, _feed(rows.unionByName(rows), start))


@register(
    "X2_stream_dedup_sessions",
    f"""WITH {E}, n AS (SELECT *, lag(arrival_timestamp) OVER (PARTITION BY query_id ORDER BY arrival_timestamp) AS last FROM e)
    SELECT {sql_cols(CANONICAL_COLS)} FROM n
    WHERE last IS NULL OR arrival_timestamp > last + INTERVAL 1 HOUR""",
)
def _(spark, sf_dir):
    # A last row of far later closes all sessions; its own stays open.
    rows = events(spark, sf_dir)
    late = rows.limit(1).withColumns({"query_id": F.lit("last"), "arrival_timestamp": F.lit("2030-01-01").cast("timestamp")})
    start = lambda source, base: _append(stream_rows.stream_dedup(source, ["query_id"], 3600, "1 hour"), base)
    return _read(spark, _feed(rows.unionByName(late), start)).select(*CANONICAL_COLS)


@register(
    "X3_stream_baselines",
    f"WITH {E}, {W} SELECT dataset_type, {sql_cols(CANONICAL_COLS)}, {sql_cols(SCORE_COLS)} FROM scored",
)
def _(spark, sf_dir):
    def start(source: DataFrame, base: str) -> StreamingQuery:
        return stream_tables.stream_baselines(source, f"{base}/out", f"{base}/state", f"{base}/checkpoint")

    scored = _read(spark, _feed(typed_events(spark, sf_dir), start))
    return scored.drop(stream_tables.BATCH_COL)


def _rolled(df: DataFrame, kind: str, keys: list[str]) -> DataFrame:
    def start(source: DataFrame, base: str) -> StreamingQuery:
        rolled = stream_rows.stream_rollup(source, kind, "1 hour")
        return stream_tables.stream_updates(rolled, f"{base}/out", f"{base}/checkpoint", keys, "day")

    return stream_tables.read_updates(df.sparkSession, f"{_feed(df, start)}/out")


@register(
    "X4_stream_rollup_minute",
    f"WITH {E} SELECT {MINUTE} AS window_start, deployment_type, {STATS} FROM e GROUP BY 1, 2",
)
def _(spark, sf_dir):
    return _rolled(events(spark, sf_dir), "minute", ["window_start", "deployment_type"])


@register(
    "X4_stream_rollup_5min",
    f"WITH {E} SELECT {FIVE} AS window_start, deployment_type, {STATS} FROM e GROUP BY 1, 2",
)
def _(spark, sf_dir):
    return _rolled(events(spark, sf_dir), "5min", ["window_start", "deployment_type"])


_PROVISIONED, _SERVERLESS = "query_metrics_processed_provisioned", "query_metrics_processed_serverless"


def _score_and_route(source: DataFrame, base: str) -> StreamingQuery:
    """One stream: JSON messages are cleaned, scored against running baselines, and sent to their topics."""
    routed = stream_rows.route_topics(stream_scored(stream_rows.stream_clean(source)))
    return sinks.stream_topics(routed, f"{base}/processed", f"{base}/checkpoint", "folder")


def _processed(base: str) -> list[str]:
    return [f"{base}/processed/{topic}" for topic in (_PROVISIONED, _SERVERLESS)]


@register(
    "X3_stream_scored",
    f"WITH {E}, {W} SELECT {sql_cols(SCORED_COLS)} FROM scored",
)
def _(spark, sf_dir):
    start = lambda source, base: _append(stream_scored(stream_rows.stream_clean(source)), base)
    return _read(spark, _feed_messages(events(spark, sf_dir), "arrival_timestamp", start)).select(*SCORED_COLS)


@register(
    "X3_stream_scored_by_event_time",
    f"WITH {E}, {W} SELECT {sql_cols(SCORED_COLS)} FROM scored",
)
def _(spark, sf_dir):
    # The three slices hold a third of all rows each, mixed in time; rows wait for the watermark.
    base = scratch_path(spark, "stream")
    rows, slice_of = typed_events(spark, sf_dir), F.pmod(F.xxhash64("query_id", "arrival_timestamp"), F.lit(3))
    # Every slice is read from here, so the rows are made once.
    rows.withColumn("slice", slice_of).write.partitionBy("slice").parquet(f"{base}/all")
    every = spark.read.schema(T.StructType([*rows.schema.fields, T.StructField("slice", T.LongType())])).parquet(f"{base}/all")
    mixed = [every.filter(F.col("slice") == k).drop("slice") for k in range(3)]
    rows = every.drop("slice")
    ends = [
        rows.limit(1).withColumns({"query_id": F.lit("end"), "dataset_type": F.lit("end"), "arrival_timestamp": F.lit(t).cast("timestamp")})
        for t in ("2040-01-01", "2050-01-01")
    ]
    for part in [*mixed, *ends]:
        part.write.mode("append").parquet(f"{base}/in")
        source = tables.stream_parquet(spark, f"{base}/in", rows.schema, _MANY)
        _append(stream_scored(source, hold="60 days"), base).awaitTermination()
    return _read(spark, base).filter("dataset_type <> 'end'").select(*SCORED_COLS)


@register(
    "X4_stream_rollup_scored",
    f"WITH {E}, {W} SELECT {MINUTE} AS window_start, dataset_type, {SCORED_STATS} FROM scored GROUP BY 1, 2",
)
def _(spark, sf_dir):
    def roll(_: DataFrame, base: str) -> StreamingQuery:
        processed = messages.stream_messages(spark, _processed(base), "folder")
        rolled = stream_rows.stream_rollup(stream_rows.stream_scored_messages(processed), "scored", "1 hour")
        return stream_tables.stream_updates(rolled, f"{base}/out", f"{base}/rolled", ["window_start", "dataset_type"], "day")

    base = _feed_messages(events(spark, sf_dir), "arrival_timestamp", _score_and_route, roll)
    return stream_tables.read_updates(spark, f"{base}/out")


@register(
    "X4_stream_system_metrics",
    f"WITH {E}, {_system_sql('deployment_type')} SELECT deployment_type, {_SYSTEM_COLS} FROM a6",
)
def _(spark, sf_dir):
    return _rolled(events(spark, sf_dir), "system", ["bucket_start", "deployment_type"])


@register(
    "X4_stream_instance_metrics",
    f"""WITH {E} SELECT {FIVE} AS bucket_start, deployment_type, instance_id, count(*) AS running_count,
      round(sum(scanned_mb), 6) AS scanned_mb, round(sum(spilled_mb), 6) AS spilled_mb
    FROM e WHERE instance_id IS NOT NULL GROUP BY 1, 2, 3""",
)
def _(spark, sf_dir):
    return _rolled(events(spark, sf_dir), "instance", ["bucket_start", "deployment_type", "instance_id"])


def _overlapped(spark: SparkSession, sf_dir: str, by_instance: bool) -> DataFrame:
    """Overlap buckets over three slices of time, with queries that last from one into the next."""
    rows = events(spark, sf_dir)
    first = rows.agg(F.unix_micros(F.date_trunc("minute", F.min("arrival_timestamp")))).first()[0]
    origin = dt.datetime.fromtimestamp(first / 1e6, dt.timezone.utc)

    def start(source: DataFrame, base: str) -> StreamingQuery:
        return stream_tables.stream_overlap(source, f"{base}/out", f"{base}/checkpoint", by_instance, origin=origin)

    return stream_tables.read_updates(spark, f"{_feed(rows, start)}/out")


@register(
    "A8_overlap_incremental",
    f"""WITH {E}, {MET}, {A8} SELECT bucket_start, deployment_type, running_count, queued_count,
      {sql_cols(["scanned_mb", "spilled_mb", "spill_pressure"])} FROM a8""",
)
def _(spark, sf_dir):
    return _overlapped(spark, sf_dir, by_instance=False)


@register(
    "A9_overlap_incremental",
    f"""WITH {E}, {MET}, {A9} SELECT bucket_start, deployment_type, instance_id, running_count,
      {sql_cols(["scanned_mb", "spilled_mb"])} FROM a9""",
)
def _(spark, sf_dir):
    return _overlapped(spark, sf_dir, by_instance=True)


@register(
    "X5_stream_last_n",
    f"WITH {E} SELECT {sql_cols(CANONICAL_COLS)} FROM e ORDER BY e.arrival_timestamp DESC, e.query_id LIMIT 1000",
)
def _(spark, sf_dir):
    def start(source: DataFrame, base: str) -> StreamingQuery:
        return stream_tables.stream_last_n(source, f"{base}/kept", f"{base}/checkpoint")

    base = _feed(events(spark, sf_dir), start)
    return stream_tables.read_last_n(spark, f"{base}/kept")


def _upserted(spark: SparkSession, sf_dir: str) -> str:
    """Every event twice within its batch, with other measures first; the message that comes last counts."""
    rows = events(spark, sf_dir)
    wrong = rows.withColumns({"scanned_mb": F.lit(7.0), "duration_seconds": F.lit(1e6), "execution_duration_ms": F.lit(9).cast("bigint")})

    def start(source: DataFrame, base: str) -> StreamingQuery:
        given = stream_rows.stream_canonical(source, messages.POSITION_COLS)
        paths = f"{base}/events", f"{base}/rollups", f"{base}/checkpoint"
        return stream_tables.stream_upsert(given, *paths, messages.POSITION_COLS, part="day")

    base = scratch_path(spark, "messages")
    for first, last in zip(_slices(wrong), _slices(rows)):
        for part in (first, last):
            sinks.write_messages(part, f"{base}/raw", "folder")
        start(messages.stream_messages(spark, [f"{base}/raw"], "folder"), base).awaitTermination()
    return base


@register(
    "X6_stream_upsert", f"WITH {E} SELECT {MINUTE} AS window_start, deployment_type, {STATS} FROM e GROUP BY 1, 2"
)
def _(spark, sf_dir):
    return stream_tables.read_rollups(spark, f"{_upserted(spark, sf_dir)}/rollups")


@register("X6_stream_upsert_events", f"WITH {E} SELECT {sql_cols(CANONICAL_COLS)} FROM e")
def _(spark, sf_dir):
    return stream_tables.read_events(spark, f"{_upserted(spark, sf_dir)}/events").select(*CANONICAL_COLS)


@register(
    "X7_route_topics",
    f"""WITH {E}, {W} SELECT CASE WHEN dataset_type = 'provisioned' THEN 'query_metrics_processed_provisioned'
        ELSE 'query_metrics_processed_serverless' END AS topic, dataset_type, {sql_cols(CANONICAL_COLS)},
      {sql_cols(SCORE_COLS)} FROM scored""",
)
def _(spark, sf_dir):
    base = _feed_messages(events(spark, sf_dir), "arrival_timestamp", _score_and_route)
    sent = messages.read_messages(spark, _processed(base))
    return stream_rows.stream_scored_messages(sent, ["topic"])


# --- sinks ------------------------------------------------------------------


@register("K1_write_batches", f"WITH {E} SELECT {sql_cols(RECENT_COLS)} FROM e")
def _(spark, sf_dir):
    path = scratch_path(spark, "batches")
    sinks.write_batches(events(spark, sf_dir).select(*RECENT_COLS), path, max_rows=1000)
    return spark.read.parquet(path)


@register("K1_rolled_files", f"WITH {E} SELECT {sql_cols(RECENT_COLS)} FROM e")
def _(spark, sf_dir):
    """Small triggers share files of up to a thousand rows."""
    rows = events(spark, sf_dir).select(*RECENT_COLS)

    def start(source: DataFrame, base: str) -> StreamingQuery:
        return stream_tables.stream_rolled_files(source, f"{base}/files", f"{base}/checkpoint", 1000, 3600)

    base = _feed(rows, start)
    stream_tables.close_files(spark, f"{base}/files", 1000, rows.schema)
    return spark.read.schema(rows.schema).parquet(f"{base}/files/closed").select(*RECENT_COLS)


@register("K1_write_batches_csv", f"WITH {E} SELECT {sql_cols(WAREHOUSE_COLS)} FROM e")
def _(spark, sf_dir):
    path = scratch_path(spark, "batches")
    staged = validate.project_warehouse(events(spark, sf_dir))
    sinks.write_batches(staged, path, max_rows=1000, fmt="csv")
    return spark.read.schema(staged.schema).csv(path, header=True, timestampFormat=sinks.ISO_UTC)


@register("K2_write_kafka_json", f"WITH {E} SELECT {sql_cols(CANONICAL_COLS)} FROM e")
def _(spark, sf_dir):
    path = scratch_path(spark, "topic")
    sinks.write_messages(events(spark, sf_dir), path, "folder")
    lines = messages.read_messages(spark, [path])
    decoded = validate.decode_json(validate.forbid_extra(lines), validate.text_schema(CANONICAL_COLS))
    return validate.validate_canonical(validate.typed_message(decoded))


@register("K3_stage_for_warehouse", f"WITH {E} SELECT {sql_cols(WAREHOUSE_COLS)} FROM e")
def _(spark, sf_dir):
    prefix = scratch_path(spark, "stage")
    for batch_id, part in enumerate(_slices(events(spark, sf_dir))):
        sinks.stage_for_warehouse(part, prefix, batch_id)
        sinks.stage_for_warehouse(part, prefix, batch_id)
    return spark.read.parquet(prefix).drop("batch_id")


@register(
    "K4_write_tables",
    f"""WITH {E} SELECT {sql_cols(CANONICAL_COLS)}, cast(arrival_timestamp AS DATE) AS arrival_date FROM e""",
)
def _(spark, sf_dir):
    path = scratch_path(spark, "table")
    sinks.write_tables(events(spark, sf_dir), path)
    return spark.read.parquet(path)
