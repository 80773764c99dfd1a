"""Row-wise and windowed streaming operators: streaming DataFrame in and out."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from tidegauge.functions.text import derive_dataset_type
from tidegauge.operators import rollups
from tidegauge.operators.clean import clean_resolved, resolve_aliases
from tidegauge.operators.dedup import DEFAULT_KEYS
from tidegauge.operators.joins import INSTANCE_KEYS
from tidegauge.operators.validate import (
    KEYS_COL,
    decode_json,
    forbid_extra,
    text_schema,
    typed_message,
    validate_canonical,
)
from tidegauge.schema import CANONICAL_COLS, SCORE_COLS, SCORED_COLS
from tidegauge.settings import CleaningRules
from tidegauge.sources.sinks import to_messages


def stream_clean(
    messages: DataFrame,
    rules: CleaningRules = CleaningRules(),
    formats: tuple[str, ...] = (),
    keep: Sequence[str] = (),
) -> DataFrame:
    """Raw JSON messages to valid canonical events with ``dataset_type``.

    Which of a field's names is present is decided message by message, and an
    explicit null counts as present. A message without ``deployment_type``
    takes its dataset type for it.

    ``formats`` are patterns of times that are no ISO texts. ``keep`` names columns of
    ``messages`` to carry along, such as ``POSITION_COLS``.
    """
    raw = decode_json(messages, keep=keep)
    typed = raw.withColumn("dataset_type", derive_dataset_type(F.col("dataset_type"), F.col("deployment_type")))
    given = F.array_contains(KEYS_COL, "deployment_type")
    typed = typed.withColumns(
        {
            "deployment_type": F.when(given, F.col("deployment_type")).otherwise(F.col("dataset_type")),
            KEYS_COL: F.array_append(KEYS_COL, "deployment_type"),
        }
    )
    kept = [*keep, "dataset_type"]
    resolved = resolve_aliases(typed, KEYS_COL, kept)
    return clean_resolved(resolved, rules, formats, keep=kept, from_messages=True)


def stream_canonical(messages: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """JSON messages that are canonical events already; all others are dropped.

    ``keep`` names columns of ``messages`` to carry along.
    """
    decoded = decode_json(forbid_extra(messages), text_schema(CANONICAL_COLS), keep=keep)
    return validate_canonical(typed_message(decoded, keep=keep))


def stream_scored_messages(messages: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Scored events as ``route_topics`` sends them, decoded; messages without all their fields are dropped."""
    decoded = decode_json(forbid_extra(messages, SCORED_COLS), text_schema(SCORED_COLS), keep=keep)
    typed = typed_message(decoded, keep=[*keep, "dataset_type"], more={c: "double" for c in SCORE_COLS})
    scored = F.lit(True)
    for c in ["dataset_type", *SCORE_COLS]:
        scored = scored & F.col(c).isNotNull()
    return validate_canonical(typed.filter(scored)).select(*keep, *SCORED_COLS)


def stream_dedup(
    df: DataFrame,
    keys: Sequence[str] = DEFAULT_KEYS,
    ttl_seconds: int = 3600,
    watermark: str | None = None,
    event_time: str = "arrival_timestamp",
) -> DataFrame:
    """Drop repeats of a key within ``ttl_seconds`` of event time after the row before.

    The result is that of ``dedup_ttl``, however the stream is cut into batches, for all
    rows that come no later than ``watermark`` behind the newest one (default: the
    time to live); later rows are dropped. A repeat, kept or not, starts the time anew.

    With the event time among the keys a row is passed on at once: of repeats that differ in
    other columns the first to arrive stays, where ``dedup_ttl`` keeps the smallest. Otherwise the rows
    of a key form sessions without a gap over the time to live, and a session's
    first row appears when the watermark has closed the session.
    """
    if ttl_seconds <= 0:
        raise ValueError("ttl_seconds must be > 0")
    marked = df.withWatermark(event_time, watermark or f"{ttl_seconds} seconds")
    if event_time in keys:
        return marked.dropDuplicatesWithinWatermark(list(keys))
    # A gap of exactly the time to live still joins two rows.
    session = F.session_window(event_time, f"{ttl_seconds} seconds 1 microsecond")
    rest = [c for c in df.columns if c not in (*keys, event_time)]
    first = F.min(F.struct(F.col(event_time), *[F.col(c) for c in rest])).alias("_first")
    sessions = marked.groupBy(*keys, session).agg(first)
    return sessions.select(*[F.col(c) if c in keys else F.col(f"_first.{c}").alias(c) for c in df.columns])


# rollup kind -> (window, group keys, aggregates, name of the window's start)
_KINDS = {
    "minute": ("1 minute", ("deployment_type",), rollups.query_stats, "window_start"),
    "5min": ("5 minutes", ("deployment_type",), rollups.query_stats, "window_start"),
    "scored": ("1 minute", ("dataset_type",), rollups.scored_stats, "window_start"),
    "system": ("5 minutes", ("deployment_type",), rollups.system_sums, "bucket_start"),
    "instance": ("5 minutes", INSTANCE_KEYS, rollups.instance_sums, "bucket_start"),
}


def stream_rollup(
    df: DataFrame, kind: str, watermark: str | None = "10 minutes", keys: Sequence[str] | None = None
) -> DataFrame:
    """A rollup of ``tidegauge.operators.rollups`` on a stream.

    ``kind`` is minute, 5min, scored, system or instance. Rows that come more
    than ``watermark`` behind the newest event are dropped; with None, ``df`` has a
    watermark already, as after ``stream_scored`` with ``hold``. In update mode
    each trigger emits the windows it changed, in append mode those closed.
    """
    if kind not in _KINDS:
        raise ValueError(f"kind must be one of {', '.join(_KINDS)}")
    width, default_keys, aggregates, name = _KINDS[kind]
    group = list(keys or default_keys)
    if kind == "instance":
        df = df.filter(F.col("instance_id").isNotNull())
    marked = df if watermark is None else df.withWatermark("arrival_timestamp", watermark)
    rolled = marked.groupBy(F.window("arrival_timestamp", width), *group).agg(*aggregates())
    out = rolled.withColumn(name, F.col("window.start")).drop("window")
    return rollups.with_pressures(out) if kind == "system" else out


def route_topics(
    scored: DataFrame,
    provisioned: str = "query_metrics_processed_provisioned",
    serverless: str = "query_metrics_processed_serverless",
) -> DataFrame:
    """``(topic, value)``: provisioned events to one topic, all others to the other."""
    topic = F.when(F.col("dataset_type") == "provisioned", F.lit(provisioned)).otherwise(F.lit(serverless))
    return to_messages(scored.withColumn("topic", topic), keep=["topic"])
