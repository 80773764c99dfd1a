"""Recent events, histories, pivots and other read-side questions."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tidegauge.functions import scores, times
from tidegauge.operators import timeline
from tidegauge.operators.joins import semi_top_n, top_keys
from tidegauge.operators.ordered import tie_break
from tidegauge.operators.rollups import rollup_minute
from tidegauge.schema import DURATION_COLS, METRIC_COLS, RECENT_COLS

AsOf = Column | dt.datetime | str | None

# The columns of the recent scored events, in their order.
RECENT_SCORED_COLS = [
    "query_id",
    "deployment_type",
    "instance_id",
    "arrival_timestamp",
    "execution_start_time",
    "execution_end_time",
    *DURATION_COLS,
    *METRIC_COLS,
    "spill_pressure",
    "queued",
    "queue_score",
    "compile_score",
    "spill_score",
    "scan_score",
]


def newest_first(rows: DataFrame) -> list[Column]:
    """Order by arrival, latest first, then query id; other ties by a hash of the row."""
    by = ["arrival_timestamp", "query_id"]
    return [F.desc(by[0]), F.asc(by[1]), *tie_break(rows, by)]


def with_pressure_level(df: DataFrame) -> DataFrame:
    """Add ``pressure_level`` to rows that have a spill and a queue pressure."""
    return df.withColumn(
        "pressure_level", scores.pressure_level(F.col("spill_pressure"), F.col("queue_pressure"))
    )


def problem_queries(
    scored: DataFrame, minutes: int | None = None, as_of: AsOf = None, deployment: str = "all", n: int | None = None
) -> DataFrame:
    """Each query's ``pressure_score``, on request of a recent span, one
    deployment, and the ``n`` worst only."""
    rows = timeline.filter_deployment(scored, deployment)
    if minutes is not None:
        rows = timeline.filter_last(rows, minutes, as_of)
    score = scores.pressure_score(F.col("queue_score"), F.col("compile_score"), F.col("spill_score"))
    out = rows.select(
        "query_id",
        "arrival_timestamp",
        "deployment_type",
        "instance_id",
        "queue_score",
        "compile_score",
        "spill_score",
        "scan_score",
        score.alias("pressure_score"),
    )
    if n is None:
        return out
    order = [F.desc("pressure_score"), F.desc("arrival_timestamp"), F.asc("query_id")]
    return out.orderBy(*order, *tie_break(out, ["pressure_score", "arrival_timestamp", "query_id"])).limit(n)


def pressure_indicators(buckets: DataFrame, keep: Sequence[str] = ("deployment_type", "window_start")) -> DataFrame:
    """Queue, load, IO and memory pressure of each bucket; missing values are 0."""
    zero = F.lit(0.0)
    value = lambda c: F.coalesce(F.col(c).cast("double"), zero)
    running, queued = value("running_count"), value("queued_count")
    return buckets.select(
        *keep,
        scores.clamp_unit(scores.ratio_or_zero(queued, running + queued)).alias("queue_pressure"),
        F.greatest(running, zero).alias("execution_load"),
        F.greatest(value("scanned_mb"), zero).alias("io_pressure"),
        scores.clamp_unit(value("spill_pressure")).alias("memory_pressure"),
    )


def recent_events(df: DataFrame, n: int = 500, deployment: str | None = "all") -> DataFrame:
    """The newest ``n`` events."""
    rows = timeline.filter_deployment(df, deployment).select(*RECENT_COLS)
    return rows.orderBy(*newest_first(rows)).limit(n)


def recent_rollups(
    df: DataFrame, minutes: int = 60, as_of: AsOf = None, deployment: str | None = "all"
) -> DataFrame:
    """Minute rollups that start within the last ``minutes``, oldest first.

    The cut applies to whole minutes. It is moved up to the next full one
    before the aggregate, so that older events are not even read.
    """
    now = F.current_timestamp() if as_of is None else times.instant(as_of)
    cut = now - F.make_dt_interval(mins=F.lit(minutes))
    first = F.date_trunc("minute", cut + F.make_dt_interval(secs=F.lit(59.999999)))
    rows = timeline.filter_deployment(df.filter(F.col("arrival_timestamp") >= first), deployment)
    return rollup_minute(rows).orderBy("window_start", "deployment_type")


def top_instances(instance_buckets: DataFrame, n: int = 12) -> DataFrame:
    """History of the ``n`` instances that ran most."""
    kept = semi_top_n(instance_buckets, "instance_id", "running_count", n)
    return kept.orderBy("window_start", "deployment_type", "instance_id")


def top_instance_ids(instance_buckets: DataFrame, n: int = 12) -> list[str]:
    """Names of the ``n`` instances that ran most, for ``pivot_instance``."""
    if n <= 0:
        raise ValueError("n must be > 0")
    return [r["instance_id"] for r in top_keys(instance_buckets, "instance_id", "running_count", n).collect()]


def bucket_history(
    buckets: DataFrame, since: dt.datetime | str | None = None, deployment: str | None = "all"
) -> DataFrame:
    """Deployment or instance buckets from ``since`` on, oldest first."""
    rows = timeline.filter_deployment(buckets, deployment)
    if since is not None:
        rows = rows.filter(F.col("window_start") >= times.instant(since))
    keys = [c for c in ("window_start", "deployment_type", "instance_id") if c in buckets.columns]
    return rows.orderBy(*keys)


def recent_scored(scored: DataFrame, deployment: str | None = "all", n: int | None = None) -> DataFrame:
    """Scored events without the duration; all of them or the newest ``n``."""
    rows = timeline.filter_deployment(scored, deployment).select(*RECENT_SCORED_COLS)
    if n is None:
        return rows
    return rows.orderBy(*newest_first(rows)).limit(n)


def pivot_deployment(rollups: DataFrame, deployments: Sequence[str]) -> DataFrame:
    """Average duration per window, a column per deployment."""
    return (
        rollups.groupBy("window_start").pivot("deployment_type", list(deployments)).agg(F.first("avg_duration_seconds"))
    )


def pivot_instance(instance_buckets: DataFrame, instances: Sequence[str], measure: str = "running_count") -> DataFrame:
    """Mean of a measure per window, a column per instance."""
    return instance_buckets.groupBy("window_start").pivot("instance_id", list(instances)).agg(F.avg(measure))


def append_rows(stored: DataFrame, batch: DataFrame) -> DataFrame:
    return stored.unionByName(batch)
