"""Time-bucketed rollups and totals.

All are count / sum / average aggregates, which Spark combines before the
shuffle: a hot bucket or deployment sends one partial row per input partition.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tidegauge.functions import scores, times
from tidegauge.operators import timeline
from tidegauge.operators.joins import replace_buckets
from tidegauge.operators.quantiles import percentile_stats
from tidegauge.schema import SCORE_COLS

# What top_queries_window may rank by.
RANKING_METRICS = (
    "scanned_mb",
    "spilled_mb",
    "queue_duration_ms",
    "execution_duration_ms",
    "compile_duration_ms",
)


def query_stats() -> list[Column]:
    """The four measures that all plain rollups share."""
    return [
        F.count("*").alias("query_count"),
        F.avg("duration_seconds").alias("avg_duration_seconds"),
        F.avg("spill_pressure").alias("avg_spill_pressure"),
        F.avg(F.col("queued").cast("int")).alias("queued_ratio"),
    ]


def _rollup(df: DataFrame, window_start: Column, extra: Sequence[Column] = ()) -> DataFrame:
    return df.groupBy(window_start.alias("window_start"), "deployment_type").agg(*query_stats(), *extra)


def rollup_minute(df: DataFrame) -> DataFrame:
    return _rollup(df, times.bucket_minute(F.col("arrival_timestamp")))


def rollup_5min(df: DataFrame) -> DataFrame:
    return _rollup(df, times.bucket_n_minutes(F.col("arrival_timestamp"), 5))


def rollup_hour_history(df: DataFrame, as_of: Column | dt.datetime | str | None = None, days: int = 7) -> DataFrame:
    """Hourly rollup of the last ``days``, oldest first."""
    recent = timeline.filter_last(df, days * 24 * 60, as_of)
    hourly = _rollup(recent, times.bucket_hour(F.col("arrival_timestamp")))
    return hourly.orderBy("window_start", "deployment_type")


def rollup_hour_between(df: DataFrame, start: dt.date, end: dt.date, deployment: str = "all") -> DataFrame:
    """Hourly rollup between two days, with the sums of scanned and spilled MB."""
    chosen = timeline.filter_deployment(timeline.filter_date_range(df, start, end), deployment)
    sums = [F.sum(c).alias(c) for c in ("scanned_mb", "spilled_mb")]
    hourly = _rollup(chosen, times.bucket_hour(F.col("arrival_timestamp")), sums)
    return hourly.orderBy("window_start", "deployment_type")


def rollup_incremental(
    stored: DataFrame, df: DataFrame, as_of: Column | dt.datetime | str | None = None, minutes: int = 5
) -> DataFrame:
    """``stored`` minute rollups with the trailing ``minutes`` computed anew.

    The cut is moved back to a full minute, so that no minute is replaced by a
    part of itself.
    """
    now = F.current_timestamp() if as_of is None else times.instant(as_of)
    fresh = rollup_minute(timeline.filter_last(df, minutes, times.bucket_minute(now)))
    return replace_buckets(stored, fresh, ["window_start", "deployment_type"])


def rollup_minute_scored(df: DataFrame) -> DataFrame:
    """Minute rollup of scored events by dataset type."""
    minute = times.bucket_minute(F.col("arrival_timestamp")).alias("window_start")
    return df.groupBy(minute, "dataset_type").agg(*scored_stats())


def scored_stats() -> list[Column]:
    return [
        *query_stats(),
        F.sum("scanned_mb").alias("scanned_mb_sum"),
        F.sum("spilled_mb").alias("spilled_mb_sum"),
        *[F.avg(c).alias(f"avg_{c}") for c in SCORE_COLS],
    ]


def system_sums() -> list[Column]:
    return [
        F.count("*").alias("running_count"),
        F.count_if(F.col("queue_duration_ms") > 0).alias("queued_count"),
        F.sum("scanned_mb").alias("_scanned"),
        F.sum("spilled_mb").alias("_spilled"),
        F.sum("execution_duration_ms").alias("_exec_ms"),
    ]


def with_pressures(sums: DataFrame) -> DataFrame:
    """Pressures, level and throughput out of ``system_sums``.

    The running count is all rows of the bucket, queued ones included.
    """
    queued, running = F.col("queued_count"), F.col("running_count")
    scanned, spilled = F.col("_scanned"), F.col("_spilled")
    out = sums.withColumns(
        {
            "queue_pressure": scores.ratio_or_zero(queued, queued + running),
            "spill_pressure": scores.ratio_or_zero(spilled, scanned + spilled),
            "throughput_mb_s": scores.ratio_or_zero(scanned, F.col("_exec_ms") / F.lit(1000.0)),
        }
    )
    level = scores.pressure_level(F.col("spill_pressure"), F.col("queue_pressure"))
    return out.withColumn("pressure_level", level).drop("_scanned", "_spilled", "_exec_ms")


def system_metrics_5min(df: DataFrame, keys: Sequence[str] = ("deployment_type",)) -> DataFrame:
    """Load and pressure per five minutes; add ``run_id`` to ``keys`` to keep runs apart."""
    bucket = times.bucket_n_minutes(F.col("arrival_timestamp"), 5).alias("bucket_start")
    return with_pressures(df.groupBy(bucket, *keys).agg(*system_sums()))


def instance_sums() -> list[Column]:
    return [
        F.count("*").alias("running_count"),
        F.sum("scanned_mb").alias("scanned_mb"),
        F.sum("spilled_mb").alias("spilled_mb"),
    ]


def instance_metrics_5min(
    df: DataFrame, keys: Sequence[str] = ("deployment_type", "instance_id")
) -> DataFrame:
    """Load per five minutes of every known instance."""
    bucket = times.bucket_n_minutes(F.col("arrival_timestamp"), 5).alias("bucket_start")
    return df.filter(F.col("instance_id").isNotNull()).groupBy(bucket, *keys).agg(*instance_sums())


def top_queries(df: DataFrame, type_col: str = "deployment_type", n: int = 50) -> DataFrame:
    """The ``n`` most frequent queries."""
    grouped = df.groupBy("query_id", F.col(type_col).alias("deployment_type")).agg(
        F.count("*").alias("occurrences"),
        F.avg("duration_seconds").alias("avg_duration_seconds"),
        F.avg("spill_pressure").alias("avg_spill_pressure"),
        F.max("arrival_timestamp").alias("last_seen"),
    )
    order = [F.desc("occurrences"), F.desc("last_seen"), F.asc("query_id"), F.asc("deployment_type")]
    return grouped.orderBy(*order).limit(n)


def top_queries_window(
    df: DataFrame, minutes: int = 60, metric: str = "scanned_mb", deployment: str = "all", n: int = 50
) -> DataFrame:
    """The ``n`` heaviest queries by the average of ``metric`` over the window
    that ends with the newest event."""
    if metric not in RANKING_METRICS:
        raise ValueError(f"metric must be one of {', '.join(RANKING_METRICS)}")
    if n <= 0:
        raise ValueError("n must be > 0")
    # The newest event is that of the whole table, whatever the deployment.
    chosen = timeline.filter_deployment(timeline.filter_anchored(df, minutes), deployment)
    grouped = chosen.groupBy("query_id", "deployment_type").agg(
        F.count("*").alias("occurrences"),
        F.avg("duration_seconds").alias("avg_duration_seconds"),
        F.avg("spill_pressure").alias("avg_spill_pressure"),
        F.max("arrival_timestamp").alias("last_seen"),
        F.avg(metric).alias("metric_value"),
        F.sum("scanned_mb").alias("scanned_mb"),
        F.sum("spilled_mb").alias("spilled_mb"),
    )
    order = [F.desc("metric_value"), F.desc("last_seen"), F.asc("query_id"), F.asc("deployment_type")]
    return grouped.orderBy(*order).limit(n)


def pipeline_status(df: DataFrame) -> DataFrame:
    """Row count, earliest and latest arrival."""
    return df.agg(
        F.count("*").alias("processed_rows"),
        F.min("arrival_timestamp").alias("earliest_arrival_ts"),
        F.max("arrival_timestamp").alias("latest_arrival_ts"),
    )


def rollup_p95(df: DataFrame) -> DataFrame:
    """Minute rollup with the average and 95th percentile of execution time."""
    rows = df.select(
        times.bucket_minute(F.col("arrival_timestamp")).alias("window_start"),
        "deployment_type",
        "execution_duration_ms",
    )
    stats = percentile_stats(rows, ["window_start", "deployment_type"], "execution_duration_ms", 0.95)
    return stats.withColumnsRenamed(
        {
            "count": "query_count",
            "mean": "avg_execution_duration_ms",
            "percentile": "p95_execution_duration_ms",
        }
    )


def instance_capacity_p95(
    instance_metrics: DataFrame, keys: Sequence[str] = ("deployment_type", "instance_id")
) -> DataFrame:
    """95th percentile of the running count per instance.

    An instance has one row per five minutes here, so its group is bounded by
    the length of history, not by the number of events.
    """
    return instance_metrics.groupBy(*keys).agg(F.percentile("running_count", 0.95).alias("cap_p95"))


def kpi_buffer(buffer: DataFrame) -> DataFrame:
    """Count, queued share and mean duration of the buffered events."""
    return buffer.agg(
        F.count("*").alias("buffered_events"),
        F.coalesce(F.avg(F.col("queued").cast("int")), F.lit(0.0)).alias("queued_ratio"),
        F.coalesce(F.avg("duration_seconds"), F.lit(0.0)).alias("avg_duration_seconds"),
    )


def kpi_totals(result: DataFrame) -> DataFrame:
    """Row count and total MB of a result."""
    return result.agg(
        F.count("*").alias("row_count"),
        F.sum("scanned_mb").alias("total_scanned_mb"),
        F.sum("spilled_mb").alias("total_spilled_mb"),
    )


def distinct_deployments(df: DataFrame) -> DataFrame:
    return df.select("deployment_type").distinct().orderBy("deployment_type")


def count_events(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("event_count"))
