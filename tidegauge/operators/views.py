"""The library's questions as temporary views, for use from SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tidegauge.operators import joins, reports, rollups, windows


# The names of the views below are fixed values.


def create_event_views(events: DataFrame) -> None:
    """``query_metrics_processed``, and its rollups, newest rows and status."""
    for name, view in {
        "query_metrics_processed": events,
        "v_rollups_minute": rollups.rollup_minute(events),
        "v_rollups_5min": rollups.rollup_5min(events),
        "v_query_metrics_processed_latest": reports.recent_events(events, 500),
        "pipeline_status": rollups.pipeline_status(events),
    }.items():
        view.createOrReplaceTempView(name)


def create_score_views(scored: DataFrame) -> None:
    reports.recent_scored(scored).createOrReplaceTempView("v_recent_processed")
    reports.problem_queries(scored).createOrReplaceTempView("v_top_problem_queries")


def create_bucket_views(deployment_buckets: DataFrame, instance_buckets: DataFrame) -> None:
    """History and latest state of stored bucket tables (``window_start``)."""
    deployment_buckets.createOrReplaceTempView("v_deployment_5m_history")
    latest = windows.latest_per_group(deployment_buckets, ["deployment_type"])
    latest.createOrReplaceTempView("v_deployment_5m_latest")
    instance_buckets.createOrReplaceTempView("v_instance_5m_history")


def create_utilisation_views(instance_metrics: DataFrame, capacity: DataFrame) -> None:
    """Predicted and latest utilisation out of stored instance metrics (``bucket_start``)."""
    util = joins.join_capacity(instance_metrics, capacity)
    windows.rolling_median_residual(util).createOrReplaceTempView("instance_util_pred_5min")
    windows.latest_util(util).createOrReplaceTempView("instance_top_active")
