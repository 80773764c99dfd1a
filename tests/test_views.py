from datetime import datetime, timedelta

from pyspark.sql import functions as F

from tidegauge.operators import overlap, rollups, views
from tidegauge.operators.baselines import scored_events


def test_views_answer_sql(spark, make_events):
    at = lambda m: {"arrival_timestamp": datetime(2024, 1, 1) + timedelta(minutes=m)}
    events = make_events([at(0), at(0), at(6), at(20)])
    views.create_event_views(events)
    views.create_score_views(scored_events(events.withColumn("dataset_type", F.col("deployment_type"))))
    views.create_bucket_views(
        overlap.overlap_rollup_deployment(events).withColumnRenamed("bucket_start", "window_start"),
        overlap.overlap_rollup_instance(events).withColumnRenamed("bucket_start", "window_start"),
    )
    metrics = rollups.instance_metrics_5min(events)
    views.create_utilisation_views(metrics, rollups.instance_capacity_p95(metrics))
    ask = lambda sql: [tuple(r) for r in spark.sql(sql).collect()]
    assert ask("SELECT query_count FROM v_rollups_minute ORDER BY window_start") == [(2,), (1,), (1,)]
    assert ask("SELECT count(*) FROM v_rollups_5min") == [(3,)]
    assert ask("SELECT processed_rows FROM pipeline_status") == [(4,)]
    assert ask("SELECT query_id FROM v_query_metrics_processed_latest LIMIT 1") == [("q3",)]
    assert ask("SELECT count(*) FROM v_recent_processed") == [(4,)]
    assert ask("SELECT count(*) FROM v_top_problem_queries WHERE pressure_score >= 0") == [(4,)]
    assert ask("SELECT running_count FROM v_deployment_5m_latest") == [(1,)]
    assert ask("SELECT count(*) FROM v_instance_5m_history") == [(3,)]
    assert ask("SELECT util_pred IS NULL FROM instance_util_pred_5min ORDER BY bucket_start LIMIT 1") == [(True,)]
    assert len(ask("SELECT util_latest FROM instance_top_active")) == 1
