"""Schemas and column lists of the telemetry tables."""

from __future__ import annotations

from pyspark.sql import types as T

# The deployment types that the canonical event accepts.
DEPLOYMENT_TYPES = ("provisioned", "serverless", "unknown")

# The canonical event, and the column lists of the tables made from it.
CANONICAL = T.StructType(
    [
        T.StructField("query_id", T.StringType(), False),
        T.StructField("deployment_type", T.StringType(), False),
        T.StructField("instance_id", T.StringType()),
        T.StructField("arrival_timestamp", T.TimestampType(), False),
        T.StructField("queue_duration_ms", T.LongType(), False),
        T.StructField("compile_duration_ms", T.LongType(), False),
        T.StructField("execution_duration_ms", T.LongType(), False),
        T.StructField("scanned_mb", T.DoubleType(), False),
        T.StructField("spilled_mb", T.DoubleType(), False),
        T.StructField("execution_start_time", T.TimestampType(), False),
        T.StructField("execution_end_time", T.TimestampType(), False),
        T.StructField("duration_seconds", T.DoubleType(), False),
        T.StructField("spill_pressure", T.DoubleType(), False),
        T.StructField("queued", T.BooleanType(), False),
    ]
)
CANONICAL_COLS = CANONICAL.fieldNames()

DURATION_COLS = ["queue_duration_ms", "compile_duration_ms", "execution_duration_ms"]
METRIC_COLS = ["scanned_mb", "spilled_mb"]
TIME_COLS = ["arrival_timestamp", "execution_start_time", "execution_end_time"]

# The live view holds the same fields, times first.
UI_COLS = [
    "query_id",
    "deployment_type",
    "instance_id",
    *TIME_COLS,
    *DURATION_COLS,
    *METRIC_COLS,
    "duration_seconds",
    "spill_pressure",
    "queued",
]

# The staged warehouse table has no derived metrics.
WAREHOUSE_COLS = CANONICAL_COLS[:11]

# The columns of the newest events.
RECENT_COLS = [
    "arrival_timestamp",
    "query_id",
    "deployment_type",
    "instance_id",
    "duration_seconds",
    *DURATION_COLS,
    *METRIC_COLS,
    "spill_pressure",
    "queued",
]

# The scores of an event.
SCORE_COLS = ["queue_score", "compile_score", "scan_score", "spill_score", "utilization_score"]
SCORED_COLS = ["dataset_type", *CANONICAL_COLS, *SCORE_COLS]

# The older event table.
LEGACY = T.StructType(
    [
        T.StructField("query_id", T.LongType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("instance_id", T.LongType()),
        T.StructField("query_type", T.StringType()),
        T.StructField("arrival_timestamp", T.TimestampType()),
        T.StructField("execution_duration_ms", T.LongType()),
        T.StructField("queue_duration_ms", T.LongType()),
        T.StructField("compile_duration_ms", T.DoubleType()),
        T.StructField("mbytes_scanned", T.DoubleType()),
        T.StructField("mbytes_spilled", T.DoubleType()),
        T.StructField("queue_score", T.DoubleType()),
        T.StructField("scan_score", T.DoubleType()),
        T.StructField("spill_score", T.DoubleType()),
        T.StructField("compile_score", T.DoubleType()),
    ]
)

# The names under which exports carry each field; the first
# one present wins.
ALIASES = {
    "query_id": ("query_id", "queryid", "query"),
    "deployment_type": ("deployment_type", "deployment", "cluster_type"),
    "instance_id": ("instance_id", "cluster_identifier", "cluster_id"),
    "arrival_timestamp": ("arrival_timestamp", "arrival_time", "arrived_at"),
    "execution_start_time": ("execution_start_time", "start_time", "exec_start_time"),
    "execution_end_time": ("execution_end_time", "end_time", "exec_end_time"),
    "queue_duration_ms": ("queue_duration_ms", "queue_time_ms", "queue_ms"),
    "compile_duration_ms": ("compile_duration_ms", "compile_time_ms", "compile_ms"),
    "execution_duration_ms": ("execution_duration_ms", "execution_time_ms", "exec_ms"),
    "scanned_mb": ("scanned_mb", "scan_mb", "scanned_megabytes", "mbytes_scanned"),
    "spilled_mb": ("spilled_mb", "spill_mb", "spilled_megabytes", "mbytes_spilled"),
}
