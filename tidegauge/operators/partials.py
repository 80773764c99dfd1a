"""Minute rollups in parts that can be added up: of batches, files or increments.

A partial row has a count, sums and a quantile sketch of its rows. Partials of disjoint
rows merge into the partial of them all, in any order, so a new batch costs its own rows
and the partial rows of the minutes it touches, never the events behind them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from tidegauge.functions import times

KEYS = ("window_start", "deployment_type")
SUMS = {"duration": "duration_seconds", "spill_pressure": "spill_pressure", "queued": "queued"}
#: Accuracy of the sketches: at this size a rank is off by less than 1.65 % (99 % of the time), and a minute of up to as many rows is exact.
SKETCH_K = 200


def minute_partials(df: DataFrame, keys: Sequence[str] = ("deployment_type",)) -> DataFrame:
    """Partial rollups of canonical events by minute and ``keys``."""
    minute = times.bucket_minute(F.col("arrival_timestamp")).alias("window_start")
    return df.groupBy(minute, *keys).agg(
        F.count("*").alias("n"),
        *[F.sum(F.col(c).cast("double")).alias(f"sum_{name}") for name, c in SUMS.items()],
        F.kll_sketch_agg_bigint("execution_duration_ms", F.lit(SKETCH_K)).alias("execution_sketch"),
    )


def merge_partials(partials: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """One partial row per key."""
    return partials.groupBy(*keys).agg(
        F.sum("n").alias("n"),
        *[F.sum(f"sum_{name}").alias(f"sum_{name}") for name in SUMS],
        F.kll_merge_agg_bigint("execution_sketch", F.lit(SKETCH_K)).alias("execution_sketch"),
    )


def finished(partials: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """The columns of ``rollup_minute`` out of merged partials."""
    mean = lambda name: F.col(f"sum_{name}") / F.col("n")
    return partials.select(
        *keys,
        F.col("n").alias("query_count"),
        mean("duration").alias("avg_duration_seconds"),
        mean("spill_pressure").alias("avg_spill_pressure"),
        mean("queued").alias("queued_ratio"),
    )


def with_percentile(partials: DataFrame, share: float = 0.95, keys: Sequence[str] = KEYS) -> DataFrame:
    """Count and an approximate percentile of the execution time, out of merged partials.

    The value's rank is within 1.65 % of the wanted one; the exact form is ``rollup_p95``.
    """
    return partials.select(
        *keys,
        F.col("n").alias("query_count"),
        F.kll_sketch_get_quantile_bigint("execution_sketch", F.lit(share)).alias("percentile_execution_duration_ms"),
    )
