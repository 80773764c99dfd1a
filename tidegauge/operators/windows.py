"""Window operators over bucket tables, whose groups are bounded by time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from tidegauge.operators.joins import INSTANCE_KEYS


def rolling_median_residual(
    util: DataFrame, keys: Sequence[str] = INSTANCE_KEYS, buckets: int = 12
) -> DataFrame:
    """Predict ``util`` by the median of the ``buckets`` rows before, and the
    difference to it; both null for the first row of an instance."""
    before = Window.partitionBy(*keys).orderBy("bucket_start").rowsBetween(-buckets, -1)
    predicted = util.withColumn("util_pred", F.percentile("util", 0.5).over(before))
    return predicted.withColumn("util_residual", F.col("util") - F.col("util_pred"))


def latest_per_group(df: DataFrame, keys: Sequence[str], time_col: str = "window_start") -> DataFrame:
    """The rows at each group's latest time, ties kept.

    Groups are few and may be large, so the latest time is aggregated (one
    partial row per group and input partition) and joined back on keys and
    time, instead of a window that holds a whole group in one task.
    """
    keys = list(keys)
    latest = df.groupBy(*keys).agg(F.max(time_col).alias(time_col))
    same = [df[k].eqNullSafe(latest[k]) for k in [*keys, time_col]]
    return df.join(latest, same, "left_semi")


def latest_util(util: DataFrame, keys: Sequence[str] = INSTANCE_KEYS) -> DataFrame:
    """``util`` at the newest bucket of each instance."""
    return util.groupBy(*keys).agg(F.max_by("util", "bucket_start").alias("util_latest"))
