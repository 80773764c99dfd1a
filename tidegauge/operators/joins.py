"""Joins.

No side is forced into memory: without a hint Spark broadcasts a side only
when its measured size is under ``spark.sql.autoBroadcastJoinThreshold``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

INSTANCE_KEYS = ("deployment_type", "instance_id")


def join_capacity(
    instance_metrics: DataFrame, capacity: DataFrame, keys: Sequence[str] = INSTANCE_KEYS
) -> DataFrame:
    """Add ``util``, the running count per unit of capacity (at least 1)."""
    slim = capacity.select(*keys, "cap_p95")
    joined = instance_metrics.join(slim, list(keys), "left")
    divisor = F.greatest(F.coalesce("cap_p95", F.lit(1.0)), F.lit(1.0))
    return joined.withColumn("util", F.col("running_count") / divisor).drop("cap_p95")


def semi_join_keys(df: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """Rows whose key is among ``keys``."""
    return df.join(keys.select(key), key, "left_semi")


def top_keys(df: DataFrame, key: str, measure: str, n: int) -> DataFrame:
    """The ``n`` keys with the largest total of ``measure``."""
    totals = df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.sum(measure).alias("total"))
    return totals.orderBy(F.desc("total"), F.asc(key)).limit(n)


def semi_top_n(df: DataFrame, key: str, measure: str, n: int) -> DataFrame:
    """Rows of the ``n`` keys with the largest total of ``measure``."""
    if n <= 0:
        raise ValueError("n must be > 0")
    return semi_join_keys(df, top_keys(df, key, measure, n), key)


def replace_buckets(
    stored: DataFrame, fresh: DataFrame, keys: str | Sequence[str] = "bucket_start"
) -> DataFrame:
    """``stored`` without the buckets of ``fresh``, then ``fresh``."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    return stored.join(fresh.select(*keys).distinct(), keys, "left_anti").unionByName(fresh)
