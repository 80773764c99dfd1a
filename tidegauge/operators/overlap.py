"""Sharing each query's work over the time buckets that it overlaps.

The interval join needs no join: a query knows from its own start and end
which buckets it meets. Its buckets are generated in the scan's tasks and
combined before the shuffle.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tidegauge.functions import scores
from tidegauge.functions.times import instant, int_div
from tidegauge.operators.timeline import explode_range, spine_bounds


def overlap_join(
    df: DataFrame,
    keep: Sequence[str] | None = None,
    width_minutes: int = 5,
    origin: str | dt.datetime = "first_minute",
) -> DataFrame:
    """One row per query and bucket that properly intersect.

    Strict on both sides: start < bucket_end and end > bucket_start. A query
    of zero length inside a bucket therefore counts with overlap 0, one that
    lies exactly on a boundary does not. Parts before the first bucket are
    outside the spine. ``keep`` limits the columns carried along.

    ``origin`` is ``first_minute`` or ``epoch``, see ``spine_bounds``, which
    costs a pass over arrivals and ends, or the start of the first bucket.
    """
    width = width_minutes * 60_000_000
    start, end = F.unix_micros("execution_start_time"), F.unix_micros("execution_end_time")
    if isinstance(origin, dt.datetime):
        lo = instant(origin)
    else:
        lo = spine_bounds(df, width_minutes, origin).getField("lo")
    keep = list(df.columns if keep is None else keep)

    rows = df.select(*keep, start.alias("_s"), end.alias("_e"), F.unix_micros(lo).alias("_o"))
    # The spine reaches over the last end, so no bucket lies beyond it.
    zero = F.lit(0).cast("bigint")
    first = int_div(F.greatest(F.col("_s") - F.col("_o"), zero), width)
    last = int_div(F.greatest(F.col("_e") - F.col("_o") - 1, zero), width)
    met = explode_range(rows.filter(F.col("_e") > F.col("_o")), first, F.greatest(first, last), "_k")
    from_, to = F.col("_o") + F.col("_k") * width, F.col("_o") + (F.col("_k") + 1) * width
    met = met.filter((F.col("_s") < to) & (F.col("_e") > from_))
    bucket_start, bucket_end = F.timestamp_micros(from_), F.timestamp_micros(to)
    o_start, o_end = F.greatest(F.col("_s"), from_), F.least(F.col("_e"), to)
    # Boundaries of whole milliseconds between the two instants.
    ms = F.unix_millis(F.timestamp_micros(o_end)) - F.unix_millis(F.timestamp_micros(o_start))
    return met.select(
        *keep,
        bucket_start.alias("bucket_start"),
        bucket_end.alias("bucket_end"),
        F.timestamp_micros(o_start).alias("overlap_start"),
        F.timestamp_micros(o_end).alias("overlap_end"),
        ms.alias("overlap_ms"),
    )


def _share(divisor: str) -> Column:
    """The part of a query's work that falls into the bucket."""
    if divisor == "execution":
        return F.when(
            F.col("execution_duration_ms") > 0, F.col("overlap_ms") / F.col("execution_duration_ms")
        ).otherwise(F.lit(0.0))
    if divisor == "interval":
        whole = F.unix_micros("execution_end_time") - F.unix_micros("execution_start_time")
        part = F.unix_micros("overlap_end") - F.unix_micros("overlap_start")
        return scores.ratio_or_zero(part, whole)
    raise ValueError("divisor must be 'execution' or 'interval'")


def _overlap_rollup(df: DataFrame, keys: Sequence[str], divisor: str, origin: str | dt.datetime) -> DataFrame:
    times = ["execution_start_time", "execution_end_time"] if divisor == "interval" else []
    keep = [*keys, *times, "execution_duration_ms", "scanned_mb", "spilled_mb"]
    met = overlap_join(df, keep, origin=origin).withColumn("_share", _share(divisor))
    shared = lambda mb: F.when(F.col("_share") > 0, F.col(mb) * F.col("_share")).otherwise(F.lit(0.0))
    return met.groupBy("bucket_start", *keys).agg(
        F.count("*").alias("running_count"),
        F.sum(shared("scanned_mb")).alias("scanned_mb"),
        F.sum(shared("spilled_mb")).alias("spilled_mb"),
    )


def overlap_rollup_deployment(
    df: DataFrame, divisor: str = "execution", origin: str | dt.datetime = "first_minute"
) -> DataFrame:
    """Running queries and their shares of MB per bucket and deployment.

    A share is overlap over execution time. The interval also spans compile
    time, so the shares of one query may add to more than 1; with
    ``divisor='interval'`` they add to 1. ``queued_count`` is always 0.
    """
    return _with_pressure(_overlap_rollup(df, ["deployment_type"], divisor, origin))


def _with_pressure(sums: DataFrame) -> DataFrame:
    scanned, spilled = F.col("scanned_mb"), F.col("spilled_mb")
    return sums.withColumns(
        {
            "queued_count": F.lit(0).cast("bigint"),
            "spill_pressure": F.when(scanned + spilled != 0, spilled / (scanned + spilled)).otherwise(F.lit(0.0)),
        }
    )


def overlap_rollup_instance(
    df: DataFrame, divisor: str = "execution", origin: str | dt.datetime = "first_minute"
) -> DataFrame:
    """The same per bucket, deployment and instance."""
    return _overlap_rollup(df, ["deployment_type", "instance_id"], divisor, origin)


def extend_overlap(stored: DataFrame, fresh: DataFrame) -> DataFrame:
    """Buckets of ``overlap_rollup_...`` with those of further queries added.

    A query that is still open at the end of what was computed before has its share in the
    later buckets already: they are stored too, and what comes later is added to them. So
    runs over disjoint sets of queries, however their intervals cross, add up to one run
    over all, and a run costs its own queries and the buckets they touch.

    Both sides need one fixed ``origin``: that of the first run, or ``epoch``; the first
    minute of each run would shift the buckets. Buckets that ``fresh`` does not touch are
    left as they are; both sides have the same columns.
    """
    sums = ["running_count", "scanned_mb", "spilled_mb"]
    derived = ["queued_count", "spill_pressure"]
    if set(stored.columns) != set(fresh.columns):
        raise ValueError("stored and fresh buckets must have the same columns")
    keys = [c for c in fresh.columns if c not in (*sums, *derived)]
    added = stored.unionByName(fresh).groupBy(*keys).agg(*[F.sum(c).alias(c) for c in sums])
    out = _with_pressure(added) if "spill_pressure" in fresh.columns else added
    return out.select(*fresh.columns)
