"""Time spine, replay arithmetic and time filters."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidegauge.functions import times
from tidegauge.operators.ordered import ORDER_COL, RANGE_COL, cut_ranges


#: A generator's array holds at most this many numbers; longer runs are generated in two steps.
CHUNK = 4096


def _as_timestamp(value: Column | dt.datetime | str | None) -> Column:
    return F.current_timestamp() if value is None else times.instant(value)


def explode_range(df: DataFrame, first: Column, last: Column, name: str) -> DataFrame:
    """``df`` with one row per whole number from ``first`` through ``last``.

    A run is generated in chunks: a row makes one array of the chunks' starts, and one of
    at most ``CHUNK`` numbers per chunk.
    """
    runs = df.withColumns({"_first": first, "_last": last}).filter(F.col("_last") >= F.col("_first"))
    begun = runs.withColumn("_begin", F.explode(F.sequence("_first", "_last", F.lit(CHUNK).cast("bigint"))))
    out = begun.withColumn(name, F.explode(F.sequence("_begin", F.least(F.col("_begin") + CHUNK - 1, F.col("_last")))))
    return out.drop("_first", "_last", "_begin")


def spine_bounds(df: DataFrame, width_minutes: int = 5, origin: str = "first_minute") -> Column:
    """Scalar subquery ``{lo, hi}``: first bucket start and last covered minute.

    ``first_minute`` starts the buckets at the minute of the earliest arrival,
    ``epoch`` on a multiple of the width.
    """
    if origin not in ("first_minute", "epoch"):
        raise ValueError("origin must be 'first_minute' or 'epoch'")
    first = F.min("arrival_timestamp")
    lo = times.bucket_minute(first) if origin == "first_minute" else times.bucket_n_minutes(first, width_minutes)
    hi = times.bucket_minute(F.max("execution_end_time"))
    return df.agg(F.struct(lo.alias("lo"), hi.alias("hi")).alias("bounds")).scalar()


def time_spine(df: DataFrame, width_minutes: int = 5, origin: str = "first_minute") -> DataFrame:
    """All consecutive buckets from the first arrival to the last end."""
    width = width_minutes * 60_000_000
    bounds = df.sparkSession.range(1).select(spine_bounds(df, width_minutes, origin).alias("b"))
    lo, hi = F.unix_micros("b.lo"), F.unix_micros("b.hi")
    numbered = explode_range(
        bounds.select(lo.alias("_lo"), hi.alias("_hi")).filter(F.col("_lo").isNotNull()),
        F.lit(0).cast("bigint"),
        times.int_div(F.col("_hi") - F.col("_lo"), width),
        "_k",
    )
    start = F.col("_lo") + F.col("_k") * width
    return numbered.select(
        F.timestamp_micros(start).alias("bucket_start"), F.timestamp_micros(start + width).alias("bucket_end")
    )


def spine_missing(spine: DataFrame, stored: DataFrame) -> DataFrame:
    """The buckets of ``spine`` that ``stored`` does not have yet."""
    return spine.join(stored.select("bucket_start"), "bucket_start", "left_anti")


def scale_event_time(
    df: DataFrame, factor: float, anchor_event: Column, anchor_wall: Column, event_time: str = "arrival_timestamp"
) -> DataFrame:
    wall = times.scale_event_time(F.col(event_time), factor, anchor_event, anchor_wall)
    return df.withColumn("wall_time", wall)


def replay_delay(df: DataFrame, factor: float, event_time: str = "arrival_timestamp") -> DataFrame:
    """``delay_seconds`` to wait before each row when replaying in time order.

    Order is event time, then query id. Building the query takes a sample of the
    sort keys; see ``tidegauge.operators.ordered``.
    """
    if factor <= 0:
        raise ValueError("factor must be > 0")
    stamped = df.withColumn("_at", F.unix_micros(event_time))
    # Ranges are dealt out by a hash of their number; several per task even that out.
    ranges = cut_ranges(stamped, [event_time, "query_id"], per_partition=4)
    # The last arrival of each range, handed to the next one: a row per range.
    lasts = ranges.number(stamped.select(event_time, "query_id", "_at", *ranges.ties)).groupBy(RANGE_COL).agg(F.max("_at").alias("_last"))
    before = lasts.select(RANGE_COL, F.lag("_last").over(Window.orderBy(RANGE_COL)).alias("_before"))
    joined = ranges.number(stamped).join(F.broadcast(before), RANGE_COL)
    in_range = F.lag("_at").over(Window.partitionBy(RANGE_COL).orderBy(ORDER_COL))
    gap = F.col("_at") - F.coalesce(in_range, "_before", "_at")
    seconds = F.greatest(gap, F.lit(0)) / F.lit(1e6) / F.lit(float(factor))
    return joined.select(*df.columns, seconds.alias("delay_seconds"))


def replay_offset(df: DataFrame, factor: float, event_time: str = "arrival_timestamp") -> DataFrame:
    """``target_seconds`` after the replay's start at which each row is due."""
    if factor <= 0:
        raise ValueError("factor must be > 0")
    first = df.agg(F.min(event_time).alias("first")).scalar()
    due = times.seconds_between(first, F.col(event_time)) / F.lit(float(factor))
    return df.withColumn("target_seconds", F.greatest(due, F.lit(0.0)))


def filter_last(
    df: DataFrame, minutes: int, as_of: Column | dt.datetime | str | None = None, time_col: str = "arrival_timestamp"
) -> DataFrame:
    """Rows of the last ``minutes`` before ``as_of`` (default: now)."""
    return df.filter(F.col(time_col) >= _as_timestamp(as_of) - F.make_dt_interval(mins=F.lit(minutes)))


def filter_anchored(df: DataFrame, minutes: int, time_col: str = "arrival_timestamp") -> DataFrame:
    """Rows of the last ``minutes`` before the newest row, both ends included."""
    newest = df.agg(F.max(time_col).alias("newest")).scalar()
    return df.filter(F.col(time_col) >= newest - F.make_dt_interval(mins=F.lit(minutes)))


def filter_date_range(
    df: DataFrame, start: dt.date, end: dt.date, time_col: str = "arrival_timestamp"
) -> DataFrame:
    """Rows from the ``start`` day through the ``end`` day."""
    if start > end:
        raise ValueError("start date must not be after end date")
    # Bare column against constants, so the range reaches the Parquet scan.
    first = dt.datetime.combine(start, dt.time(), dt.timezone.utc)
    beyond = dt.datetime.combine(end + dt.timedelta(days=1), dt.time(), dt.timezone.utc)
    return df.filter((F.col(time_col) >= F.lit(first)) & (F.col(time_col) < F.lit(beyond)))


def filter_deployment(df: DataFrame, deployment: str | None = "all") -> DataFrame:
    if deployment is None or deployment in ("", "all"):
        return df
    return df.filter(F.col("deployment_type") == deployment)
