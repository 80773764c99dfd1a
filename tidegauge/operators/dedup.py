"""Duplicate removal.

One key may own a large share of all rows. Picking one row per key is written
as ``row_number() = 1``, which Spark also applies before the shuffle
(WindowGroupLimit), so a group of copies shrinks to one row per input
partition first.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidegauge.functions.times import int_div
from tidegauge.settings import DedupRules

DEFAULT_KEYS = ("query_id", "arrival_timestamp")


def _require_columns(df: DataFrame, names: Sequence[str]) -> None:
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"no such columns: {', '.join(missing)}")


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each key in ``order``."""
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_place", place).filter(F.col("_place") == 1).drop("_place")


def _ascending(df: DataFrame, names: Sequence[str]) -> list[Column]:
    return [F.col(n).asc_nulls_last() for n in names]


def dedup_exact(df: DataFrame, keys: Sequence[str] = DEFAULT_KEYS) -> DataFrame:
    """One row per key; of several the smallest by the remaining columns."""
    _require_columns(df, keys)
    rest = [c for c in df.columns if c not in keys]
    return first_per_key(df, keys, _ascending(df, rest) or [F.lit(0)])


def dedup_last_wins(
    df: DataFrame, ingest_order: str | Sequence[str], keys: Sequence[str] = DEFAULT_KEYS
) -> DataFrame:
    """One row per key, the last by ``ingest_order``, one column or several."""
    order = [ingest_order] if isinstance(ingest_order, str) else list(ingest_order)
    _require_columns(df, [*keys, *order])
    rest = [c for c in df.columns if c not in (*keys, *order)]
    return first_per_key(df, keys, [*[F.col(c).desc_nulls_last() for c in order], *_ascending(df, rest)])


def dedup_by_rules(df: DataFrame, rules: DedupRules = DedupRules(), event_time: str = "arrival_timestamp") -> DataFrame:
    """``dedup_ttl`` as the rules say; with ``enabled`` off the rows as they are."""
    return dedup_ttl(df, rules.keys, rules.ttl_seconds, event_time) if rules.enabled else df


def latest_version(df: DataFrame, keys: Sequence[str], version: str) -> DataFrame:
    """The row with the newest ``version`` per key."""
    return dedup_last_wins(df, version, keys)


def dedup_ttl(
    df: DataFrame,
    keys: Sequence[str] = DEFAULT_KEYS,
    ttl_seconds: int = 3600,
    event_time: str = "arrival_timestamp",
    block_seconds: int = 300,
) -> DataFrame:
    """Drop a row whose key was seen no more than ``ttl_seconds`` before it.

    A dropped repeat refreshes the clock, so a row stays exactly when the gap
    to the row before it, kept or not, is longer than the time limit. The
    clock is event time. Rows of a key at the same instant count as repeats;
    the smallest by the remaining columns survives.

    A window over the key alone would put a hot key into one task. Here each
    key is cut into time blocks. Every block gets one more row, the last time
    of the key before the block, and the gaps are then taken within blocks.
    """
    _require_columns(df, [*keys, event_time])
    if ttl_seconds <= 0:
        raise ValueError("ttl_seconds must be > 0")
    rows = dedup_exact(df, list(dict.fromkeys([*keys, event_time])))
    if event_time in keys:
        # Rows of one key share their time: every repeat is within the limit.
        return rows

    micros = F.unix_micros(event_time)
    block = int_div(micros - F.pmod(micros, F.lit(block_seconds * 1_000_000)), block_seconds * 1_000_000)
    rows = rows.withColumns({"_at": micros, "_block": block})

    # One row per key and block is at most one per block_seconds of history.
    last = df.select(*keys, micros.alias("_at"), block.alias("_block"))
    last = last.groupBy(*keys, "_block").agg(F.max("_at").alias("_last"))
    before = F.lag("_last").over(Window.partitionBy(*keys).orderBy("_block"))
    carried = last.select(*keys, "_block", before.alias("_at")).filter(F.col("_at").isNotNull())

    both = rows.withColumn("_own", F.lit(True)).unionByName(carried, allowMissingColumns=True)
    previous = F.lag("_at").over(Window.partitionBy(*keys, "_block").orderBy("_at"))
    gap = F.col("_at") - previous
    kept = both.withColumn("_gap", gap).filter(
        F.col("_own") & (F.col("_gap").isNull() | (F.col("_gap") > ttl_seconds * 1_000_000))
    )
    return kept.select(*df.columns)
