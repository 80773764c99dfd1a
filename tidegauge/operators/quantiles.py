"""Exact percentiles of whole numbers that survive a hot group."""

from __future__ import annotations

import functools
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidegauge.functions.times import int_div


def percentile_stats(
    df: DataFrame, keys: Sequence[str], value: str, fraction: float, block: int = 65536
) -> DataFrame:
    """``count``, ``mean`` and ``percentile`` of a bigint column per group.

    The percentile is exact, linear between neighbours; nulls do not count.
    ``percentile`` keeps all values of a group in one task's memory. Here equal
    values are counted first, so a group shrinks to its distinct values; these
    are cut into blocks of ``block`` consecutive numbers, the blocks' sizes
    tell which of them hold the two wanted ranks, and only those blocks are
    looked into. A window partition thus never exceeds ``block`` rows, or the
    number of blocks that a group has.
    """
    if not 0.0 <= fraction <= 1.0:
        raise ValueError("fraction must be within 0 and 1")
    keys = list(keys)
    rows = df.filter(F.col(value).isNotNull()).select(*keys, F.col(value).alias("_v"))
    counted = rows.groupBy(*keys, "_v").agg(F.count("*").alias("_n"))
    counted = counted.withColumn("_block", int_div(F.col("_v") - F.pmod("_v", F.lit(block)), block))

    weighted = F.sum(F.col("_v").cast("double") * F.col("_n"))
    per_block = counted.groupBy(*keys, "_block").agg(F.sum("_n").alias("_n"), weighted.alias("_total"))
    group = Window.partitionBy(*keys)
    until = F.sum("_n").over(group.orderBy("_block"))
    count = F.sum("_n").over(group)
    placed = per_block.select(
        *keys,
        "_block",
        (until - F.col("_n")).alias("_before"),
        until.alias("_until"),
        count.alias("count"),
        (F.sum("_total").over(group) / count).alias("mean"),
        ((count - 1) * F.lit(float(fraction))).alias("_rank"),
    )
    lower, upper = F.floor("_rank"), F.ceil("_rank")
    wanted = placed.filter(
        ((F.col("_before") <= lower) & (lower < F.col("_until")))
        | ((F.col("_before") <= upper) & (upper < F.col("_until")))
    ).drop("_until")

    # Null keys must meet; that also leaves both sides the same shuffle of
    # ``counted``, which Spark then runs once.
    by = [*keys, "_block"]
    wanted = wanted.withColumnsRenamed({k: f"_w_{k}" for k in by})
    same = functools.reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"_w_{k}")) for k in by])
    inside = counted.join(wanted, same)
    end = F.col("_before") + F.sum("_n").over(Window.partitionBy(*by).orderBy("_v"))
    ranked = inside.withColumns({"_from": end - F.col("_n"), "_to": end})

    def value_at(rank: Column) -> Column:
        return F.max(F.when((F.col("_from") <= rank) & (rank < F.col("_to")), F.col("_v")))

    same_in_group = [F.max(c).alias(c) for c in ("count", "mean", "_rank")]
    ends = ranked.groupBy(*keys).agg(value_at(lower).alias("_lo"), value_at(upper).alias("_hi"), *same_in_group)
    between = (F.col("_rank") - lower) * (F.col("_hi") - F.col("_lo"))
    return ends.select(*keys, "count", "mean", (F.col("_lo") + between).alias("percentile"))
