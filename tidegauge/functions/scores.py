"""Ratios, pressures and scores."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def ratio_or_zero(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))


def clamp_unit(c: Column) -> Column:
    return F.least(F.greatest(c, F.lit(0.0)), F.lit(1.0))


def row_spill_pressure(scanned: Column, spilled: Column) -> Column:
    """Spilled per scanned MB; a query that scanned nothing counts as one MB."""
    pressure = spilled / F.when(scanned > 0, scanned).otherwise(F.lit(1.0))
    return F.greatest(F.nanvl(pressure, F.lit(0.0)), F.lit(0.0))


def baseline_score(value: Column, baseline: Column) -> Column:
    return value / F.when(baseline > 0, baseline).otherwise(F.lit(1.0))


def pressure_level(spill_pressure: Column, queue_pressure: Column) -> Column:
    worst = F.greatest(spill_pressure, queue_pressure)
    return F.when(worst > 0.6, "HIGH").when(worst > 0.3, "MEDIUM").otherwise("LOW")


def pressure_score(queue: Column, compile_: Column, spill: Column) -> Column:
    return F.lit(0.35) * queue + F.lit(0.20) * compile_ + F.lit(0.45) * spill
