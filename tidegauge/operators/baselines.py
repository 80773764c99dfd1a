"""Exponentially weighted baselines and the scores against them.

The baseline of a key is b(1) = x(1), b(n) = a x(n) + (1 - a) b(n-1). There are
only two or three keys, so a window per key would put the table into as many
tasks. The recurrence is linear: a stretch of m rows maps the value b before
it to B + (1 - a)^m b, where B is what the stretch gives when started at 0.
So the rows are sorted into ranges (``tidegauge.operators.ordered``), every
range runs the recurrence from 0, and the value that really stood before each
range follows from one summary row per range and key.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from tidegauge.functions.scores import baseline_score
from tidegauge.operators.ordered import RANGE_COL, cut_ranges, scan_ranges

DEFAULT_ALPHA = 0.05

# Score -> the baseline that it compares with.
BASELINE_OF = {
    "queue_score": "queue",
    "compile_score": "compile",
    "scan_score": "scan",
    "spill_score": "spill",
    "utilization_score": "util",
}
BASELINE_COLS = [f"{name}_baseline" for name in BASELINE_OF.values()]


def default_measures() -> dict[str, Column]:
    """Baseline name -> the measure that it smooths."""
    return {
        "queue": F.col("queue_duration_ms"),
        "compile": F.col("compile_duration_ms"),
        "scan": F.col("scanned_mb"),
        "spill": F.col("spilled_mb"),
        "util": F.col("execution_duration_ms") + F.col("scanned_mb") + F.col("spilled_mb"),
    }


def smoothed(values: np.ndarray, starts: np.ndarray, lengths: np.ndarray, seeds: np.ndarray, alpha: float) -> np.ndarray:
    """The recurrence over runs of rows, each from its seed.

    Finite values are smoothed with infinite ones as 0. From its first infinite
    value on a run is infinite, and no number after both infinities or a NaN.
    """
    finite = np.isfinite(values)
    whole = bool(finite.all()) and bool(np.isfinite(seeds).all())
    # One seed row ahead of each run, taken out again afterwards.
    seeded = np.insert(values if whole else np.where(finite, values, 0.0), starts, np.where(np.isfinite(seeds), seeds, 0.0), axis=0)
    run = np.repeat(np.arange(len(starts)), lengths + 1)
    smooth = pd.DataFrame(seeded).groupby(run).ewm(alpha=alpha, adjust=False).mean().to_numpy()
    smooth = np.delete(smooth, starts + np.arange(len(starts)), axis=0)
    if not whole:
        odd = np.insert(np.where(finite, 0.0, values), starts, np.where(np.isfinite(seeds), 0.0, seeds), axis=0)
        with np.errstate(invalid="ignore"):
            smooth = smooth + np.delete(_running_sums(odd, run), starts + np.arange(len(starts)), axis=0)
    return smooth


def _running_sums(values: np.ndarray, run: np.ndarray) -> np.ndarray:
    """Sums of each run's rows so far; infinities and NaN stay."""
    out = np.empty_like(values)
    bounds = [*np.flatnonzero(np.diff(run, prepend=-1)), len(run)]
    for a, b in zip(bounds, bounds[1:]):
        np.cumsum(values[a:b], axis=0, out=out[a:b])
    return out


def _scan_from_zero(key: str, names: Sequence[str], alpha: float):
    """Per range: position within the key's run, and the recurrence from 0."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begun, last_key, last_place = False, None, 0
        last = np.zeros(len(names))
        for batch in batches:
            if batch.num_rows == 0:
                continue
            keys = batch.column(key).to_numpy(zero_copy_only=False)
            values = np.column_stack([batch.column(f"_x_{n}").to_numpy(zero_copy_only=False) for n in names]).astype(float)
            starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
            lengths = np.diff(np.append(starts, len(keys)))

            place = np.arange(len(keys)) - np.repeat(starts, lengths) + 1
            seeds = np.zeros((len(starts), len(names)))
            if begun and keys[0] == last_key:
                place[: lengths[0]] += last_place
                seeds[0] = last
            smooth = smoothed(values, starts, lengths, seeds, alpha)

            begun, last_key, last_place, last = True, keys[-1], int(place[-1]), smooth[-1]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(place, pa.int64()), *[pa.array(c) for c in smooth.T]],
                [*batch.schema.names, "_place", *[f"_p_{n}" for n in names]],
            )

    return step


def _carry_over(key: str, names: Sequence[str], alpha: float):
    """Per key: walk its range summaries in order, note the value before each."""

    def fold(ranges: pd.DataFrame) -> pd.DataFrame:
        ranges = ranges.sort_values(RANGE_COL)
        before = []
        value = ranges[[f"_s_{n}" for n in names]].iloc[0].to_numpy(dtype=float)
        # Without a stored value start at the first x: a x + (1 - a) x = x.
        first = ranges[[f"_x_{n}" for n in names]].iloc[0].to_numpy(dtype=float)
        value = np.where(ranges["_known"].iloc[0], value, first)
        ends = ranges[[f"_p_{n}" for n in names]].to_numpy(dtype=float)
        for size, end in zip(ranges["_size"], ends):
            before.append(value)
            decay = (1.0 - alpha) ** size
            with np.errstate(invalid="ignore"):
                value = end + np.where(np.isfinite(value), decay * np.where(np.isfinite(value), value, 0.0), value)
        # The value after the last range goes under the null range.
        before.append(value)
        out = pd.DataFrame(before, columns=[f"_c_{n}" for n in names])
        out.insert(0, RANGE_COL, [*ranges[RANGE_COL].astype(int), None])
        out.insert(0, key, ranges[key].iloc[0])
        return out

    return fold


def baselines_and_state(
    df: DataFrame,
    key: str = "dataset_type",
    measures: dict[str, Column] | None = None,
    alpha: float = DEFAULT_ALPHA,
    order: Sequence[str] = ("arrival_timestamp", "query_id"),
    state: DataFrame | None = None,
    keep: Sequence[str] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """``ewma_baselines``, and the baselines after the last row of each key.

    The second result can be the ``state`` for the rows that follow.
    """
    if not 0.0 < alpha <= 1.0:
        raise ValueError("alpha must be above 0 and at most 1")
    measures = default_measures() if measures is None else measures
    names = list(measures)
    keep = list(df.columns if keep is None else keep)
    by = [key, *order]
    xs = [m.cast("double").alias(f"_x_{n}") for n, m in measures.items()]
    measured = df.select(*dict.fromkeys([*keep, *by]), *xs)
    # Rows equal in all of these are interchangeable here, so no other column is read for the order.
    ties = [f"_x_{n}" for n in names]
    ranges = cut_ranges(measured, by, ties)
    step = _scan_from_zero(key, names, alpha)
    added = [T.StructField("_place", T.LongType()), *[T.StructField(f"_p_{n}", T.DoubleType()) for n in names]]

    # First pass, narrow: at most one row per range plus one per key, however hot a key is.
    narrow = scan_ranges(measured.select(*dict.fromkeys([*by, *ties])), ranges, step, added)
    summary = narrow.groupBy(key, RANGE_COL).agg(
        F.max("_place").alias("_size"),
        *[F.min_by(f"_x_{n}", "_place").alias(f"_x_{n}") for n in names],
        *[F.max_by(f"_p_{n}", "_place").alias(f"_p_{n}") for n in names],
    )
    if state is None:
        summary = summary.withColumns({**{f"_s_{n}": F.lit(None).cast("double") for n in names}, "_known": F.lit(False)})
    else:
        stored = state.select(
            F.col(key).alias("_key"), F.lit(True).alias("_has"), *[F.col(f"{n}_baseline").alias(f"_s_{n}") for n in names]
        )
        summary = summary.join(stored, F.col(key).eqNullSafe(F.col("_key")), "left")
        summary = summary.withColumn("_known", F.coalesce("_has", F.lit(False))).drop("_key", "_has")
    schema = T.StructType(
        [
            df.schema[key],
            T.StructField(RANGE_COL, T.IntegerType()),
            *[T.StructField(f"_c_{n}", T.DoubleType()) for n in names],
        ]
    )
    carried = summary.groupBy(key).applyInPandas(_carry_over(key, names, alpha), schema)

    # Second pass, with all columns: each range starts from what stood before it.
    before = carried.filter(F.col(RANGE_COL).isNotNull()).select(
        F.col(key).alias("_key"), F.col(RANGE_COL).alias("_in"), *[f"_c_{n}" for n in names]
    )
    scanned = scan_ranges(measured, ranges, step, added)
    joined = scanned.join(before, F.col(key).eqNullSafe(F.col("_key")) & (F.col(RANGE_COL) == F.col("_in")))
    rows = joined.select(*keep, *[_continued(n, alpha).alias(f"{n}_baseline") for n in names])
    after = carried.filter(F.col(RANGE_COL).isNull()).select(
        key, *[F.col(f"_c_{n}").alias(f"{n}_baseline") for n in names]
    )
    return rows, after


def _continued(name: str, alpha: float) -> Column:
    """The recurrence from 0 plus what is left of the value before; infinities do not decay."""
    before = F.col(f"_c_{name}")
    lasting = F.isnan(before) | (F.abs(before) == float("inf"))
    left = F.when(lasting, before).otherwise(F.pow(F.lit(1.0 - alpha), F.col("_place")) * before)
    return F.col(f"_p_{name}") + left


def ewma_baselines(
    df: DataFrame,
    key: str = "dataset_type",
    measures: dict[str, Column] | None = None,
    alpha: float = DEFAULT_ALPHA,
    order: Sequence[str] = ("arrival_timestamp", "query_id"),
    state: DataFrame | None = None,
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """Add ``<name>_baseline`` per measure, the current row included.

    Rows of a key follow ``order``; the result does not depend on the input's
    layout. ``keep`` limits the columns carried along (default: all). ``state`` (key
    and one ``<name>_baseline`` each) continues earlier rows, as a stream does between
    its batches. ``key`` must not be null.
    """
    return baselines_and_state(df, key, measures, alpha, order, state, keep)[0]


def baseline_scores(df: DataFrame) -> DataFrame:
    """The five scores: each measure over its baseline."""
    measures = default_measures()
    scored = df.withColumns(
        {s: baseline_score(measures[n].cast("double"), F.col(f"{n}_baseline")) for s, n in BASELINE_OF.items()}
    )
    return scored.drop(*BASELINE_COLS)


def scored_events(df: DataFrame, alpha: float = DEFAULT_ALPHA, state: DataFrame | None = None) -> DataFrame:
    """Canonical events with ``dataset_type`` to scored events."""
    return baseline_scores(ewma_baselines(df, alpha=alpha, state=state))
