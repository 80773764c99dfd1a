"""Clean raw rows and derive the canonical event.

Each step is a function of its own; ``clean_enrich`` chains them. All are
column expressions, so one scan does the whole work without a shuffle, and
they run unchanged on a stream.
"""

from __future__ import annotations

import functools
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tidegauge.functions import numbers, scores, text, times
from tidegauge.operators.validate import computed_once
from tidegauge.schema import (
    ALIASES,
    CANONICAL_COLS,
    DEPLOYMENT_TYPES,
    DURATION_COLS,
    METRIC_COLS,
    TIME_COLS,
)
from tidegauge.settings import CleaningRules
from tidegauge.storage import require_utc


def resolve_aliases(
    df: DataFrame, present_keys: str | None = None, keep: Sequence[str] = ()
) -> DataFrame:
    """Give the 11 raw fields their canonical names; other columns are dropped,
    save those that ``keep`` names.

    A field comes from the first of its names that is *present*; a null there
    does not fall through to the next name. For a table presence is a matter
    of its columns. Rows decoded from JSON may differ, so ``present_keys``
    names an array column that lists each row's own keys.
    """
    present = df.columns
    picked = [*keep, *[_pick(present, field, present_keys).alias(field) for field in ALIASES]]
    return df.select(*picked) if present_keys is None else computed_once(df, picked)


def _pick(present: Sequence[str], field: str, present_keys: str | None) -> Column:
    names = [n for n in ALIASES[field] if n in present]
    if not names:
        return F.lit(None).cast("string")
    if present_keys is None:
        return F.col(names[0])
    picked = F.lit(None).cast("string")
    for name in reversed(names):
        picked = F.when(F.array_contains(present_keys, name), F.col(name)).otherwise(picked)
    return picked


def require_query_id(df: DataFrame) -> DataFrame:
    """Drop rows whose id is missing or blank."""
    return df.filter(text.strip(F.col("query_id").cast("string")) != "")


def normalize_strings(df: DataFrame, rules: CleaningRules = CleaningRules()) -> DataFrame:
    return df.withColumns(
        {c: text.normalize_string(F.col(c), rules.lower_strings) for c in ("query_id", "instance_id")}
    )


def normalize_deployment(df: DataFrame, rules: CleaningRules = CleaningRules()) -> DataFrame:
    """Deployment types outside the allowed ones, or outside the canonical
    contract, become ``unknown``."""
    allowed = tuple(d for d in rules.allowed_deployments if d in DEPLOYMENT_TYPES)
    return df.withColumn("deployment_type", text.normalize_deployment(F.col("deployment_type"), allowed))


def derive_dataset_type(df: DataFrame) -> DataFrame:
    """Add ``dataset_type``, taken from the deployment where it is missing."""
    dataset = F.col("dataset_type") if "dataset_type" in df.columns else F.lit(None)
    deployment = F.col("deployment_type") if "deployment_type" in df.columns else F.lit(None)
    return df.withColumn("dataset_type", text.derive_dataset_type(dataset, deployment))


def coerce_ints(df: DataFrame, cols: Sequence[str] = DURATION_COLS) -> DataFrame:
    schema = df.schema
    return df.withColumns({c: numbers.coerce_int(F.col(c), schema[c].dataType) for c in cols})


def coerce_floats(df: DataFrame, cols: Sequence[str] = METRIC_COLS) -> DataFrame:
    schema = df.schema
    return df.withColumns({c: numbers.coerce_float(F.col(c), schema[c].dataType) for c in cols})


def fill_numeric(df: DataFrame, rules: CleaningRules = CleaningRules()) -> DataFrame:
    fill = rules.numeric_fill or 0.0
    return df.withColumns(
        {c: numbers.fill_numeric(F.col(c), int(fill)) for c in DURATION_COLS}
        | {c: numbers.fill_numeric(F.col(c), float(fill)) for c in METRIC_COLS}
    )


def clip_non_negative(df: DataFrame, rules: CleaningRules = CleaningRules()) -> DataFrame:
    clipped = {}
    if rules.clip_durations:
        clipped |= {c: numbers.clip_non_negative(F.col(c), 0) for c in DURATION_COLS}
    if rules.clip_metrics:
        clipped |= {c: numbers.clip_non_negative(F.col(c), 0.0) for c in METRIC_COLS}
    return df.withColumns(clipped) if clipped else df


def parse_timestamps(df: DataFrame, formats: tuple[str, ...] = ()) -> DataFrame:
    """Read the three times; a row without a valid arrival is dropped."""
    require_utc(df.sparkSession)
    schema = df.schema
    parsed = df.withColumns(
        {c: times.parse_timestamp_utc(F.col(c), schema[c].dataType, formats) for c in TIME_COLS}
    )
    return parsed.filter(F.col("arrival_timestamp").isNotNull())


def derive_start_end(df: DataFrame) -> DataFrame:
    """Where not given: start = arrival + queue, end = start + compile + execution."""
    started = df.withColumn(
        "execution_start_time",
        F.coalesce("execution_start_time", times.add_ms(F.col("arrival_timestamp"), F.col("queue_duration_ms"))),
    )
    compiled = times.add_ms(F.col("execution_start_time"), F.col("compile_duration_ms"))
    return started.withColumn(
        "execution_end_time",
        F.coalesce("execution_end_time", times.add_ms(compiled, F.col("execution_duration_ms"))),
    )


def enforce_time_order(df: DataFrame, rules: CleaningRules = CleaningRules()) -> DataFrame:
    """Lift an end before its start to the start; then move an arrival that
    lies after the end back to the start."""
    if rules.end_after_start:
        df = df.withColumn("execution_end_time", F.greatest("execution_start_time", "execution_end_time"))
    arrival, start, end = (F.col(c) for c in TIME_COLS)
    return df.withColumn("arrival_timestamp", F.when(arrival > end, F.least(arrival, start)).otherwise(arrival))


def enrich_duration(df: DataFrame, rules: CleaningRules = CleaningRules()) -> DataFrame:
    seconds = times.seconds_between(F.col("execution_start_time"), F.col("execution_end_time"))
    value = F.greatest(seconds, F.lit(0.0)) if rules.with_duration else F.lit(0.0)
    return df.withColumn("duration_seconds", value)


def enrich_spill_pressure(df: DataFrame, rules: CleaningRules = CleaningRules()) -> DataFrame:
    pressure = scores.row_spill_pressure(F.col("scanned_mb"), F.col("spilled_mb"))
    return df.withColumn("spill_pressure", pressure if rules.with_spill_pressure else F.lit(0.0))


def enrich_queued(df: DataFrame, rules: CleaningRules = CleaningRules()) -> DataFrame:
    queued = F.col("queue_duration_ms") > 0
    return df.withColumn("queued", queued if rules.with_queue_flag else F.lit(False))


def clean_resolved(
    df: DataFrame,
    rules: CleaningRules = CleaningRules(),
    formats: tuple[str, ...] = (),
    keep: Sequence[str] = (),
    times_given: bool = True,
    from_messages: bool = False,
) -> DataFrame:
    """``clean_enrich`` for rows that bear the canonical names already.

    ``keep`` names further columns to carry through. ``times_given=False``
    says that start and end are derived in every row, ``from_messages=True``
    that all columns had to be decoded anyway, see ``computed_once``.
    """
    df = normalize_deployment(normalize_strings(require_query_id(df), rules), rules)
    df = parse_timestamps(df, formats)
    df = clip_non_negative(fill_numeric(coerce_floats(coerce_ints(df)), rules), rules)
    if from_messages:
        df = computed_once(df, df.columns)
    df = derive_start_end(df)
    if times_given or not rules.clip_durations:
        df = enforce_time_order(df, rules)
    df = enrich_queued(enrich_spill_pressure(enrich_duration(df, rules), rules), rules)
    return _drop_invalid(df, rules).select(*keep, *CANONICAL_COLS)


def _drop_invalid(df: DataFrame, rules: CleaningRules) -> DataFrame:
    """Hold cleaned rows against the canonical contract.

    Only what cleaning under these rules can leave wrong is tested: the filter
    moves down to the scan, where every tested column is computed once more.
    """
    ok = F.col("execution_end_time") <= F.lit(times.LAST_INSTANT).cast("timestamp")
    if not rules.end_after_start:
        ok = ok & (F.col("execution_end_time") >= F.col("execution_start_time"))
        ok = ok & (F.col("arrival_timestamp") <= F.col("execution_end_time"))
    if not rules.clip_durations:
        ok = functools.reduce(lambda a, c: a & (F.col(c) >= 0), DURATION_COLS, ok)
    if not rules.clip_metrics:
        ok = functools.reduce(lambda a, c: a & (F.col(c) >= 0), METRIC_COLS, ok)
    return df.filter(ok)


def clean_enrich(
    df: DataFrame, rules: CleaningRules = CleaningRules(), formats: tuple[str, ...] = (), keep: Sequence[str] = ()
) -> DataFrame:
    """Raw rows under any of their accepted names to valid canonical events."""
    own = {*ALIASES["execution_start_time"], *ALIASES["execution_end_time"]}
    resolved = resolve_aliases(df, keep=keep)
    return clean_resolved(resolved, rules, formats, keep, times_given=not own.isdisjoint(df.columns))
