"""Telemetry out of the ``events`` table, in Spark and in DuckDB.

The expressions below are valid in both, so the two sides of a comparison
start from the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidegauge.operators.clean import clean_enrich, derive_dataset_type
from tidegauge.storage import require_utc

_K = "cast(regexp_extract(props, '([0-9]+)', 1) as int)"

# Canonical measures and names of one event.
_CLEAN = {
    "query_id": "'q' || cast(event_id % 997 as string)",
    "deployment_type": (
        "case when event_type in ('click', 'view') then 'provisioned' "
        "when event_type in ('purchase', 'signup') then 'serverless' else 'unknown' end"
    ),
    "instance_id": "case when event_id % 50 = 0 then null else 'i-' || cast(user_id % 20 as string) end",
    "arrival_timestamp": "ts",
    "queue_duration_ms": "cast(case when k < 50 then 0 else (k - 50) * 100 end as bigint)",
    "compile_duration_ms": "cast((event_id % 30) * 10 as bigint)",
    "execution_duration_ms": "cast(case when event_id % 40 = 0 then 0 else floor(value * 10000) end as bigint)",
    "scanned_mb": "value * 10",
    "spilled_mb": "case when k % 3 = 0 then value else 0 end",
}
_RUN_ID = "'run-' || cast(event_id % 3 as string)"

# Text columns under alias names, with blanks, junk, negatives and NaN.
_DIRTY = {
    "query_id": (
        "case when event_id % 101 = 0 then '  ' "
        "when event_id % 7 = 0 then ' Q' || cast(event_id % 997 as string) || ' ' "
        "else 'q' || cast(event_id % 997 as string) end"
    ),
    "deployment": (
        "case when event_id % 11 = 0 then ' Serverless ' when event_id % 13 = 0 then 'cluster-x' "
        "when event_id % 17 = 0 then null "
        "when event_type in ('click', 'view') then 'provisioned' else 'serverless' end"
    ),
    "arrival_time": (
        "case when event_id % 31 = 0 then 'not a date' when event_id % 37 = 0 then null "
        "else cast(ts as string) end"
    ),
    "queue_time_ms": (
        "case when event_id % 19 = 0 then '-5' when event_id % 23 = 0 then 'abc' "
        "when event_id % 29 = 0 then '12.7' when event_id % 41 = 0 then 'NaN' "
        "when event_id % 43 = 0 then null else cast(event_id % 500 as string) end"
    ),
    "mbytes_scanned": (
        "case when event_id % 47 = 0 then '-1.5' when event_id % 53 = 0 then 'NaN' "
        "when event_id % 59 = 0 then '' else cast(value as string) end"
    ),
}


def _columns(exprs: dict[str, str]) -> str:
    return ", ".join(f"{e} AS {name}" for name, e in exprs.items())


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    require_utc(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def dealt(df: DataFrame) -> DataFrame:
    """``df`` over all cores: a table of few files or row groups is read by as few tasks."""
    return df.repartition(df.sparkSession.sparkContext.defaultParallelism)


def _source(spark: SparkSession, sf_dir: str, spread: bool) -> DataFrame:
    source = table(spark, sf_dir, "events")
    return dealt(source) if spread else source


def raw_events(spark: SparkSession, sf_dir: str, with_id: bool = False, spread: bool = False) -> DataFrame:
    """Raw rows with canonical names, before cleaning."""
    extra = ["event_id", f"{_RUN_ID} AS run_id"] if with_id else []
    source = _source(spark, sf_dir, spread).selectExpr("*", f"{_K} AS k")
    return source.selectExpr(*extra, *[f"{e} AS {n}" for n, e in _CLEAN.items()])


def events(spark: SparkSession, sf_dir: str, with_id: bool = False, spread: bool = False) -> DataFrame:
    """Canonical events; ``with_id`` adds event_id and run_id, ``spread`` cleans them on all cores."""
    keep = ["event_id", "run_id"] if with_id else []
    return clean_enrich(raw_events(spark, sf_dir, with_id, spread), keep=keep)


def typed_events(spark: SparkSession, sf_dir: str, spread: bool = False) -> DataFrame:
    """Canonical events with ``dataset_type``."""
    return derive_dataset_type(events(spark, sf_dir, spread=spread))


def dirty_events(spark: SparkSession, sf_dir: str, spread: bool = False) -> DataFrame:
    """Raw rows as text, one in ten of them twice with other measures."""
    source = _source(spark, sf_dir, spread)
    columns = ["event_id", *[f"{e} AS {n}" for n, e in _DIRTY.items()]]
    once = source.selectExpr(*columns, "0 AS copy")
    again = source.filter("event_id % 10 = 0").selectExpr(*columns, "1 AS copy")
    again = again.withColumns({"queue_time_ms": F.lit("10"), "mbytes_scanned": F.lit("1.0")})
    return once.unionByName(again)


# --- the same in DuckDB -----------------------------------------------------

_CLEAN_DUCK = {**_CLEAN, "run_id": _RUN_ID, "event_id": "event_id"}

# CTE ``e``: canonical events with event_id, run_id and dataset_type.
E = f"""
e0 AS (SELECT {_columns(_CLEAN_DUCK)} FROM (SELECT *, {_K} AS k FROM events)),
e1 AS (SELECT *, arrival_timestamp + to_milliseconds(queue_duration_ms) AS execution_start_time FROM e0),
e2 AS (SELECT *, execution_start_time + to_milliseconds(compile_duration_ms + execution_duration_ms)
         AS execution_end_time FROM e1),
e AS (SELECT *, (epoch_us(execution_end_time) - epoch_us(execution_start_time)) / 1e6 AS duration_seconds,
         spilled_mb / (CASE WHEN scanned_mb > 0 THEN scanned_mb ELSE 1.0 END) AS spill_pressure,
         queue_duration_ms > 0 AS queued, deployment_type AS dataset_type FROM e2)
"""

# CTE ``r``: the dirty rows.
R = f"""
r AS (
  SELECT event_id, {_columns(_DIRTY)}, 0 AS copy FROM events
  UNION ALL
  SELECT event_id, query_id, deployment, arrival_time, '10' AS queue_time_ms, '1.0' AS mbytes_scanned, 1 AS copy
  FROM (SELECT event_id, {_columns(_DIRTY)} FROM events WHERE event_id % 10 = 0))
"""

# Cleaning steps of the dirty rows, as DuckDB expressions over ``r``.
R_QUERY_ID = "nullif(lower(trim(query_id)), '')"
R_DEPLOYMENT = (
    "CASE WHEN lower(trim(deployment)) IN ('provisioned', 'serverless', 'unknown') "
    "THEN lower(trim(deployment)) ELSE 'unknown' END"
)
R_ARRIVAL = "try_cast(arrival_time AS TIMESTAMP)"
R_QUEUE_RAW = (
    "CASE WHEN isfinite(try_cast(queue_time_ms AS DOUBLE)) "
    "THEN cast(trunc(try_cast(queue_time_ms AS DOUBLE)) AS BIGINT) END"
)
R_SCANNED_RAW = (
    "CASE WHEN NOT isnan(try_cast(mbytes_scanned AS DOUBLE)) THEN try_cast(mbytes_scanned AS DOUBLE) END"
)

# CTE ``c``: the dirty rows cleaned.
C = f"""{R},
c0 AS (
  SELECT event_id, copy, deployment, {R_QUERY_ID} AS query_id, {R_DEPLOYMENT} AS deployment_type,
    {R_ARRIVAL} AS arrival_timestamp, greatest(coalesce({R_QUEUE_RAW}, 0), 0) AS queue_duration_ms,
    greatest(coalesce({R_SCANNED_RAW}, 0.0), 0.0) AS scanned_mb FROM r),
c AS (
  SELECT event_id, copy, deployment, query_id, deployment_type, CAST(NULL AS VARCHAR) AS instance_id, arrival_timestamp,
    queue_duration_ms, CAST(0 AS BIGINT) AS compile_duration_ms, CAST(0 AS BIGINT) AS execution_duration_ms,
    scanned_mb, CAST(0 AS DOUBLE) AS spilled_mb,
    arrival_timestamp + to_milliseconds(queue_duration_ms) AS execution_start_time,
    arrival_timestamp + to_milliseconds(queue_duration_ms) AS execution_end_time,
    CAST(0 AS DOUBLE) AS duration_seconds, CAST(0 AS DOUBLE) AS spill_pressure, queue_duration_ms > 0 AS queued
  FROM c0 WHERE query_id IS NOT NULL AND arrival_timestamp IS NOT NULL)
"""

# CTE ``scored`` after ``e``: the baselines as sums of weighted values, and the scores.
# Blocks of 1000 rows keep the weights within the doubles. What stood before a block is
# the end of the one before it: of what lies further back 0.95 ** 1000 = 5e-23 is left.
_LOCAL = (
    "power(0.95, pos) * sum((CASE WHEN n = 1 THEN 1.0 ELSE 0.05 END) * {x} * power(0.95, -pos)) "
    "OVER (PARTITION BY dataset_type, blk ORDER BY n ROWS UNBOUNDED PRECEDING) AS {b}_local"
)
_BASE = "{b}_local + power(0.95, pos) * coalesce({b}_before, 0.0) AS {b}_baseline"
_SCORE = "{x} / (CASE WHEN {b}_baseline > 0 THEN {b}_baseline ELSE 1.0 END) AS {s}"
_MEASURES = {
    "queue": ("queue_duration_ms", "queue_score"),
    "compile": ("compile_duration_ms", "compile_score"),
    "scan": ("scanned_mb", "scan_score"),
    "spill": ("spilled_mb", "spill_score"),
    "util": ("(execution_duration_ms + scanned_mb + spilled_mb)", "utilization_score"),
}
W = f"""
n AS (SELECT *, row_number() OVER (PARTITION BY dataset_type ORDER BY arrival_timestamp, query_id) AS n FROM e),
placed AS (SELECT *, (n - 1) // 1000 AS blk, (n - 1) % 1000 + 1 AS pos FROM n),
begun AS (SELECT *, {", ".join(_LOCAL.format(x=x, b=b) for b, (x, _) in _MEASURES.items())} FROM placed),
ends AS (SELECT dataset_type AS type, blk + 1 AS next, {", ".join(f"{b}_local AS {b}_before" for b in _MEASURES)} FROM begun WHERE pos = 1000),
baselines AS (SELECT begun.*, {", ".join(_BASE.format(b=b) for b in _MEASURES)}
  FROM begun LEFT JOIN ends ON type = dataset_type AND next = blk),
scored AS (SELECT *, {", ".join(_SCORE.format(x=x, b=b, s=s) for b, (x, s) in _MEASURES.items())} FROM baselines)
"""
