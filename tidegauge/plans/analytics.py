"""Registered queries: time, aggregates, joins, windows, scores and reports."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tidegauge.functions import times
from tidegauge.operators import baselines, joins, overlap, partials, reports, rollups, timeline, windows
from tidegauge.plans.ingest import sql_cols
from tidegauge.plans.mapping import E, W, events, table, typed_events
from tidegauge.plans.registry import register
from tidegauge.plans.scratch import write_and_read
from tidegauge.schema import CANONICAL_COLS, RECENT_COLS, SCORE_COLS

AS_OF = "2024-01-28 06:30:00"
STATS = """count(*) AS query_count, round(avg(duration_seconds), 6) AS avg_duration_seconds,
  round(avg(spill_pressure), 6) AS avg_spill_pressure,
  round(avg(CASE WHEN queued THEN 1 ELSE 0 END), 6) AS queued_ratio"""
MINUTE = "date_trunc('minute', arrival_timestamp)"
HOUR = "date_trunc('hour', arrival_timestamp)"
FIVE = "make_timestamp(epoch_us(arrival_timestamp) - epoch_us(arrival_timestamp) % 300000000)"
IDS = [f"i-{n}" for n in range(20)]
DEPLOYMENTS = ["provisioned", "serverless", "unknown"]

# --- time -------------------------------------------------------------------


@register("T1_bucket_minute_hour", f"WITH {E} SELECT event_id, {MINUTE} AS minute, {HOUR} AS hour FROM e")
def _(spark, sf_dir):
    at = F.col("arrival_timestamp")
    rows = events(spark, sf_dir, with_id=True)
    return rows.select("event_id", times.bucket_minute(at).alias("minute"), times.bucket_hour(at).alias("hour"))


@register(
    "T2_bucket_n_minutes",
    f"""WITH {E} SELECT event_id, {FIVE} AS five,
      make_timestamp(epoch_us(arrival_timestamp) - epoch_us(arrival_timestamp) % 420000000) AS seven,
      {HOUR} + to_minutes(minute(arrival_timestamp) // 7 * 7) AS seven_hourly FROM e""",
)
def _(spark, sf_dir):
    at = F.col("arrival_timestamp")
    return events(spark, sf_dir, with_id=True).select(
        "event_id",
        times.bucket_n_minutes(at, 5).alias("five"),
        times.bucket_n_minutes(at, 7).alias("seven"),
        times.bucket_n_minutes(at, 7, restart_hourly=True).alias("seven_hourly"),
    )


SPINE = """
b AS (SELECT date_trunc('minute', min(arrival_timestamp)) AS lo,
        date_trunc('minute', max(execution_end_time)) AS hi FROM e),
spine AS (SELECT s AS bucket_start, s + INTERVAL 5 MINUTE AS bucket_end
          FROM (SELECT unnest(generate_series(lo, hi, INTERVAL 5 MINUTE)) AS s FROM b))
"""


@register("T3_time_spine", f"WITH {E}, {SPINE} SELECT bucket_start, bucket_end FROM spine")
def _(spark, sf_dir):
    return timeline.time_spine(events(spark, sf_dir))


@register(
    "T4_spine_missing",
    f"""WITH {E}, lo AS (SELECT min({FIVE}) AS lo, date_trunc('minute', max(execution_end_time)) AS hi FROM e),
    s AS (SELECT unnest(generate_series(lo, hi, INTERVAL 5 MINUTE)) AS bucket_start FROM lo)
    SELECT bucket_start, bucket_start + INTERVAL 5 MINUTE AS bucket_end FROM s
    WHERE bucket_start NOT IN (SELECT {FIVE} FROM e)""",
)
def _(spark, sf_dir):
    rows = events(spark, sf_dir)
    return timeline.spine_missing(timeline.time_spine(rows, origin="epoch"), rollups.system_metrics_5min(rows))


@register(
    "T5_scale_event_time",
    f"""WITH {E} SELECT event_id, make_timestamp(epoch_us(TIMESTAMP '2025-01-01 00:00:00')
      + cast(round_even((epoch_us(arrival_timestamp) - epoch_us(TIMESTAMP '2024-01-01 00:00:00')) / 50.0, 0) AS BIGINT))
      AS wall_time FROM e""",
)
def _(spark, sf_dir):
    event, wall = (F.lit(d).cast("timestamp") for d in ("2024-01-01 00:00:00", "2025-01-01 00:00:00"))
    rows = events(spark, sf_dir, with_id=True)
    return timeline.scale_event_time(rows, 50, event, wall).select("event_id", "wall_time")


@register(
    "T6_replay_delay",
    f"""WITH {E}, g AS (SELECT event_id, epoch_us(arrival_timestamp) - lag(epoch_us(arrival_timestamp))
        OVER (ORDER BY arrival_timestamp, query_id) AS gap FROM e)
    SELECT event_id, round(greatest(coalesce(gap, 0), 0) / 1e6 / 50, 8) AS delay_seconds FROM g""",
    decimals=8,  # whole hundredths of a microsecond
)
def _(spark, sf_dir):
    return timeline.replay_delay(events(spark, sf_dir, with_id=True), 50).select("event_id", "delay_seconds")


@register(
    "T6_replay_offset",
    f"""WITH {E} SELECT event_id, round((epoch_us(arrival_timestamp)
      - (SELECT min(epoch_us(arrival_timestamp)) FROM e)) / 1e6 / 50, 8) AS target_seconds FROM e""",
    decimals=8,
)
def _(spark, sf_dir):
    return timeline.replay_offset(events(spark, sf_dir, with_id=True), 50).select("event_id", "target_seconds")


@register(
    "T7_filter_last",
    f"""WITH {E} SELECT {sql_cols(CANONICAL_COLS)} FROM e
    WHERE arrival_timestamp >= TIMESTAMP '{AS_OF}' - INTERVAL 7 DAY""",
)
def _(spark, sf_dir):
    return timeline.filter_last(events(spark, sf_dir), 7 * 24 * 60, AS_OF)


@register(
    "T8_filter_anchored",
    f"""WITH {E} SELECT {sql_cols(CANONICAL_COLS)} FROM e
    WHERE arrival_timestamp >= (SELECT max(arrival_timestamp) FROM e) - INTERVAL 600 MINUTE""",
)
def _(spark, sf_dir):
    return timeline.filter_anchored(events(spark, sf_dir), 600)


@register(
    "T9_filter_date_range",
    f"""WITH {E} SELECT {sql_cols(CANONICAL_COLS)} FROM e
    WHERE cast(arrival_timestamp AS DATE) BETWEEN DATE '2024-01-05' AND DATE '2024-01-09'""",
)
def _(spark, sf_dir):
    return timeline.filter_date_range(events(spark, sf_dir), dt.date(2024, 1, 5), dt.date(2024, 1, 9))


@register(
    "T10_filter_deployment", f"WITH {E} SELECT {sql_cols(CANONICAL_COLS)} FROM e WHERE deployment_type = 'serverless'"
)
def _(spark, sf_dir):
    return timeline.filter_deployment(timeline.filter_deployment(events(spark, sf_dir), "all"), "serverless")


# --- aggregates -------------------------------------------------------------


@register("A1_rollup_minute", f"WITH {E} SELECT {MINUTE} AS window_start, deployment_type, {STATS} FROM e GROUP BY 1, 2")
def _(spark, sf_dir):
    return rollups.rollup_minute(events(spark, sf_dir))


@register("A2_rollup_5min", f"WITH {E} SELECT {FIVE} AS window_start, deployment_type, {STATS} FROM e GROUP BY 1, 2")
def _(spark, sf_dir):
    return rollups.rollup_5min(events(spark, sf_dir))


@register(
    "A3_rollup_hour_history",
    f"""WITH {E} SELECT {HOUR} AS window_start, deployment_type, {STATS} FROM e
    WHERE arrival_timestamp >= TIMESTAMP '{AS_OF}' - INTERVAL 7 DAY GROUP BY 1, 2""",
)
def _(spark, sf_dir):
    return rollups.rollup_hour_history(events(spark, sf_dir), AS_OF)


@register(
    "A3_rollup_hour_between",
    f"""WITH {E} SELECT {HOUR} AS window_start, deployment_type, {STATS}, round(sum(scanned_mb), 6) AS scanned_mb,
      round(sum(spilled_mb), 6) AS spilled_mb FROM e
    WHERE cast(arrival_timestamp AS DATE) BETWEEN DATE '2024-01-03' AND DATE '2024-01-20'
      AND deployment_type = 'provisioned' GROUP BY 1, 2""",
)
def _(spark, sf_dir):
    days = dt.date(2024, 1, 3), dt.date(2024, 1, 20)
    return rollups.rollup_hour_between(events(spark, sf_dir), *days, "provisioned")


@register("A4_rollup_incremental", f"WITH {E} SELECT {MINUTE} AS window_start, deployment_type, {STATS} FROM e GROUP BY 1, 2")
def _(spark, sf_dir):
    # Stored: all minutes as they stood at noon of the 20th, the last one half full.
    rows = events(spark, sf_dir)
    stored = rollups.rollup_minute(rows.filter("arrival_timestamp < timestamp'2024-01-20 12:00:30'"))
    return rollups.rollup_incremental(stored, rows, "2024-01-20 12:05:30")


SCORED_STATS = f"""{STATS}, round(sum(scanned_mb), 6) AS scanned_mb_sum, round(sum(spilled_mb), 6) AS spilled_mb_sum,
  {", ".join(f"round(avg({s}), 6) AS avg_{s}" for s in SCORE_COLS)}"""


@register(
    "A5_rollup_minute_scored",
    f"WITH {E}, {W} SELECT {MINUTE} AS window_start, dataset_type, {SCORED_STATS} FROM scored GROUP BY 1, 2",
)
def _(spark, sf_dir):
    return rollups.rollup_minute_scored(baselines.scored_events(typed_events(spark, sf_dir)))


def _system_sql(keys: str) -> str:
    return f"""a6 AS (SELECT *, CASE WHEN spill_pressure > 0.6 OR queue_pressure > 0.6 THEN 'HIGH'
        WHEN spill_pressure > 0.3 OR queue_pressure > 0.3 THEN 'MEDIUM' ELSE 'LOW' END AS pressure_level FROM (
      SELECT *, CASE WHEN queued_count + running_count > 0 THEN queued_count / (queued_count + running_count)
          ELSE 0.0 END AS queue_pressure,
        CASE WHEN s + p > 0 THEN p / (s + p) ELSE 0.0 END AS spill_pressure,
        CASE WHEN x > 0 THEN s / (x / 1000.0::DOUBLE) ELSE 0.0 END AS throughput_mb_s FROM (
      SELECT {FIVE} AS bucket_start, {keys}, count(*) AS running_count,
        cast(sum(CASE WHEN queue_duration_ms > 0 THEN 1 ELSE 0 END) AS BIGINT) AS queued_count,
        sum(scanned_mb) AS s, sum(spilled_mb) AS p, cast(sum(execution_duration_ms) AS BIGINT) AS x
      FROM e GROUP BY bucket_start, {keys})))"""


_SYSTEM_COLS = """bucket_start, running_count, queued_count, round(queue_pressure, 6) AS queue_pressure,
  round(spill_pressure, 6) AS spill_pressure, pressure_level, round(throughput_mb_s, 6) AS throughput_mb_s"""


@register(
    "A6_system_metrics_5min",
    f"WITH {E}, {_system_sql('run_id, deployment_type')} SELECT run_id, deployment_type, {_SYSTEM_COLS} FROM a6",
)
def _(spark, sf_dir):
    return rollups.system_metrics_5min(events(spark, sf_dir, with_id=True), ["run_id", "deployment_type"])


A7 = f"""a7 AS (SELECT {FIVE} AS bucket_start, deployment_type, instance_id, count(*) AS running_count,
  sum(scanned_mb) AS scanned_mb, sum(spilled_mb) AS spilled_mb
  FROM e WHERE instance_id IS NOT NULL GROUP BY ALL)"""


@register(
    "A7_instance_metrics_5min",
    f"""WITH {E} SELECT run_id, {FIVE} AS bucket_start, deployment_type, instance_id, count(*) AS running_count,
      round(sum(scanned_mb), 6) AS scanned_mb, round(sum(spilled_mb), 6) AS spilled_mb
    FROM e WHERE instance_id IS NOT NULL GROUP BY run_id, bucket_start, deployment_type, instance_id""",
)
def _(spark, sf_dir):
    keys = ["run_id", "deployment_type", "instance_id"]
    return rollups.instance_metrics_5min(events(spark, sf_dir, with_id=True), keys)


MET = f"""{SPINE},
met AS (SELECT d.bucket_start, d.bucket_end, e.*, greatest(execution_start_time, d.bucket_start) AS overlap_start,
    least(execution_end_time, d.bucket_end) AS overlap_end FROM e
  JOIN spine d ON e.execution_start_time < d.bucket_end AND e.execution_end_time > d.bucket_start),
contrib AS (SELECT *, epoch_us(overlap_end) // 1000 - epoch_us(overlap_start) // 1000 AS overlap_ms FROM met)"""
_ALLOC = "sum(CASE WHEN execution_duration_ms > 0 THEN {} * overlap_ms / execution_duration_ms ELSE 0 END)"
_SCANNED, _SPILLED = _ALLOC.format("scanned_mb"), _ALLOC.format("spilled_mb")
A8 = f"""a8 AS (SELECT bucket_start, deployment_type, count(*) AS running_count, CAST(0 AS BIGINT) AS queued_count,
    {_SCANNED} AS scanned_mb, {_SPILLED} AS spilled_mb,
    CASE WHEN {_SCANNED} + {_SPILLED} = 0 THEN 0.0 ELSE {_SPILLED} / ({_SCANNED} + {_SPILLED}) END AS spill_pressure
  FROM contrib GROUP BY 1, 2)"""
A9 = f"""a9 AS (SELECT bucket_start, deployment_type, instance_id, count(*) AS running_count,
    {_SCANNED} AS scanned_mb, {_SPILLED} AS spilled_mb FROM contrib GROUP BY 1, 2, 3)"""


@register(
    "A8_overlap_rollup_deployment",
    f"""WITH {E}, {MET}, {A8} SELECT bucket_start, deployment_type, running_count, queued_count,
      {sql_cols(["scanned_mb", "spilled_mb", "spill_pressure"])} FROM a8""",
)
def _(spark, sf_dir):
    return overlap.overlap_rollup_deployment(events(spark, sf_dir))


@register(
    "A9_overlap_rollup_instance",
    f"""WITH {E}, {MET}, {A9} SELECT bucket_start, deployment_type, instance_id, running_count,
      {sql_cols(["scanned_mb", "spilled_mb"])} FROM a9""",
)
def _(spark, sf_dir):
    return overlap.overlap_rollup_instance(events(spark, sf_dir))


_TOP = """count(*) AS occurrences, round(avg(duration_seconds), 6) AS avg_duration_seconds,
  round(avg(spill_pressure), 6) AS avg_spill_pressure, max(arrival_timestamp) AS last_seen"""


@register(
    "A10_top_queries",
    f"""WITH {E} SELECT query_id, dataset_type AS deployment_type, {_TOP} FROM e GROUP BY 1, 2
    ORDER BY occurrences DESC, last_seen DESC, query_id, 2 LIMIT 50""",
)
def _(spark, sf_dir):
    return rollups.top_queries(typed_events(spark, sf_dir), "dataset_type")


@register(
    "A11_top_queries_window",
    f"""WITH {E}, g AS (SELECT query_id, deployment_type, {_TOP}, avg(scanned_mb) AS m,
        round(sum(scanned_mb), 6) AS scanned_mb, round(sum(spilled_mb), 6) AS spilled_mb FROM e
      WHERE arrival_timestamp >= (SELECT max(arrival_timestamp) FROM e) - INTERVAL 10000 MINUTE
        AND deployment_type = 'provisioned' GROUP BY 1, 2)
    SELECT * EXCLUDE (m), round(m, 6) AS metric_value FROM g ORDER BY m DESC, last_seen DESC, query_id LIMIT 50""",
)
def _(spark, sf_dir):
    return rollups.top_queries_window(events(spark, sf_dir), 10000, "scanned_mb", "provisioned")


@register(
    "A12_pipeline_status",
    f"""WITH {E} SELECT count(*) AS processed_rows, min(arrival_timestamp) AS earliest_arrival_ts,
      max(arrival_timestamp) AS latest_arrival_ts FROM e""",
)
def _(spark, sf_dir):
    return rollups.pipeline_status(events(spark, sf_dir))


@register(
    "A13_rollup_p95",
    f"""WITH {E} SELECT {MINUTE} AS window_start, deployment_type, count(*) AS query_count,
      round(avg(execution_duration_ms), 6) AS avg_execution_duration_ms,
      round(quantile_cont(cast(execution_duration_ms AS DOUBLE), 0.95), 6) AS p95_execution_duration_ms
    FROM e GROUP BY 1, 2""",
)
def _(spark, sf_dir):
    return rollups.rollup_p95(events(spark, sf_dir))


@register(
    "A13_rollup_p95_merged",
    f"""WITH {E} SELECT {MINUTE} AS window_start, deployment_type, count(*) AS query_count, true AS within FROM e GROUP BY 1, 2""",
)
def _(spark, sf_dir):
    """Percentiles out of merged sketches of five parts, held against the exact ranks."""
    rows = events(spark, sf_dir)
    part = F.pmod(F.xxhash64("query_id", "arrival_timestamp"), F.lit(5)).alias("part")
    stored = partials.minute_partials(rows.select("*", part), ["deployment_type", "part"])
    p95 = partials.with_percentile(partials.merge_partials(stored))
    minute = times.bucket_minute(F.col("arrival_timestamp")).alias("window_start")
    x, value = F.col("percentile_execution_duration_ms"), F.col("execution_duration_ms")
    ranked = rows.select(minute, "deployment_type", value).join(p95, ["window_start", "deployment_type"])
    ranks = ranked.groupBy("window_start", "deployment_type", "query_count").agg(
        F.avg((value < x).cast("int")).alias("below"), F.avg((value <= x).cast("int")).alias("upto")
    )
    slack = 0.0165 + 1 / F.col("query_count")
    within = (F.col("below") - slack <= 0.95) & (F.col("upto") + slack >= 0.95)
    return ranks.select("window_start", "deployment_type", "query_count", within.alias("within"))


A14 = """a14 AS (SELECT deployment_type, instance_id, quantile_cont(cast(running_count AS DOUBLE), 0.95) AS cap_p95
  FROM a7 GROUP BY 1, 2)"""


@register(
    "A14_instance_capacity_p95",
    f"WITH {E}, {A7}, {A14} SELECT deployment_type, instance_id, round(cap_p95, 6) AS cap_p95 FROM a14",
)
def _(spark, sf_dir):
    return rollups.instance_capacity_p95(rollups.instance_metrics_5min(events(spark, sf_dir)))


@register(
    "A15_kpi_buffer",
    f"""WITH {E}, b AS (SELECT * FROM e ORDER BY arrival_timestamp DESC, query_id LIMIT 1000)
    SELECT count(*) AS buffered_events, round(avg(CASE WHEN queued THEN 1 ELSE 0 END), 6) AS queued_ratio,
      round(avg(duration_seconds), 6) AS avg_duration_seconds FROM b""",
)
def _(spark, sf_dir):
    return rollups.kpi_buffer(reports.recent_events(events(spark, sf_dir), 1000))


@register(
    "A16_kpi_totals",
    f"""WITH {E} SELECT count(*) AS row_count, round(sum(scanned_mb), 6) AS total_scanned_mb,
      round(sum(spilled_mb), 6) AS total_spilled_mb FROM e""",
)
def _(spark, sf_dir):
    return rollups.kpi_totals(events(spark, sf_dir))


@register("A17_distinct_deployments", f"WITH {E} SELECT DISTINCT deployment_type FROM e")
def _(spark, sf_dir):
    return rollups.distinct_deployments(events(spark, sf_dir))


@register("A18_count_events", "SELECT count(*) AS event_count FROM events")
def _(spark, sf_dir):
    return rollups.count_events(table(spark, sf_dir, "events"))


# --- joins and windows ------------------------------------------------------


@register(
    "J1_overlap_join",
    f"""WITH {E}, {MET} SELECT event_id, bucket_start, bucket_end, overlap_start, overlap_end, overlap_ms
    FROM contrib""",
)
def _(spark, sf_dir):
    return overlap.overlap_join(events(spark, sf_dir, with_id=True), ["event_id"])


UTIL = f"""{A7}, {A14},
util AS (SELECT a7.*, running_count / greatest(cap_p95, 1) AS util FROM a7 LEFT JOIN a14
  USING (deployment_type, instance_id))"""


def _util(spark, sf_dir):
    # Stored: both sides read it, and the events are scanned once.
    metrics = write_and_read(rollups.instance_metrics_5min(events(spark, sf_dir)), "instance-buckets")
    return joins.join_capacity(metrics, rollups.instance_capacity_p95(metrics))


_UTIL_COLS = "bucket_start, deployment_type, instance_id, running_count, round(util, 6) AS util"


@register("J2_join_capacity", f"WITH {E}, {UTIL} SELECT {_UTIL_COLS} FROM util")
def _(spark, sf_dir):
    return _util(spark, sf_dir).drop("scanned_mb", "spilled_mb")


@register(
    "J3_semi_top_n",
    f"""WITH {E}, t AS (SELECT query_id, sum(scanned_mb) AS s FROM e GROUP BY 1 ORDER BY s DESC, query_id LIMIT 25)
    SELECT {sql_cols(CANONICAL_COLS)} FROM e WHERE query_id IN (SELECT query_id FROM t)""",
)
def _(spark, sf_dir):
    return joins.semi_top_n(events(spark, sf_dir), "query_id", "scanned_mb", 25)


@register(
    "J4_replace_buckets",
    f"""WITH {E} SELECT {FIVE} AS bucket_start, deployment_type, running_count FROM (
      SELECT *, count(*) OVER (PARTITION BY {FIVE}, deployment_type) AS running_count FROM e
      WHERE arrival_timestamp >= TIMESTAMP '2024-01-15' OR deployment_type = 'serverless') GROUP BY ALL""",
)
def _(spark, sf_dir):
    # Stored: one deployment only. Fresh: all of them, for the second half.
    rows = events(spark, sf_dir)
    counted = lambda df: rollups.system_metrics_5min(df).select(
        "bucket_start", "deployment_type", "running_count"
    )
    stored = counted(rows.filter("deployment_type = 'serverless'"))
    fresh = counted(rows.filter("arrival_timestamp >= timestamp'2024-01-15'"))
    return joins.replace_buckets(stored, fresh)


# Baselines reach a million, so that their sixth decimal is lost in the error of
# the SQL's closed form: three are compared. The first ones of a key can lie
# halfway between two roundings; both sides add the same bit, far above their
# error and far below the last decimal.
_OFF_HALFWAY = "1e-6"
_BASELINES = ", ".join(f"round({b} + {_OFF_HALFWAY}, 3) AS {b}" for b in baselines.BASELINE_COLS)
_SCORES = ", ".join(f"round({s}, 6) AS {s}" for s in SCORE_COLS)


@register(
    "W1_ewma_baseline",
    f"WITH {E}, {W} SELECT event_id, dataset_type, {_BASELINES} FROM baselines",
    decimals=3,
)
def _(spark, sf_dir):
    rows = events(spark, sf_dir, with_id=True).withColumn("dataset_type", F.col("deployment_type"))
    found = baselines.ewma_baselines(rows)
    shown = [(F.col(b) + F.lit(float(_OFF_HALFWAY))).alias(b) for b in baselines.BASELINE_COLS]
    return found.select("event_id", "dataset_type", *shown)


@register("W2_baseline_scores", f"WITH {E}, {W} SELECT dataset_type, {sql_cols(CANONICAL_COLS)}, {_SCORES} FROM scored")
def _(spark, sf_dir):
    return baselines.scored_events(typed_events(spark, sf_dir))


PRED = f"""{UTIL},
pred AS (SELECT *, median(util) OVER (PARTITION BY deployment_type, instance_id ORDER BY bucket_start
  ROWS BETWEEN 12 PRECEDING AND 1 PRECEDING) AS util_pred FROM util)"""


@register(
    "W3_rolling_median_residual",
    f"""WITH {E}, {PRED} SELECT {_UTIL_COLS}, round(util_pred, 6) AS util_pred,
      round(util - util_pred, 6) AS util_residual FROM pred""",
)
def _(spark, sf_dir):
    return windows.rolling_median_residual(_util(spark, sf_dir)).drop("scanned_mb", "spilled_mb")


def _deployment_buckets(spark, sf_dir):
    rolled = overlap.overlap_rollup_deployment(events(spark, sf_dir))
    return write_and_read(rolled.withColumnRenamed("bucket_start", "window_start"), "buckets")


def _instance_buckets(spark, sf_dir):
    rolled = overlap.overlap_rollup_instance(events(spark, sf_dir))
    return write_and_read(rolled.withColumnRenamed("bucket_start", "window_start"), "instance-buckets")


_DEP_COLS = f"""bucket_start AS window_start, deployment_type, running_count, queued_count,
  {sql_cols(["scanned_mb", "spilled_mb", "spill_pressure"])}"""
_INST_COLS = f"""bucket_start AS window_start, deployment_type, instance_id, running_count,
  {sql_cols(["scanned_mb", "spilled_mb"])}"""


@register(
    "W4_latest_per_group",
    f"""WITH {E}, {MET}, {A8} SELECT {_DEP_COLS} FROM a8
    QUALIFY bucket_start = max(bucket_start) OVER (PARTITION BY deployment_type)""",
)
def _(spark, sf_dir):
    return windows.latest_per_group(_deployment_buckets(spark, sf_dir), ["deployment_type"])


@register(
    "W5_latest_util",
    f"""WITH {E}, {UTIL} SELECT deployment_type, instance_id, round(arg_max(util, bucket_start), 6) AS util_latest
    FROM util GROUP BY 1, 2""",
)
def _(spark, sf_dir):
    return windows.latest_util(_util(spark, sf_dir))


# --- scores -----------------------------------------------------------------


@register(
    "Q1_pressure_level",
    f"""WITH {E}, {_system_sql("deployment_type")} SELECT bucket_start, deployment_type, pressure_level FROM a6""",
)
def _(spark, sf_dir):
    metrics = rollups.system_metrics_5min(events(spark, sf_dir)).drop("pressure_level")
    return reports.with_pressure_level(metrics).select("bucket_start", "deployment_type", "pressure_level")


_PROBLEM = """query_id, arrival_timestamp, deployment_type, instance_id, round(queue_score, 6) AS queue_score,
  round(compile_score, 6) AS compile_score, round(spill_score, 6) AS spill_score, round(scan_score, 6) AS scan_score,
  round(0.35::DOUBLE * queue_score + 0.20::DOUBLE * compile_score + 0.45::DOUBLE * spill_score, 6) AS pressure_score"""


@register("Q2_problem_queries", f"WITH {E}, {W} SELECT {_PROBLEM} FROM scored")
def _(spark, sf_dir):
    return reports.problem_queries(baselines.scored_events(typed_events(spark, sf_dir)))


@register(
    "Q2_top_problem_queries",
    f"""WITH {E}, {W} SELECT {_PROBLEM} FROM scored WHERE deployment_type = 'provisioned'
      AND arrival_timestamp >= TIMESTAMP '{AS_OF}' - INTERVAL 6000 MINUTE
    ORDER BY pressure_score DESC, arrival_timestamp DESC, query_id LIMIT 50""",
)
def _(spark, sf_dir):
    scored = baselines.scored_events(typed_events(spark, sf_dir))
    return reports.problem_queries(scored, 6000, AS_OF, "provisioned", 50)


@register(
    "Q3_pressure_indicators",
    f"""WITH {E}, {_system_sql("deployment_type")} SELECT bucket_start, deployment_type,
      round(queued_count / (running_count + queued_count), 6) AS queue_pressure,
      cast(running_count AS DOUBLE) AS execution_load, round(s, 6) AS io_pressure,
      round(spill_pressure, 6) AS memory_pressure FROM a6""",
)
def _(spark, sf_dir):
    rows = events(spark, sf_dir)
    sums = rollups.instance_metrics_5min(rows.withColumn("instance_id", F.lit("all")))
    buckets = rollups.system_metrics_5min(rows).join(
        sums.select("bucket_start", "deployment_type", "scanned_mb"), ["bucket_start", "deployment_type"]
    )
    return reports.pressure_indicators(buckets, ["bucket_start", "deployment_type"])


# --- reports ----------------------------------------------------------------


@register(
    "O1_recent_events",
    f"""WITH {E} SELECT {sql_cols(RECENT_COLS)} FROM e WHERE deployment_type = 'provisioned'
    ORDER BY e.arrival_timestamp DESC, e.query_id LIMIT 500""",
)
def _(spark, sf_dir):
    return reports.recent_events(events(spark, sf_dir), 500, "provisioned")


@register(
    "O2_recent_rollups",
    f"""WITH {E}, a1 AS (SELECT {MINUTE} AS window_start, deployment_type, {STATS} FROM e GROUP BY 1, 2)
    SELECT * FROM a1 WHERE window_start >= TIMESTAMP '2024-01-28 06:30:20' - INTERVAL 6000 MINUTE""",
)
def _(spark, sf_dir):
    return reports.recent_rollups(events(spark, sf_dir), 6000, "2024-01-28 06:30:20")


_TOP_INSTANCES = """t AS (SELECT instance_id, sum(running_count) AS n FROM a9 WHERE instance_id IS NOT NULL
  GROUP BY 1 ORDER BY n DESC, instance_id LIMIT 12)"""


@register(
    "O3_top_instances",
    f"""WITH {E}, {MET}, {A9}, {_TOP_INSTANCES}
    SELECT {_INST_COLS} FROM a9 WHERE instance_id IN (SELECT instance_id FROM t)""",
)
def _(spark, sf_dir):
    return reports.top_instances(_instance_buckets(spark, sf_dir), 12)


@register(
    "O4_bucket_history",
    f"""WITH {E}, {MET}, {A8} SELECT {_DEP_COLS} FROM a8
    WHERE deployment_type = 'serverless' AND bucket_start >= TIMESTAMP '2024-01-10'""",
)
def _(spark, sf_dir):
    return reports.bucket_history(_deployment_buckets(spark, sf_dir), "2024-01-10", "serverless")


@register(
    "O4_instance_bucket_history",
    f"""WITH {E}, {MET}, {A9} SELECT {_INST_COLS} FROM a9
    WHERE deployment_type = 'provisioned' AND bucket_start >= TIMESTAMP '2024-01-10'""",
)
def _(spark, sf_dir):
    return reports.bucket_history(_instance_buckets(spark, sf_dir), "2024-01-10", "provisioned")


@register("O5_recent_scored", f"WITH {E}, {W} SELECT {sql_cols(reports.RECENT_SCORED_COLS)} FROM scored")
def _(spark, sf_dir):
    return reports.recent_scored(baselines.scored_events(typed_events(spark, sf_dir)))


ORACLE_PIVOT = ", ".join(f"max(CASE WHEN deployment_type = '{d}' THEN a END) AS {d}" for d in DEPLOYMENTS)


@register(
    "P1_pivot_deployment",
    f"""WITH {E}, a1 AS (SELECT {MINUTE} AS window_start, deployment_type, round(avg(duration_seconds), 6) AS a
      FROM e GROUP BY 1, 2) SELECT window_start, {ORACLE_PIVOT} FROM a1 GROUP BY 1""",
)
def _(spark, sf_dir):
    return reports.pivot_deployment(rollups.rollup_minute(events(spark, sf_dir)), DEPLOYMENTS)


_BY_INSTANCE = ", ".join(f"round(avg(CASE WHEN instance_id = '{i}' THEN running_count END), 6) AS \"{i}\"" for i in IDS)


@register("P2_pivot_instance", f"WITH {E}, {MET}, {A9} SELECT bucket_start AS window_start, {_BY_INSTANCE} FROM a9 GROUP BY 1")
def _(spark, sf_dir):
    return reports.pivot_instance(_instance_buckets(spark, sf_dir), IDS)


@register(
    "U1_append_rows",
    f"WITH {E} SELECT {sql_cols(CANONICAL_COLS)} FROM (FROM e UNION ALL FROM e WHERE deployment_type = 'unknown')",
)
def _(spark, sf_dir):
    rows = events(spark, sf_dir)
    return reports.append_rows(rows, rows.filter("deployment_type = 'unknown'"))
