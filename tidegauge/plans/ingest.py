"""Registered queries: sources, decoding and validation, cleaning, duplicates."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidegauge.operators import clean, dedup, validate
from tidegauge.plans.mapping import (
    C,
    E,
    R,
    R_ARRIVAL,
    R_DEPLOYMENT,
    R_QUERY_ID,
    R_QUEUE_RAW,
    R_SCANNED_RAW,
    dirty_events,
    events,
    raw_events,
    table,
    typed_events,
)
from tidegauge.plans.registry import register
from tidegauge.schema import CANONICAL_COLS, SCORE_COLS, UI_COLS, WAREHOUSE_COLS
from tidegauge.sources import tables

# SQL forms of the column lists; doubles to 6 decimals.
_DOUBLES = {"scanned_mb", "spilled_mb", "duration_seconds", "spill_pressure", *SCORE_COLS}


def sql_cols(names, prefix: str = "") -> str:
    return ", ".join(f"round({prefix}{n}, 6) AS {n}" if n in _DOUBLES else f"{prefix}{n}" for n in names)


# --- sources ----------------------------------------------------------------


@register("S1_scan_parquet", "SELECT o_orderdate, o_orderkey, round(o_totalprice, 6) AS o_totalprice FROM orders")
def _(spark, sf_dir):
    wanted = [" o_orderkey ", "", "o_totalprice", "o_orderkey"]
    return tables.scan_parquet(spark, f"{sf_dir}/orders.parquet", wanted, "o_orderdate")


@register("S2_scan_event_time_order", f"WITH {E} SELECT {sql_cols(CANONICAL_COLS)} FROM e")
def _(spark, sf_dir):
    return tables.scan_event_time_order(events(spark, sf_dir))


@register(
    "S5_limit_events",
    f"""WITH {C}, u AS (SELECT DISTINCT query_id, arrival_timestamp FROM c)
    SELECT query_id, arrival_timestamp FROM u ORDER BY arrival_timestamp, query_id LIMIT 2500""",
)
def _(spark, sf_dir):
    accepted = dedup.dedup_exact(clean.clean_enrich(dirty_events(spark, sf_dir)))
    return tables.limit_events(accepted, 2500).select("query_id", "arrival_timestamp")


@register(
    "S6_union_typed_sources",
    f"""WITH {E} SELECT {sql_cols(CANONICAL_COLS)},
      CASE WHEN deployment_type = 'provisioned' THEN 'provisioned' ELSE 'serverless' END AS dataset_type FROM e""",
)
def _(spark, sf_dir):
    both = events(spark, sf_dir)
    own = F.col("deployment_type") == "provisioned"
    return tables.union_typed_sources({"provisioned": both.filter(own), "serverless": both.filter(~own)})


# --- decode and validate ----------------------------------------------------


def _messages(spark, sf_dir):
    """JSON payloads out of the event table; some are no objects, some have a field too many."""
    body = F.to_json(F.struct("query_id", F.col("queue_duration_ms").cast("string").alias("queue_ms")))
    wide = F.to_json(F.struct("query_id", "run_id"))
    payload = (
        F.when(F.col("event_id") % 13 == 0, F.lit("[1, 2]"))
        .when(F.col("event_id") % 17 == 0, F.lit("no json"))
        .when(F.col("event_id") % 5 == 0, wide)
        .otherwise(body)
    )
    rows = events(spark, sf_dir, with_id=True)
    return rows.select("event_id", payload.alias("value"))


_IS_OBJECT = "event_id % 13 <> 0 AND event_id % 17 <> 0"


@register(
    "V1_decode_json",
    f"""WITH {E} SELECT event_id, query_id,
      CASE WHEN event_id % 5 = 0 THEN NULL ELSE cast(queue_duration_ms AS VARCHAR) END AS queue_ms
      FROM e WHERE {_IS_OBJECT}""",
)
def _(spark, sf_dir):
    decoded = validate.decode_json(_messages(spark, sf_dir), keep=["event_id"])
    return decoded.select("event_id", "query_id", "queue_ms")


@register("V3_forbid_extra", f"WITH {E} SELECT event_id FROM e WHERE {_IS_OBJECT} AND event_id % 5 <> 0")
def _(spark, sf_dir):
    return validate.forbid_extra(_messages(spark, sf_dir), ["query_id", "queue_ms"]).select("event_id")


def _broken(spark, sf_dir):
    """Canonical rows, some of them broken in one way or another."""
    by = F.col("event_id")
    return events(spark, sf_dir, with_id=True).withColumns(
        {
            "query_id": F.when(by % 37 == 0, F.lit("")).otherwise(F.col("query_id")),
            "deployment_type": F.when(by % 31 == 0, F.lit(" Cloud ")).otherwise(F.upper("deployment_type")),
            "queue_duration_ms": F.when(by % 19 == 0, F.lit(-1)).otherwise(F.col("queue_duration_ms")),
            "scanned_mb": F.when(by % 23 == 0, F.lit(float("nan"))).otherwise(F.col("scanned_mb")),
            "execution_end_time": F.when(
                by % 29 == 0, F.col("arrival_timestamp") - F.expr("INTERVAL 1 SECOND")
            ).otherwise(F.col("execution_end_time")),
        }
    )


_BROKEN = {
    "query_id": "event_id % 37 = 0",
    "queue_duration_ms": "event_id % 19 = 0",
    "scanned_mb": "event_id % 23 = 0",
    "end_before_start": "event_id % 29 = 0",
    "arrival_after_end": "event_id % 29 = 0",
}


@register(
    "V2_validate_canonical",
    f"""WITH {E} SELECT event_id, CASE WHEN event_id % 31 = 0 THEN 'unknown' ELSE deployment_type END
      AS deployment_type, round(scanned_mb, 6) AS scanned_mb, execution_end_time
      FROM e WHERE NOT ({" OR ".join(_BROKEN.values())})""",
)
def _(spark, sf_dir):
    valid = validate.validate_canonical(_broken(spark, sf_dir))
    return valid.select("event_id", "deployment_type", "scanned_mb", "execution_end_time")


@register(
    "V2_rejected_rows",
    f"""WITH {E} SELECT event_id,
      concat_ws(',', {", ".join(f"CASE WHEN {cond} THEN '{r}' END" for r, cond in _BROKEN.items())}) AS reject_reason
      FROM e WHERE {" OR ".join(_BROKEN.values())}""",
)
def _(spark, sf_dir):
    return validate.rejected_rows(_broken(spark, sf_dir)).select("event_id", "reject_reason")


@register("V4_project_ui", f"WITH {E} SELECT {sql_cols(UI_COLS)} FROM e")
def _(spark, sf_dir):
    return validate.project_ui(events(spark, sf_dir))


@register("V5_project_warehouse", f"WITH {E} SELECT {sql_cols(WAREHOUSE_COLS)} FROM e")
def _(spark, sf_dir):
    return validate.project_warehouse(events(spark, sf_dir))


@register(
    "V6_project_legacy_events",
    """SELECT event_id AS query_id, user_id, CAST(NULL AS BIGINT) AS instance_id, event_type AS query_type,
      ts AS arrival_timestamp, CAST(NULL AS BIGINT) AS execution_duration_ms,
      CAST(NULL AS BIGINT) AS queue_duration_ms, CAST(NULL AS DOUBLE) AS compile_duration_ms,
      round(value, 6) AS mbytes_scanned, CAST(NULL AS DOUBLE) AS mbytes_spilled, CAST(NULL AS DOUBLE) AS queue_score,
      CAST(NULL AS DOUBLE) AS scan_score, CAST(NULL AS DOUBLE) AS spill_score, CAST(NULL AS DOUBLE) AS compile_score
      FROM events""",
)
def _(spark, sf_dir):
    rows = table(spark, sf_dir, "events").selectExpr(
        "event_id AS query_id",
        "user_id",
        "event_type AS query_type",
        "ts AS arrival_timestamp",
        "value AS mbytes_scanned",
    )
    return validate.project_legacy_events(rows)


@register(
    "V7_evolve_add_columns",
    f"""WITH {E} SELECT event_id, round(CASE WHEN event_id % 3 = 0 THEN 0.0 ELSE scanned_mb END, 6)
      AS scanned_mb_sum, 0.0::DOUBLE AS avg_queue_score FROM e""",
)
def _(spark, sf_dir):
    old = events(spark, sf_dir, with_id=True).select(
        "event_id", F.when(F.col("event_id") % 3 != 0, F.col("scanned_mb")).alias("scanned_mb_sum")
    )
    return validate.evolve_add_columns(old, ["scanned_mb_sum", "avg_queue_score"])


# --- clean and enrich -------------------------------------------------------


def _resolved(spark, sf_dir):
    return clean.resolve_aliases(dirty_events(spark, sf_dir), keep=["event_id", "copy"])


_UNSET = ", ".join(
    f"CAST(NULL AS VARCHAR) AS {n}"
    for n in (
        "instance_id",
        "execution_start_time",
        "execution_end_time",
        "compile_duration_ms",
        "execution_duration_ms",
        "spilled_mb",
    )
)


@register(
    "C1_resolve_aliases",
    f"""WITH {R} SELECT query_id, deployment AS deployment_type, arrival_time AS arrival_timestamp,
      queue_time_ms AS queue_duration_ms, mbytes_scanned AS scanned_mb, {_UNSET} FROM r""",
)
def _(spark, sf_dir):
    return clean.resolve_aliases(dirty_events(spark, sf_dir))


@register("C2_normalize_string", f"WITH {R} SELECT event_id, copy, {R_QUERY_ID} AS query_id FROM r")
def _(spark, sf_dir):
    return clean.normalize_strings(_resolved(spark, sf_dir)).select("event_id", "copy", "query_id")


@register(
    "C3_require_query_id",
    f"WITH {R} SELECT event_id, copy, {R_QUERY_ID} AS query_id FROM r WHERE {R_QUERY_ID} IS NOT NULL",
)
def _(spark, sf_dir):
    named = clean.normalize_strings(_resolved(spark, sf_dir))
    return clean.require_query_id(named).select("event_id", "copy", "query_id")


@register("C4_normalize_deployment", f"WITH {R} SELECT event_id, copy, {R_DEPLOYMENT} AS deployment_type FROM r")
def _(spark, sf_dir):
    return clean.normalize_deployment(_resolved(spark, sf_dir)).select("event_id", "copy", "deployment_type")


@register(
    "C5_derive_dataset_type",
    f"""WITH {R} SELECT event_id, copy, coalesce(nullif(trim(query_id), ''), nullif(deployment, ''), 'unknown')
      AS dataset_type FROM r""",
)
def _(spark, sf_dir):
    rows = dirty_events(spark, sf_dir).withColumns(
        {"dataset_type": F.trim("query_id"), "deployment_type": F.col("deployment")}
    )
    return clean.derive_dataset_type(rows).select("event_id", "copy", "dataset_type")


@register("C6_coerce_int", f"WITH {R} SELECT event_id, copy, {R_QUEUE_RAW} AS queue_duration_ms FROM r")
def _(spark, sf_dir):
    return clean.coerce_ints(_resolved(spark, sf_dir)).select("event_id", "copy", "queue_duration_ms")


@register("C7_coerce_float", f"WITH {R} SELECT event_id, copy, round({R_SCANNED_RAW}, 6) AS scanned_mb FROM r")
def _(spark, sf_dir):
    return clean.coerce_floats(_resolved(spark, sf_dir)).select("event_id", "copy", "scanned_mb")


def _coerced(spark, sf_dir):
    return clean.coerce_floats(clean.coerce_ints(_resolved(spark, sf_dir)))


@register(
    "C8_fill_numeric",
    f"""WITH {R} SELECT event_id, copy, coalesce({R_QUEUE_RAW}, 0) AS queue_duration_ms,
      round(coalesce({R_SCANNED_RAW}, 0.0), 6) AS scanned_mb FROM r""",
)
def _(spark, sf_dir):
    filled = clean.fill_numeric(_coerced(spark, sf_dir))
    return filled.select("event_id", "copy", "queue_duration_ms", "scanned_mb")


@register(
    "C9_clip_non_negative",
    f"""WITH {R} SELECT event_id, copy, greatest(coalesce({R_QUEUE_RAW}, 0), 0) AS queue_duration_ms,
      round(greatest(coalesce({R_SCANNED_RAW}, 0.0), 0.0), 6) AS scanned_mb FROM r""",
)
def _(spark, sf_dir):
    clipped = clean.clip_non_negative(clean.fill_numeric(_coerced(spark, sf_dir)))
    return clipped.select("event_id", "copy", "queue_duration_ms", "scanned_mb")


@register(
    "C10_parse_timestamp_utc",
    f"WITH {R} SELECT event_id, copy, {R_ARRIVAL} AS arrival_timestamp FROM r WHERE {R_ARRIVAL} IS NOT NULL",
)
def _(spark, sf_dir):
    return clean.parse_timestamps(_resolved(spark, sf_dir)).select("event_id", "copy", "arrival_timestamp")


def _timed(spark, sf_dir):
    """Typed rows whose start and end are not derived yet."""
    raw = clean.resolve_aliases(raw_events(spark, sf_dir, with_id=True), keep=["event_id"])
    return clean.coerce_floats(clean.coerce_ints(clean.parse_timestamps(raw)))


@register(
    "C11_derive_start_end",
    f"WITH {E} SELECT event_id, execution_start_time, execution_end_time FROM e",
)
def _(spark, sf_dir):
    derived = clean.derive_start_end(_timed(spark, sf_dir))
    return derived.select("event_id", "execution_start_time", "execution_end_time")


@register(
    "C12_enforce_time_order",
    f"""WITH {E}, b AS (SELECT event_id, arrival_timestamp AS a,
        CASE WHEN event_id % 3 = 0 THEN arrival_timestamp - INTERVAL 2 MINUTE ELSE execution_start_time END AS s,
        CASE WHEN event_id % 4 = 0 THEN arrival_timestamp - INTERVAL 1 MINUTE ELSE execution_end_time END AS t FROM e)
    SELECT event_id, s AS execution_start_time, greatest(s, t) AS execution_end_time,
      CASE WHEN a > greatest(s, t) THEN least(a, s) ELSE a END AS arrival_timestamp FROM b""",
)
def _(spark, sf_dir):
    by, arrival = F.col("event_id"), F.col("arrival_timestamp")
    rows = clean.derive_start_end(_timed(spark, sf_dir)).withColumns(
        {
            "execution_start_time": F.when(by % 3 == 0, arrival - F.expr("INTERVAL 2 MINUTES")).otherwise(
                F.col("execution_start_time")
            ),
            "execution_end_time": F.when(by % 4 == 0, arrival - F.expr("INTERVAL 1 MINUTE")).otherwise(
                F.col("execution_end_time")
            ),
        }
    )
    ordered = clean.enforce_time_order(rows)
    return ordered.select("event_id", "execution_start_time", "execution_end_time", "arrival_timestamp")


@register("C13_enrich_duration", f"WITH {E} SELECT event_id, round(duration_seconds, 6) AS duration_seconds FROM e")
def _(spark, sf_dir):
    timed = clean.derive_start_end(_timed(spark, sf_dir))
    return clean.enrich_duration(timed).select("event_id", "duration_seconds")


@register("C14_enrich_spill_pressure", f"WITH {E} SELECT event_id, round(spill_pressure, 6) AS spill_pressure FROM e")
def _(spark, sf_dir):
    return clean.enrich_spill_pressure(_timed(spark, sf_dir)).select("event_id", "spill_pressure")


@register("C15_enrich_queued", f"WITH {E} SELECT event_id, queued FROM e")
def _(spark, sf_dir):
    return clean.enrich_queued(_timed(spark, sf_dir)).select("event_id", "queued")


@register("C16_clean_enrich", f"WITH {C} SELECT {sql_cols(CANONICAL_COLS)} FROM c")
def _(spark, sf_dir):
    return clean.clean_enrich(dirty_events(spark, sf_dir))


# --- duplicates -------------------------------------------------------------

_CLEANED = f"WITH {C}"


@register(
    "D1_dedup_ttl",
    f"""WITH {E}, g AS (SELECT *, epoch_us(arrival_timestamp) - lag(epoch_us(arrival_timestamp))
        OVER (PARTITION BY query_id ORDER BY arrival_timestamp) AS gap FROM e)
    SELECT {sql_cols(CANONICAL_COLS)} FROM g WHERE gap IS NULL OR gap > 3600000000""",
)
def _(spark, sf_dir):
    return dedup.dedup_ttl(events(spark, sf_dir), ["query_id"], 3600)


@register(
    "D1_dedup_ttl_default_keys",
    f"""{_CLEANED}, p AS (SELECT *, row_number() OVER (PARTITION BY query_id, arrival_timestamp
        ORDER BY deployment_type, queue_duration_ms, scanned_mb) AS place FROM c)
    SELECT {sql_cols(CANONICAL_COLS)} FROM p WHERE place = 1""",
)
def _(spark, sf_dir):
    return dedup.dedup_ttl(clean.clean_enrich(dirty_events(spark, sf_dir)))


@register(
    "D2_dedup_exact",
    f"""{_CLEANED}, p AS (SELECT *, row_number() OVER (PARTITION BY query_id, arrival_timestamp
        ORDER BY deployment_type, queue_duration_ms, scanned_mb) AS place FROM c)
    SELECT {sql_cols(CANONICAL_COLS)} FROM p WHERE place = 1""",
)
def _(spark, sf_dir):
    return dedup.dedup_exact(clean.clean_enrich(dirty_events(spark, sf_dir)))


@register(
    "D3_dedup_last_wins",
    f"""{_CLEANED}, p AS (SELECT *, row_number() OVER (PARTITION BY query_id, arrival_timestamp
        ORDER BY copy DESC) AS place FROM c)
    SELECT copy, {sql_cols(CANONICAL_COLS)} FROM p WHERE place = 1""",
)
def _(spark, sf_dir):
    return dedup.dedup_last_wins(clean.clean_enrich(dirty_events(spark, sf_dir), keep=["copy"]), "copy")


@register(
    "D4_latest_version",
    f"""WITH {E} SELECT query_id, max(event_id) AS event_id, arg_max(run_id, event_id) AS run_id,
      round(arg_max(scanned_mb, event_id), 6) AS scanned_mb FROM e GROUP BY query_id""",
)
def _(spark, sf_dir):
    rows = events(spark, sf_dir, with_id=True).select("query_id", "event_id", "run_id", "scanned_mb")
    return dedup.latest_version(rows, ["query_id"], "event_id")
