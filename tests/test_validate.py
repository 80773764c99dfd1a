import math
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tidegauge.operators import validate
from tidegauge.schema import CANONICAL_COLS, LEGACY, UI_COLS, WAREHOUSE_COLS
from tidegauge.sources.sinks import to_messages


def test_each_broken_row_has_its_reason(make_events):
    at = datetime(2024, 1, 1)
    rows = make_events([
        {},
        {"query_id": ""},
        {"query_id": None},
        {"deployment_type": None},
        {"queue_duration_ms": -1, "arrival_timestamp": at, "execution_start_time": at},
        {"scanned_mb": math.nan},
        {"spilled_mb": -0.1},
        {"duration_seconds": math.nan},
        {"queued": None},
        {"execution_end_time": at, "execution_start_time": datetime(2024, 1, 2), "arrival_timestamp": at, "duration_seconds": 0.0},
        {"arrival_timestamp": datetime(2025, 1, 1), "execution_start_time": at, "execution_end_time": at, "duration_seconds": 0.0},
        {"scanned_mb": math.inf},
    ])
    assert validate.validate_canonical(rows).count() == 2
    reasons = sorted(r["reject_reason"] for r in validate.rejected_rows(rows).collect())
    assert reasons == sorted([
        "query_id", "query_id", "deployment_type", "queue_duration_ms", "scanned_mb", "spilled_mb",
        "duration_seconds", "queued", "end_before_start", "arrival_after_end",
    ])


def test_unlisted_deployment_becomes_unknown(make_events):
    got = validate.validate_canonical(make_events([{"deployment_type": " Serverless"}, {"deployment_type": "cloud"}]))
    assert sorted(r["deployment_type"] for r in got.collect()) == ["serverless", "unknown"]


def test_decode_takes_objects_only(spark):
    lines = ['{"query_id": "a", "queue_ms": 5}', '{"queryid": null}', "[1]", '[{"query_id": "x"}]', "text", "", "3", "{}", '{"query_id": "a"', '  {"query": "z"}']
    df = spark.createDataFrame([(v,) for v in lines], "value string")
    got = {tuple(r["_keys"]): (r["query_id"], r["queue_ms"]) for r in validate.decode_json(df).collect()}
    assert got == {("query_id", "queue_ms"): ("a", "5"), ("queryid",): (None, None), (): (None, None), ("query",): (None, None)}


def test_forbid_extra(spark):
    df = spark.createDataFrame([('{"a": 1}',), ('{"a": 1, "b": 2}',), ("x",), ("{}",)], "value string")
    assert sorted(r[0] for r in validate.forbid_extra(df, ["a"]).collect()) == ['{"a": 1}', "{}"]


def test_messages_round_trip_and_lax_numbers(spark, make_events):
    events = make_events([{"instance_id": None}, {"scanned_mb": 2.5}])
    back = validate.typed_message(validate.decode_json(to_messages(events), validate.text_schema(CANONICAL_COLS)))
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, events.collect()))
    texts = to_messages(events).withColumn("value", F.regexp_replace("value", '"queue_duration_ms":0', '"queue_duration_ms":"5.0"'))
    typed = validate.typed_message(validate.decode_json(texts, validate.text_schema(CANONICAL_COLS)))
    assert {r["queue_duration_ms"] for r in typed.collect()} == {5}
    texts = texts.withColumn("value", F.regexp_replace("value", '"5.0"', "5.5"))
    typed = validate.typed_message(validate.decode_json(texts, validate.text_schema(CANONICAL_COLS)))
    assert validate.validate_canonical(typed).count() == 0


def test_message_times_are_iso(make_events):
    (line, _) = [r["value"] for r in to_messages(make_events([{}, {}])).orderBy("value").collect()]
    assert '"arrival_timestamp":"2024-01-01T00:00:00.000000Z"' in line


def test_projections(make_events, spark):
    events = make_events([{}])
    assert validate.project_ui(events).columns == UI_COLS
    assert validate.project_warehouse(events).columns == WAREHOUSE_COLS
    legacy = validate.project_legacy_events(spark.createDataFrame([(1, "select", "7")], "query_id int, query_type string, user_id string"))
    assert legacy.columns == LEGACY.fieldNames()
    row = legacy.first()
    assert (row["query_id"], row["user_id"], row["query_type"], row["scan_score"]) == (1, 7, "select", None)


def test_evolve(spark):
    df = spark.createDataFrame([(1, None), (2, 3.0)], "k int, a double")
    got = validate.evolve_add_columns(df, ["a", "b"]).orderBy("k").collect()
    assert [tuple(r) for r in got] == [(1, 0.0, 0.0), (2, 3.0, 0.0)]


def test_empty_input(spark, make_events):
    assert validate.validate_canonical(make_events([])).count() == 0


@pytest.mark.parametrize("value", ["true", "1", "yes"])
def test_boolean_text(spark, make_events, value):
    texts = to_messages(make_events([{}])).withColumn("value", F.regexp_replace("value", '"queued":false', f'"queued":"{value}"'))
    typed = validate.typed_message(validate.decode_json(texts, validate.text_schema(CANONICAL_COLS)))
    assert typed.first()["queued"] is True


def test_message_is_parsed_once(spark):
    from tidegauge.streaming import rows

    df = spark.createDataFrame([("{}",)], "value string")
    for clean in (rows.stream_clean, rows.stream_canonical):
        plan = clean(df)._jdf.queryExecution().executedPlan().toString()
        assert plan.count("from_json(") == 1
