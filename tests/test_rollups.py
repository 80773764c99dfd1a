import random
from datetime import datetime, timedelta

import numpy as np
import pytest

from tidegauge.operators import joins, reports, rollups, windows
from tidegauge.operators.quantiles import percentile_stats

T0 = datetime(2024, 1, 1)


def test_rollup_minute(make_events):
    events = make_events([
        {"arrival_timestamp": T0, "execution_duration_ms": 1000, "queue_duration_ms": 5},
        {"arrival_timestamp": T0 + timedelta(seconds=59), "execution_duration_ms": 3000, "spill_pressure": 1.0},
    ])
    (row,) = rollups.rollup_minute(events).collect()
    assert tuple(row) == (T0, "provisioned", 2, 2.0, 0.5, 0.5)


def test_every_rollup_of_nothing(make_events):
    none = make_events([])
    for fn in (rollups.rollup_minute, rollups.rollup_5min, rollups.system_metrics_5min, rollups.instance_metrics_5min,
               rollups.top_queries, rollups.top_queries_window, rollups.rollup_p95, rollups.distinct_deployments):
        assert fn(none).count() == 0
    assert tuple(rollups.pipeline_status(none).first()) == (0, None, None)
    assert tuple(rollups.kpi_buffer(none).first()) == (0, 0.0, 0.0)


def test_incremental_keeps_full_minutes(make_events):
    at = lambda s: {"arrival_timestamp": T0 + timedelta(seconds=s)}
    events = make_events([at(10), at(50), at(70), at(200)])
    stored = rollups.rollup_minute(events.filter("arrival_timestamp < timestamp'2024-01-01 00:01:00'"))
    # The cut, 00:00:30, falls into the first minute.
    got = rollups.rollup_incremental(stored, events, T0 + timedelta(seconds=330))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, rollups.rollup_minute(events).collect()))


def test_system_metrics_zero_denominators(make_events):
    (row,) = rollups.system_metrics_5min(make_events([{"scanned_mb": 0.0, "execution_duration_ms": 0}])).collect()
    assert (row["queue_pressure"], row["spill_pressure"], row["throughput_mb_s"], row["pressure_level"]) == (0, 0, 0, "LOW")


def test_levels_are_strict(spark):
    df = spark.createDataFrame([(0.6, 0.0), (0.61, 0.0), (0.3, 0.3), (0.0, 0.31)], "spill_pressure double, queue_pressure double")
    assert [r["pressure_level"] for r in reports.with_pressure_level(df).collect()] == ["MEDIUM", "HIGH", "LOW", "MEDIUM"]


def test_queue_pressure_is_half_at_most(make_events):
    (row,) = rollups.system_metrics_5min(make_events([{"queue_duration_ms": 9}, {"queue_duration_ms": 9}])).collect()
    assert row["queue_pressure"] == 0.5 and row["pressure_level"] == "MEDIUM"


@pytest.mark.parametrize("block", [1, 10, 65536])
@pytest.mark.parametrize("fraction", [0.0, 0.5, 0.95, 1.0])
def test_exact_percentile(spark, block, fraction):
    rnd = random.Random(block)
    groups = {"hot": [rnd.randrange(-500, 500) for _ in range(400)], "one": [7], "two": [-3, 10], None: [5, 5, 5, 90], "none": [None]}
    df = spark.createDataFrame([(g, v) for g, vs in groups.items() for v in vs], "g string, v long")
    got = {r["g"]: (r["count"], r["mean"], r["percentile"]) for r in percentile_stats(df, ["g"], "v", fraction, block).collect()}
    want = {g: (len(vs), np.mean(vs), np.percentile(vs, fraction * 100)) for g, vs in groups.items() if vs != [None]}
    assert got.keys() == want.keys()
    for g in want:
        assert got[g] == pytest.approx(want[g])


def test_top_queries_arguments(make_events):
    events = make_events([{}])
    with pytest.raises(ValueError):
        rollups.top_queries_window(events, metric="query_id")
    with pytest.raises(ValueError):
        rollups.top_queries_window(events, n=0)
    # Any positive number of rows may be asked for.
    assert rollups.top_queries_window(events, n=5).count() == rollups.top_queries_window(events, n=50_000).count() == 1


def test_window_is_anchored_at_the_newest_of_all(make_events):
    events = make_events([
        {"arrival_timestamp": T0, "deployment_type": "serverless"},
        {"arrival_timestamp": T0 + timedelta(hours=2)},
    ])
    assert rollups.top_queries_window(events, 60, deployment="serverless").count() == 0
    assert rollups.top_queries_window(events, 120, deployment="serverless").count() == 1


def metrics(spark, data):
    return spark.createDataFrame(
        [("p", i, T0 + timedelta(minutes=5 * b), n) for i, b, n in data],
        "deployment_type string, instance_id string, bucket_start timestamp, running_count long",
    )


def test_capacity_below_one_or_missing(spark):
    capacity = spark.createDataFrame([("p", "a", 0.5), ("p", "b", 4.0)], "deployment_type string, instance_id string, cap_p95 double")
    got = joins.join_capacity(metrics(spark, [("a", 0, 2), ("b", 0, 2), ("c", 0, 3)]), capacity)
    assert {r["instance_id"]: r["util"] for r in got.collect()} == {"a": 2.0, "b": 0.5, "c": 3.0}


def test_rolling_median(spark):
    counts = [5, 1, 9, 2, 8, 3, 7, 4, 6, 10, 12, 11, 13, 20, 0]
    util = metrics(spark, [("a", i, n) for i, n in enumerate(counts)]).withColumnRenamed("running_count", "util")
    rows = windows.rolling_median_residual(util).orderBy("bucket_start").collect()
    assert rows[0]["util_pred"] is None and rows[0]["util_residual"] is None
    for i, r in enumerate(rows[1:], 1):
        assert r["util_pred"] == np.median(counts[max(0, i - 12):i])
        assert r["util_residual"] == counts[i] - r["util_pred"]
    assert windows.latest_util(util).first()["util_latest"] == 0


def test_latest_per_group_keeps_ties_and_null_keys(spark):
    df = spark.createDataFrame(
        [("a", 1, "x"), ("a", 2, "y"), ("a", 2, "z"), (None, 1, "n"), (None, 3, "m")], "k string, t int, v string"
    )
    got = windows.latest_per_group(df, ["k"], "t")
    assert sorted(r["v"] for r in got.collect()) == ["m", "y", "z"]


def test_replace_buckets(spark):
    stored = spark.createDataFrame([(1, "old"), (2, "old")], "bucket_start int, v string")
    fresh = spark.createDataFrame([(2, "new"), (2, "new2"), (3, "new")], "bucket_start int, v string")
    got = sorted(map(tuple, joins.replace_buckets(stored, fresh).collect()))
    assert got == [(1, "old"), (2, "new"), (2, "new2"), (3, "new")]


def test_top_instances_and_pivot(spark):
    rows = metrics(spark, [("a", 0, 1), ("b", 0, 5), ("b", 1, 1), ("c", 1, 3), (None, 1, 99)])
    buckets = rows.withColumnRenamed("bucket_start", "window_start")
    assert reports.top_instance_ids(buckets, 2) == ["b", "c"]
    assert [r["instance_id"] for r in reports.top_instances(buckets, 2).collect()] == ["b", "b", "c"]
    pivot = reports.pivot_instance(buckets, reports.top_instance_ids(buckets, 2)).orderBy("window_start")
    assert pivot.columns == ["window_start", "b", "c"]
    assert [tuple(r)[1:] for r in pivot.collect()] == [(5.0, None), (1.0, 3.0)]


def test_pressure_indicators_treat_null_as_zero(spark):
    df = spark.createDataFrame(
        [("p", T0, 3.0, 1.0, -2.0, 1.7), ("s", T0, None, None, None, None)],
        "deployment_type string, window_start timestamp, running_count double, queued_count double, scanned_mb double, spill_pressure double",
    )
    got = {r["deployment_type"]: tuple(r)[2:] for r in reports.pressure_indicators(df).collect()}
    assert got == {"p": (0.25, 3.0, 0.0, 1.0), "s": (0.0, 0.0, 0.0, 0.0)}


def test_problem_queries(spark):
    df = spark.createDataFrame(
        [("a", T0, "p", None, 1.0, 1.0, 1.0, 9.0), ("b", T0, "p", None, 0.0, 0.0, 2.0, 0.0)],
        "query_id string, arrival_timestamp timestamp, deployment_type string, instance_id string, "
        "queue_score double, compile_score double, spill_score double, scan_score double",
    )
    got = reports.problem_queries(df, n=1).collect()
    assert [(r["query_id"], r["pressure_score"]) for r in got] == [("a", pytest.approx(1.0))]
    assert reports.problem_queries(df, minutes=5, as_of=T0 + timedelta(minutes=6)).count() == 0


def test_recent_rollups_cut_on_the_window_start(make_events):
    events = make_events([{"arrival_timestamp": T0 + timedelta(seconds=s)} for s in (30, 60, 119)])
    # The first minute began before the cut, though its event came after it.
    got = reports.recent_rollups(events, 1, T0 + timedelta(seconds=80)).collect()
    assert [(r["window_start"].minute, r["query_count"]) for r in got] == [(1, 2)]
    got = reports.recent_rollups(events, 1, T0 + timedelta(seconds=60)).collect()
    assert [r["window_start"].minute for r in got] == [0, 1]


def test_recent_events_ties(make_events):
    events = make_events([{"query_id": q, "arrival_timestamp": T0} for q in "cab"])
    assert [r["query_id"] for r in reports.recent_events(events, 2).collect()] == ["a", "b"]


def test_percentiles_read_their_input_once(spark, make_events):
    """Counts of equal values are shuffled once, and both passes read that shuffle."""
    rows = make_events([{"execution_duration_ms": i % 7} for i in range(50)])
    out = rollups.rollup_p95(rows)
    assert out.count() > 0
    out.collect()
    plan = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    scans = plan.count("Scan ExistingRDD") + plan.count("LocalTableScan") + plan.count("Scan parquet")
    assert scans == 1 or "ReusedExchange" in plan
