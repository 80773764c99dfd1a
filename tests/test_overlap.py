import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidegauge.operators import overlap, timeline

T0 = datetime(2024, 1, 1, 0, 2)
MS = timedelta(milliseconds=1)
WIDTH = timedelta(minutes=5)


def brute(intervals, lo, hi):
    out = []
    for q, (s, e) in intervals.items():
        b = lo
        while b <= hi:
            if s < b + WIDTH and e > b:
                out.append((q, b, max(s, b), min(e, b + WIDTH)))
            b += WIDTH
    return sorted(out)


def test_edges_equal_a_theta_join(make_events):
    m = lambda x: T0 + timedelta(minutes=x)
    intervals = {
        "inside": (m(1), m(2)), "whole": (m(0), m(5)), "across": (m(4), m(11)), "many": (m(1), m(40)),
        "zero inside": (m(3), m(3)), "zero on edge": (m(5), m(5)), "to edge": (m(2), m(5)), "from edge": (m(5), m(6)),
        "before": (m(-3), m(-1)), "into": (m(-3), m(1)), "up to origin": (m(-3), m(0)), "micro": (m(5) - MS / 1000, m(5) + MS / 1000),
        "micro over": (m(10), m(10) + MS / 1000), "zero at origin": (m(0), m(0)),
    }
    rnd = random.Random(5)
    for i in range(150):
        s = m(0) + timedelta(microseconds=rnd.randrange(3 * 10**9))
        intervals[f"r{i}"] = (s, s + timedelta(microseconds=rnd.choice([0, 1, 10**6, 9 * 10**8])))
    # Arrivals fix the origin; some intervals begin before it.
    rows = [{"query_id": q, "arrival_timestamp": max(s, m(0)), "execution_start_time": s, "execution_end_time": e} for q, (s, e) in intervals.items()]
    got = overlap.overlap_join(make_events(rows), ["query_id"]).collect()
    hi = max(e for _, e in intervals.values()).replace(second=0, microsecond=0)
    want = brute(intervals, m(0), hi)
    assert sorted((r["query_id"], r["bucket_start"], r["overlap_start"], r["overlap_end"]) for r in got) == want
    given = overlap.overlap_join(make_events(rows), ["query_id"], origin=m(0))
    assert sorted(map(tuple, given.collect())) == sorted(map(tuple, got))
    assert all(r["bucket_end"] - r["bucket_start"] == WIDTH for r in got)


def test_overlap_ms_counts_millisecond_boundaries(make_events):
    s = T0 + timedelta(microseconds=900)
    rows = [{"arrival_timestamp": T0, "execution_start_time": s, "execution_end_time": s + timedelta(microseconds=200)}]
    assert overlap.overlap_join(make_events(rows)).first()["overlap_ms"] == 1


def test_rollup_and_zero_execution(make_events):
    rows = [
        {"arrival_timestamp": T0, "compile_duration_ms": 1000, "execution_duration_ms": 1000, "scanned_mb": 8.0, "spilled_mb": 2.0},
        {"arrival_timestamp": T0, "compile_duration_ms": 1000, "execution_duration_ms": 0, "scanned_mb": 5.0, "spilled_mb": 5.0},
    ]
    (got,) = overlap.overlap_rollup_deployment(make_events(rows)).collect()
    # The interval spans compile time as well: the share is 2.
    assert (got["running_count"], got["queued_count"], got["scanned_mb"], got["spilled_mb"]) == (2, 0, 16.0, 4.0)
    assert got["spill_pressure"] == 0.2
    (got,) = overlap.overlap_rollup_deployment(make_events(rows[1:])).collect()
    assert (got["scanned_mb"], got["spill_pressure"]) == (0.0, 0.0)


def test_interval_shares_conserve_the_total(make_events):
    rnd = random.Random(2)
    rows = [
        {"arrival_timestamp": T0 + timedelta(seconds=rnd.randrange(5000)), "compile_duration_ms": rnd.randrange(10**6),
         "execution_duration_ms": 1 + rnd.randrange(2 * 10**6), "scanned_mb": rnd.random() * 100, "instance_id": rnd.choice(["a", "b", None])}
        for _ in range(200)
    ]
    events = make_events(rows)
    total = events.agg(F.sum("scanned_mb")).first()[0]
    for fn in (overlap.overlap_rollup_deployment, overlap.overlap_rollup_instance):
        for origin in ("first_minute", "epoch"):
            got = fn(events, divisor="interval", origin=origin).agg(F.sum("scanned_mb")).first()[0]
            assert got == pytest.approx(total)
    with pytest.raises(ValueError):
        overlap.overlap_rollup_deployment(events, divisor="none")


def test_nothing(make_events):
    assert overlap.overlap_rollup_deployment(make_events([])).count() == 0


def test_plan_has_no_join(make_events):
    plan = overlap.overlap_rollup_deployment(make_events([{}]))._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "CartesianProduct" not in plan


def test_a_query_of_many_years(make_events):
    from tidegauge.operators.timeline import time_spine

    end = datetime(2040, 1, 1)
    events = make_events([{"arrival_timestamp": T0, "execution_start_time": T0, "execution_end_time": end} for _ in range(3)])
    buckets = -((T0 - end) // timedelta(minutes=5))
    met = overlap.overlap_rollup_deployment(events.limit(1), origin=T0)
    assert met.count() == buckets
    assert time_spine(events).count() == buckets


def test_runs_over_slices_add_up_to_one_run_over_all(make_events):
    """Queries that span the cuts, zero lengths, and a bucket that every slice meets."""
    draw = random.Random(8)
    t0 = datetime(2024, 1, 1)
    rows = []
    for i in range(90):
        start = t0 + timedelta(seconds=draw.randrange(7200), milliseconds=draw.randrange(1000))
        length = draw.choice([0, 1, 250_000, 3_600_000, 20_000_000])
        rows.append({"arrival_timestamp": start, "execution_start_time": start, "execution_end_time": start + timedelta(milliseconds=length),
                     "execution_duration_ms": length, "scanned_mb": draw.random() * 9, "spilled_mb": draw.random(), "instance_id": draw.choice([None, "a", "b"])})
    rows.sort(key=lambda r: r["arrival_timestamp"])
    for rollup in (overlap.overlap_rollup_deployment, overlap.overlap_rollup_instance):
        for origin in ("epoch", t0):
            stored = None
            for part in (rows[:30], rows[30:60], rows[60:]):
                fresh = rollup(make_events(part), origin=origin)
                stored = fresh if stored is None else overlap.extend_overlap(stored, fresh)
            whole = rollup(make_events(rows), origin=origin)
            assert stored.columns == whole.columns
            key = lambda r: (r["bucket_start"], r["deployment_type"], "instance_id" in r and (r["instance_id"] or ""))
            for a, b in zip(sorted(stored.collect(), key=key), sorted(whole.collect(), key=key), strict=True):
                for c in whole.columns:
                    assert a[c] == (pytest.approx(b[c], abs=1e-9) if isinstance(b[c], float) else b[c])
    with pytest.raises(ValueError):
        overlap.extend_overlap(whole, whole.drop("instance_id"))


def test_a_long_run_is_made_in_short_arrays(spark):
    from pyspark.sql import functions as F

    runs = spark.createDataFrame([(0, 0), (5, 4), (-3, 9000), (7, 7 + 4095), (1, 1 + 4096)], "a long, b long")
    got = timeline.explode_range(runs, F.col("a"), F.col("b"), "k")
    counts = {(r.a, r.b): (r.n, r.low, r.high) for r in got.groupBy("a", "b").agg(F.count_distinct("k").alias("n"), F.min("k").alias("low"), F.max("k").alias("high")).collect()}
    assert counts == {(a, b): (b - a + 1, a, b) for a, b in [(0, 0), (-3, 9000), (7, 4102), (1, 4097)]} and got.count() == sum(n for n, _, _ in counts.values())
