import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidegauge.functions import times
from tidegauge.operators import ordered, timeline
from tidegauge.sources import tables

T0 = datetime(2024, 1, 1)


def test_buckets(spark):
    df = spark.createDataFrame([(datetime(2024, 1, 1, 10, 58, 59, 999999),)], "t timestamp")
    t = F.col("t")
    got = df.select(
        times.bucket_minute(t), times.bucket_hour(t), times.bucket_n_minutes(t, 5), times.bucket_n_minutes(t, 7, True)
    ).first()
    assert list(got) == [datetime(2024, 1, 1, 10, m) for m in (58, 0, 55, 56)]
    with pytest.raises(ValueError):
        times.bucket_n_minutes(t, 0)


def test_spine_from_first_minute_and_epoch(make_events):
    events = make_events([
        {"arrival_timestamp": datetime(2024, 1, 1, 0, 2, 30), "execution_duration_ms": 1000},
        {"arrival_timestamp": datetime(2024, 1, 1, 0, 11, 59), "execution_duration_ms": 30_000},
    ])
    starts = lambda df: [r["bucket_start"].minute for r in df.orderBy("bucket_start").collect()]
    spine = timeline.time_spine(events)
    assert starts(spine) == [2, 7, 12]
    assert starts(timeline.time_spine(events, origin="epoch")) == [0, 5, 10]
    assert starts(timeline.spine_missing(spine, spine.filter("minute(bucket_start) = 7"))) == [2, 12]
    with pytest.raises(ValueError):
        timeline.time_spine(events, origin="monday")


def test_spine_of_nothing(make_events):
    assert timeline.time_spine(make_events([])).count() == 0


def test_replay_delay_equals_a_loop(spark, make_events):
    rnd = random.Random(3)
    # Half of the rows share one instant; order is by query id there.
    data = [{"query_id": f"q{rnd.randrange(10**6)}", "arrival_timestamp": T0 + timedelta(seconds=0 if i % 2 else rnd.randrange(10000))} for i in range(400)]
    events = make_events(data).repartition(7)
    got = timeline.replay_delay(events, 50).orderBy("arrival_timestamp", "query_id").collect()
    last = None
    for r in got:
        want = 0.0 if last is None else max(0.0, (r["arrival_timestamp"] - last).total_seconds()) / 50
        assert r["delay_seconds"] == pytest.approx(want, abs=1e-12)
        last = r["arrival_timestamp"]
    assert len(got) == 400 and any(r["delay_seconds"] > 0 for r in got)


def test_replay_of_identical_rows(make_events):
    events = make_events([{"query_id": "a", "arrival_timestamp": T0}] * 5 + [{"query_id": "b", "arrival_timestamp": T0 + timedelta(seconds=10)}] * 5)
    got = sorted(r["delay_seconds"] for r in timeline.replay_delay(events, 1).collect())
    assert got == [0.0] * 9 + [10.0]


def test_replay_offset_and_scaling(make_events):
    events = make_events([{}, {"arrival_timestamp": T0 + timedelta(seconds=100)}])
    got = [r["target_seconds"] for r in timeline.replay_offset(events, 50).orderBy("target_seconds").collect()]
    assert got == [0.0, 2.0]
    wall = timeline.scale_event_time(events, 50, F.lit(T0), F.lit(datetime(2030, 1, 1))).agg(F.max("wall_time")).first()[0]
    assert wall == datetime(2030, 1, 1, 0, 0, 2)
    for bad in (0, -1):
        with pytest.raises(ValueError):
            timeline.replay_delay(events, bad)


def test_filters(make_events):
    events = make_events([{"arrival_timestamp": T0 + timedelta(minutes=m)} for m in range(0, 121, 10)])
    assert timeline.filter_anchored(events, 20).count() == 3
    assert timeline.filter_last(events, 20, T0 + timedelta(minutes=60)).count() == 9
    assert timeline.filter_last(events, 5).count() == 0
    assert timeline.filter_date_range(events, date(2024, 1, 1), date(2024, 1, 1)).count() == 13
    assert timeline.filter_date_range(events, date(2024, 1, 2), date(2024, 1, 2)).count() == 0
    assert timeline.filter_deployment(events, "serverless").count() == 0
    assert timeline.filter_deployment(events, None).count() == 13
    with pytest.raises(ValueError):
        timeline.filter_date_range(events, date(2024, 1, 2), date(2024, 1, 1))


def test_scan_parquet(spark, make_events, tmp_path):
    path = str(tmp_path / "t")
    make_events([{}, {}, {}]).repartition(3).write.parquet(path)
    got = tables.scan_parquet(spark, path, [" query_id", "", "query_id", "scanned_mb"])
    assert got.columns == ["arrival_timestamp", "query_id", "scanned_mb"]
    assert [r["query_id"] for r in got.collect()] == ["q0", "q1", "q2"]
    assert tables.scan_parquet(spark, path, ["query_id"], ordered=False).columns == ["query_id"]
    for bad in (["a b"], ["1a"], ["a;drop"]):
        with pytest.raises(ValueError):
            tables.scan_parquet(spark, path, bad)
    with pytest.raises(ValueError):
        tables.scan_parquet(spark, " ")


def test_nulls_last(spark):
    df = spark.createDataFrame([(None,), (T0,)], "arrival_timestamp timestamp")
    assert tables.scan_event_time_order(df).collect()[-1][0] is None


def test_limit_events(make_events):
    rnd = random.Random(1)
    events = make_events([{"query_id": f"q{i}", "arrival_timestamp": T0 + timedelta(seconds=rnd.randrange(50))} for i in range(300)]).repartition(5)
    rows = sorted((r["arrival_timestamp"], r["query_id"]) for r in events.collect())
    for n in (1, 120, 999):
        got = [(r["arrival_timestamp"], r["query_id"]) for r in tables.limit_events(events, n).collect()]
        assert got == rows[:n]
    assert tables.limit_events(events, None).count() == 300
    with pytest.raises(ValueError):
        tables.limit_events(events, 0)


def test_limit_events_beyond_any_top_k(spark):
    events = spark.range(150_000).selectExpr("timestamp_micros(id * 7919 % 150000) AS arrival_timestamp", "cast(id AS string) AS query_id")
    got = [r[0] for r in tables.limit_events(events.repartition(4), 120_000).select(F.unix_micros("arrival_timestamp")).collect()]
    assert got == list(range(120_000))


def test_union_typed_sources(make_events):
    left, right = make_events([{}]), make_events([{}, {}]).drop("instance_id")
    got = tables.union_typed_sources({"provisioned": left, "serverless": right})
    assert {(r["dataset_type"], r["instance_id"]) for r in got.collect()} == {("provisioned", "i-1"), ("serverless", None)}


def test_building_for_thousands_of_partitions_is_quick(spark, make_events):
    import time

    draw = random.Random(1)
    rows = make_events([{"arrival_timestamp": datetime(2024, 1, 1) + timedelta(seconds=draw.randrange(10**6))} for _ in range(4000)]).cache()
    rows.count()
    spark.conf.set("spark.sql.shuffle.partitions", "2000")
    try:
        began = time.monotonic()
        ranges = ordered.cut_ranges(rows, ["arrival_timestamp", "query_id"])
        plan = ranges.number(rows)
        plan._jdf.queryExecution().executedPlan()
        assert time.monotonic() - began < 5
        assert len(ranges.borders) > 500
        # Each row is in the range that its order tells.
        got = plan.select(ordered.RANGE_COL, ordered.ORDER_COL).collect()
        for r in got:
            assert r[0] == sum(b <= tuple(r[1]) for b in ranges.borders)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_ranges_are_even_though_partitions_are_not(spark, make_events):
    rows = make_events([{"arrival_timestamp": datetime(2024, 1, 1) + timedelta(seconds=i)} for i in range(6000)])
    uneven = rows.filter("query_id <= 'q2'").coalesce(1).union(rows.filter("query_id > 'q2'").repartition(6))
    ranges = ordered.cut_ranges(uneven, ["arrival_timestamp", "query_id"], per_partition=2)
    sizes = [r["count"] for r in ranges.number(uneven).groupBy(ordered.RANGE_COL).count().collect()]
    assert len(sizes) == 8 and max(sizes) < 3 * 6000 / 8
    assert ordered.cut_ranges(rows.filter("false"), ["arrival_timestamp"]).borders == ()
