"""Running baselines as a stateful stream operator."""

import json
import random
import shutil
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidegauge.operators import rollups
from tidegauge.operators.baselines import scored_events
from tidegauge.schema import SCORED_COLS
from tidegauge.sources import messages, sinks, tables
from tidegauge.streaming import rows as stream_rows, tables as stream_tables
from tidegauge.streaming.scoring import stream_scored

T0 = datetime(2024, 1, 1)


@pytest.fixture(scope="module")
def rows(make_events):
    draw = random.Random(2)
    mb = [(draw.random() * 100 + 1, draw.choice([0.0, draw.random()])) for _ in range(240)]
    plain = [
        {
            "query_id": f"q{i:03}", "arrival_timestamp": T0 + timedelta(seconds=draw.randrange(3000), microseconds=draw.randrange(1_000_000)),
            "deployment_type": draw.choice(["provisioned", "provisioned", "serverless"]), "instance_id": draw.choice([None, "i"]),
            "scanned_mb": mb[i][0], "spilled_mb": mb[i][1], "spill_pressure": mb[i][1] / mb[i][0], "queue_duration_ms": draw.randrange(5),
        }
        for i in range(240)
    ]
    return lambda chosen=plain: make_events(chosen).withColumn("dataset_type", F.col("deployment_type")), plain


def feed(spark, base, batches, start, name="in"):
    for batch in batches:
        batch.coalesce(1).write.mode("append").parquet(f"{base}/{name}")
        start(tables.stream_parquet(spark, f"{base}/{name}", batch.schema, 100)).awaitTermination()


def append(df, base, cp="cp"):
    return sinks.stream_batches(df, f"{base}/out", f"{base}/{cp}", 1000)


def by_id(df):
    return {r.query_id: r.asDict() for r in df.collect()}


def same(got, want):
    assert sorted(got, key=repr) == sorted(want, key=repr)
    for q, r in want.items():
        for c, v in r.items():
            assert got[q][c] == (pytest.approx(v, rel=1e-9) if isinstance(v, float) else v), (q, c)


def cut(rows, make, sizes):
    out = []
    for n in sizes:
        out.append(make(rows[:n]))
        rows = rows[n:]
    return out


@pytest.mark.parametrize("sizes", [[240], [100, 1, 139]])
def test_ordered_input_equals_batch_however_it_is_cut(spark, rows, tmp_path, sizes):
    make, plain = rows
    plain = sorted(plain, key=lambda r: (r["arrival_timestamp"], r["query_id"]))
    base = str(tmp_path)
    feed(spark, base, cut(plain, make, sizes), lambda s: append(stream_scored(s), base))
    got = spark.read.parquet(f"{base}/out")
    assert got.columns == [*make().columns, *SCORED_COLS[-5:]]
    same(by_id(got), by_id(scored_events(make())))


@pytest.mark.parametrize("sizes", [[240], [60, 1, 179]])
def test_held_rows_follow_event_time_in_any_order(spark, rows, tmp_path, sizes):
    make, plain = rows
    base = str(tmp_path)
    # Rows come in any order, up to 50 minutes late; the last ones take the watermark past all.
    ends = [{"query_id": f"end{k}", "deployment_type": "end", "arrival_timestamp": T0 + timedelta(hours=k)} for k in (3, 6)]
    batches = [*cut(plain, make, sizes), *[make([e]) for e in ends]]
    feed(spark, base, batches, lambda s: append(stream_scored(s, hold="50 minutes"), base))
    got = spark.read.parquet(f"{base}/out").filter("query_id NOT LIKE 'end%'")
    same(by_id(got), by_id(scored_events(make())))


def test_held_rows_wait_and_late_ones_go(spark, rows, tmp_path):
    make, _ = rows
    base = str(tmp_path)
    one = lambda q, seconds: make([{"query_id": q, "arrival_timestamp": T0 + timedelta(seconds=seconds)}])
    far = make([{"query_id": "far", "arrival_timestamp": datetime(2500, 1, 1), "execution_start_time": datetime(2500, 1, 1), "execution_end_time": datetime(2500, 1, 1)}])
    start = lambda s: append(stream_scored(s, hold="1 minute"), base)
    feed(spark, base, [one("a", 0), one("b", 30), far], start)
    assert spark.read.schema(make().schema).parquet(f"{base}/out").count() == 0
    feed(spark, base, [one("c", 100), one("late", 10), one("d", 600)], start)
    got = spark.read.parquet(f"{base}/out")
    assert sorted(r.query_id for r in got.collect()) == ["a", "b", "c"]


def test_a_repeated_batch_and_a_restart_change_nothing(spark, rows, tmp_path):
    make, plain = rows
    plain = sorted(plain, key=lambda r: (r["arrival_timestamp"], r["query_id"]))
    base = str(tmp_path)
    batches = cut(plain, make, [80, 80, 80])
    send = lambda s: sinks.stream_topics(stream_rows.route_topics(stream_scored(s), "p", "s"), f"{base}/topics", f"{base}/cp", "folder")
    feed(spark, base, batches[:2], send)
    shutil.copytree(f"{base}/cp", f"{base}/before")
    feed(spark, base, batches[2:], send)
    read = lambda: {(r.topic, r.offset): r.value for r in messages.read_messages(spark, [f"{base}/topics/p", f"{base}/topics/s"]).collect()}
    sent = read()
    assert len(sent) == 240
    shutil.move(f"{base}/cp", f"{base}/after")
    shutil.move(f"{base}/before", f"{base}/cp")
    send(tables.stream_parquet(spark, f"{base}/in", make().schema, 100)).awaitTermination()
    assert read() == sent


def test_from_messages_to_topics_and_rollups(spark, rows, tmp_path):
    """The whole chain: raw topic, cleaned, scored, routed; the routed topics rolled up; and one plan for all."""
    make, plain = rows
    plain = sorted(plain, key=lambda r: (r["arrival_timestamp"], r["query_id"]))
    base = str(tmp_path)
    # A start that takes what is available once leaves the last watermark to the next one.
    ends = [make([{"query_id": "end", "deployment_type": "end", "arrival_timestamp": T0 + timedelta(days=d)}]) for d in (1, 2)]
    for batch in [*cut(plain, make, [100, 140]), *ends]:
        sinks.write_messages(batch.drop("duration_seconds", "spill_pressure", "queued").coalesce(1), f"{base}/raw", "folder")
        raw = messages.stream_messages(spark, [f"{base}/raw"], "folder")
        events = stream_rows.stream_clean(raw)
        routed = stream_rows.route_topics(stream_scored(events), "p", "s")
        sinks.stream_topics(routed, f"{base}/topics", f"{base}/cp1", "folder").awaitTermination()
        chained = stream_rows.stream_rollup(stream_scored(events, hold="1 minute"), "scored", watermark=None)
        sinks.stream_batches(chained, f"{base}/chained", f"{base}/cp2", 1000).awaitTermination()
        processed = messages.stream_messages(spark, [f"{base}/topics/p", f"{base}/topics/s"], "folder")
        rolled = stream_rows.stream_rollup(stream_rows.stream_scored_messages(processed), "scored")
        stream_tables.stream_updates(rolled, f"{base}/rolled", f"{base}/cp3", ["window_start", "dataset_type"]).awaitTermination()
    want = {(r.window_start, r.dataset_type): r.asDict() for r in rollups.rollup_minute_scored(scored_events(make())).collect()}
    chained = spark.read.parquet(f"{base}/chained")
    latest = stream_tables.read_updates(spark, f"{base}/rolled")
    for name, got in (("chained", chained), ("latest", latest)):
        found = {(r.window_start, r.dataset_type): r.asDict() for r in got.filter("window_start < '2024-01-02'").collect()}
        assert want.keys() - found.keys() == set(), name
        same(found, want)


def test_infinite_and_far_values_without_hold(spark, make_events, tmp_path):
    far = datetime(9998, 1, 1)
    events = make_events([{"scanned_mb": float("inf")}, {"arrival_timestamp": far, "execution_start_time": far, "execution_end_time": far}])
    events = events.withColumn("dataset_type", F.col("deployment_type")).withColumn("offset", F.lit(None).cast("bigint"))
    base = str(tmp_path)
    feed(spark, base, [events], lambda s: append(stream_scored(s), base))
    got = by_id(spark.read.parquet(f"{base}/out"))
    assert got["q1"]["arrival_timestamp"] == far and got["q0"]["offset"] is None and got["q0"]["scanned_mb"] == float("inf")


def test_options_are_checked(spark, rows):
    make, _ = rows
    for alpha in (0.0, 1.1):
        with pytest.raises(ValueError):
            stream_scored(make(), alpha)
    with pytest.raises(ValueError, match="carried"):
        stream_scored(make().withColumn("more", F.array(F.lit(1))))


def test_scored_messages_without_all_fields_are_dropped(spark, rows):
    make, _ = rows
    routed = stream_rows.route_topics(scored_events(make()))
    body = json.loads(routed.first().value)
    values = [body, {k: v for k, v in body.items() if k != "queue_score"}, {**body, "more": 1}, {**body, "scan_score": "x"}]
    frame = spark.createDataFrame([(json.dumps(v),) for v in values], "value string")
    got = stream_rows.stream_scored_messages(frame).collect()
    assert len(got) == 1 and got[0].query_id == body["query_id"]
