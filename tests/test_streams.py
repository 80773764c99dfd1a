import json
import shutil
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidegauge.operators import dedup, rollups
from tidegauge.operators.baselines import scored_events
from tidegauge.sources import messages, sinks, tables
from tidegauge.streaming import rows as stream_rows, tables as stream_tables

T0 = datetime(2024, 1, 1)


@pytest.fixture()
def feed(spark, tmp_path):
    """Run a stream once per batch of events, restarting from its checkpoint."""

    def run(batches, start):
        for batch in batches:
            batch.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
            source = tables.stream_parquet(spark, str(tmp_path / "in"), batch.schema, 100)
            start(source, str(tmp_path)).awaitTermination()
        return str(tmp_path)

    return run


def at(seconds, **more):
    return {"arrival_timestamp": T0 + timedelta(seconds=seconds), **more}


def append(df, base):
    return sinks.stream_batches(df, f"{base}/out", f"{base}/checkpoint", 1000)


def same(a, b):
    order = sorted(a.columns)
    rows = lambda df: sorted((tuple(r) for r in df.select(*order).collect()), key=repr)
    assert rows(a) == rows(b)


def test_clean_decides_presence_per_message(spark, tmp_path):
    lines = [
        {"query_id": "A", "arrival_timestamp": "2024-01-01T00:00:00Z", "dataset_type": "serverless", "queue_ms": 5},
        {"query_id": None, "queryid": "B", "arrival_timestamp": "2024-01-01T00:00:00Z"},
        {"queryid": "C", "arrival_time": "2024-01-01 00:00:00", "deployment_type": None, "dataset_type": "provisioned"},
        {"query": "D", "arrived_at": "2024-01-01", "deployment": "serverless"},
        {"query_id": "E"},
        [1],
    ]
    folder = tmp_path / "raw"
    folder.mkdir()
    (folder / "a.json").write_text("\n".join([*map(json.dumps, lines), "no json"]))
    source = messages.stream_messages(spark, [str(folder)], "json")
    append(stream_rows.stream_clean(source), str(tmp_path)).awaitTermination()
    got = {r["query_id"]: (r["dataset_type"], r["deployment_type"], r["queue_duration_ms"]) for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert got == {
        "a": ("serverless", "serverless", 5),
        # An explicit null deployment stays unknown.
        "c": ("provisioned", "unknown", 0),
        # Without deployment_type the dataset type stands in; other names are not asked.
        "d": ("unknown", "unknown", 0),
    }


def test_message_sources_are_checked(spark):
    with pytest.raises(ValueError):
        messages.stream_messages(spark, [], "json")
    with pytest.raises(ValueError):
        messages.stream_messages(spark, ["t"], "files")
    with pytest.raises(ValueError):
        messages.stream_messages(spark, ["t"], "json", starting="now")


def test_dedup_across_restarts_and_late_rows(spark, make_events, feed):
    batches = [
        make_events([at(0, query_id="a"), at(0, query_id="a"), at(60, query_id="b")]),
        make_events([at(60, query_id="b"), at(9000, query_id="c")]),
        # Older than the watermark, which stands at 9000 - 3600: dropped.
        make_events([at(100, query_id="late"), at(9000, query_id="c"), at(9001, query_id="c")]),
    ]
    base = feed(batches, lambda s, b: append(stream_rows.stream_dedup(s), b))
    got = spark.read.parquet(f"{base}/out")
    assert sorted(r["query_id"] for r in got.collect()) == ["a", "b", "c", "c"]
    on_time = batches[0].unionByName(batches[1]).unionByName(batches[2].filter("query_id <> 'late'"))
    same(got, dedup.dedup_ttl(on_time))


@pytest.mark.parametrize("cut", [[8], [3, 3, 2], [1] * 8])
def test_dedup_by_sessions_however_batches_are_cut(spark, make_events, feed, cut):
    # The limit itself is a repeat, and a repeat starts the time anew; the last row closes all sessions.
    times = [("a", 0), ("b", 0), ("a", 3600), ("a", 7200), ("b", 3601), ("a", 10_801), ("b", 3_700), ("z", 100_000)]
    events = [at(s, query_id=q, scanned_mb=float(i)) for i, (q, s) in enumerate(times)]
    batches, done = [], 0
    for n in cut:
        batches.append(make_events(events[done : done + n]))
        done += n
    batches.append(make_events([at(300_000, query_id="end")]))
    batches.append(make_events([at(0, query_id="late")]))
    base = feed(batches, lambda s, b: append(stream_rows.stream_dedup(s, ["query_id"], 3600, "3 hours"), b))
    got = spark.read.parquet(f"{base}/out").filter("query_id NOT IN ('end')")
    want = dedup.dedup_ttl(make_events(events), ["query_id"], 3600)
    same(got.select(*want.columns), want)
    assert "late" not in [r["query_id"] for r in got.collect()]


@pytest.mark.parametrize("kind, fn", [
    ("minute", rollups.rollup_minute), ("5min", rollups.rollup_5min),
    ("system", rollups.system_metrics_5min), ("instance", rollups.instance_metrics_5min),
])
def test_rollups_equal_batch(spark, make_events, feed, kind, fn):
    batches = [
        make_events([at(s, instance_id=i, queue_duration_ms=s % 2) for s, i in [(0, "a"), (30, None), (70, "b")]]),
        make_events([at(s, instance_id="a") for s in (59, 299, 300)]),
    ]
    want = fn(batches[0].unionByName(batches[1]))
    keys = [c for c in ("window_start", "bucket_start", "deployment_type", "instance_id") if c in want.columns]
    base = feed(batches, lambda s, b: stream_tables.stream_updates(stream_rows.stream_rollup(s, kind), f"{b}/out", f"{b}/checkpoint", keys))
    same(stream_tables.read_updates(spark, f"{base}/out"), want)


def test_rollup_drops_rows_behind_the_watermark(spark, make_events, feed):
    batches = [make_events([at(0), at(3600)]), make_events([at(3600)]), make_events([at(30), at(3601)])]
    keys = ["window_start", "deployment_type"]
    base = feed(batches, lambda s, b: stream_tables.stream_updates(stream_rows.stream_rollup(s, "minute"), f"{b}/out", f"{b}/checkpoint", keys))
    got = stream_tables.read_updates(spark, f"{base}/out")
    assert {r["window_start"].hour: r["query_count"] for r in got.collect()} == {0: 1, 1: 3}
    with pytest.raises(ValueError):
        stream_rows.stream_rollup(batches[0], "weekly")


def test_baselines_equal_batch_and_repeat(spark, make_events, feed):
    typed = lambda rows: make_events(rows).withColumn("dataset_type", F.col("deployment_type"))
    batches = [
        typed([at(s, query_id=f"q{s}", scanned_mb=float(s)) for s in range(50)]),
        typed([at(s, query_id=f"q{s}", deployment_type="serverless", scanned_mb=2.0) for s in range(50, 60)]),
        typed([at(s, query_id=f"q{s}", scanned_mb=float(s % 7)) for s in range(60, 99)]),
    ]

    def start(source, base):
        return stream_tables.stream_baselines(source, f"{base}/out", f"{base}/state", f"{base}/checkpoint")

    base = feed(batches, start)
    every = batches[0].unionByName(batches[1]).unionByName(batches[2])
    want = {r["query_id"]: (r["scan_score"], r["utilization_score"]) for r in scored_events(every).collect()}
    rows = spark.read.parquet(f"{base}/out").collect()
    assert len(rows) == 99
    for r in rows:
        assert (r["scan_score"], r["utilization_score"]) == pytest.approx(want[r["query_id"]], rel=1e-9)
    # A key that the last batch lacks keeps its state.
    state = spark.read.parquet(f"{base}/state/slot=0")
    assert sorted(r["dataset_type"] for r in state.collect()) == ["provisioned", "serverless"]


def test_last_n(spark, make_events, feed):
    batches = [make_events([at(s, query_id=f"q{s}") for s in part]) for part in (range(0, 40), range(100, 103), [50, 101])]
    base = feed(batches, lambda s, b: stream_tables.stream_last_n(s, f"{b}/kept", f"{b}/checkpoint", n=6))
    kept = stream_tables.read_last_n(spark, f"{base}/kept")
    assert sorted(r["query_id"] for r in kept.collect()) == sorted(["q100", "q101", "q101", "q102", "q39", "q50"])
    assert [r["query_id"] for r in stream_tables.read_last_n(spark, f"{base}/kept", 1).collect()] == ["q102"]


@pytest.mark.parametrize("part", ["hour", "day"])
def test_upsert_counts_late_rows_and_repeats_nothing(spark, make_events, feed, part):
    batches = [
        make_events([at(10, query_id="a"), at(10, query_id="a"), at(4000, query_id="b")]),
        make_events([]),
        make_events([at(20, query_id="late"), at(90000, query_id="c")]),
    ]

    def start(source, base, checkpoint="checkpoint"):
        return stream_tables.stream_upsert(source, f"{base}/events", f"{base}/rollups", f"{base}/{checkpoint}", "scanned_mb", part=part)

    def check(base):
        got = stream_tables.read_rollups(spark, f"{base}/rollups")
        same(got, rollups.rollup_minute(dedup.dedup_exact(batches[0].unionByName(batches[2]))))
        assert stream_tables.read_events(spark, f"{base}/events").count() == 4

    base = feed(batches[:2], start)
    shutil.copytree(f"{base}/checkpoint", f"{base}/before")
    feed(batches[2:], start)
    check(base)
    # As after a failure between the writes and the commit: the last batch runs again.
    start(tables.stream_parquet(spark, f"{base}/in", batches[0].schema, 100), base, "before").awaitTermination()
    check(base)


def test_upsert_last_row_of_a_batch_wins(spark, make_events, feed):
    rows = [("t", 0, 1, 5.0), ("t", 0, 2, 1.0), ("s", 9, 9, 7.0)]
    events = make_events([at(10, query_id="a", scanned_mb=mb) for _, _, _, mb in rows])
    places = spark.createDataFrame([(mb, *p) for *p, mb in rows], "scanned_mb double, topic string, partition int, offset long")
    batch = events.join(places, "scanned_mb").select(*events.columns, "topic", "partition", "offset")

    def start(source, base):
        paths = f"{base}/events", f"{base}/rollups", f"{base}/checkpoint"
        return stream_tables.stream_upsert(source, *paths, messages.POSITION_COLS)

    base = feed([batch], start)
    kept = stream_tables.read_events(spark, f"{base}/events").collect()
    assert [(r["scanned_mb"], r["offset"]) for r in kept] == [(1.0, 2)]
    with pytest.raises(ValueError):
        stream_tables.stream_upsert(batch, "a", "b", "c", [])
    with pytest.raises(ValueError):
        stream_tables.stream_upsert(batch, "a", "b", "c", "offset", part="week")


def test_routing(make_events):
    rows = make_events([{}, {}]).withColumn("dataset_type", F.when(F.col("query_id") == "q0", "provisioned").otherwise("x"))
    got = {json.loads(r["value"])["query_id"]: r["topic"] for r in stream_rows.route_topics(rows, "p", "s").collect()}
    assert got == {"q0": "p", "q1": "s"}


def test_batch_files(spark, make_events, tmp_path):
    events = make_events([{} for _ in range(25)]).coalesce(1)
    for fmt in sinks.BATCH_FORMATS:
        path = tmp_path / fmt
        sinks.write_batches(events, str(path), 10, fmt)
        assert len(list(path.glob(f"*.{fmt}"))) == 3
    with pytest.raises(ValueError):
        sinks.write_batches(events, str(tmp_path / "x"), 10, "orc")
    with pytest.raises(ValueError):
        sinks.write_batches(events, str(tmp_path / "x"), 0)


def test_stream_of_bounded_batches(spark, make_events, tmp_path):
    make_events([{} for _ in range(6)]).repartition(3).write.parquet(str(tmp_path / "in"))
    source = tables.stream_parquet(spark, str(tmp_path / "in"), max_files_per_trigger=1)
    query = sinks.stream_batches(source, str(tmp_path / "out"), str(tmp_path / "cp"), 100)
    query.awaitTermination()
    assert len(query.recentProgress) >= 3
    assert spark.read.parquet(str(tmp_path / "out")).count() == 6


def test_restaging_a_batch_replaces_it(spark, make_events, tmp_path):
    for _ in range(2):
        sinks.stage_for_warehouse(make_events([{}, {}]), str(tmp_path / "stage"), 7)
    assert spark.read.parquet(str(tmp_path / "stage")).count() == 2


def test_tables_by_date(spark, make_events, tmp_path):
    path = str(tmp_path / "t")
    sinks.write_tables(make_events([at(0), at(90000)]), path)
    sinks.write_tables(make_events([at(90001)]), path, mode="overwrite")
    got = spark.read.parquet(path)
    assert sorted(str(r["arrival_date"]) for r in got.collect()) == ["2024-01-01", "2024-01-02"]
    plan = got.filter("arrival_date = date'2024-01-02'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(arrival_date" in plan
