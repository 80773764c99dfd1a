"""Topics as folders: positions, commits, restarts."""

import json
import shutil

import pytest
from pyspark.sql import functions as F

from tidegauge.sources import messages, sinks, topics
from tidegauge.sources.topics import TopicLog, TopicSource, _Files


def send(spark, root, topic, values):
    frame = spark.createDataFrame([(topic, v) for v in values], "topic string, value string")
    topics.register(spark)
    frame.coalesce(2).write.format(topics.FORMAT).mode("append").option("path", root).save()


def rows(df):
    return sorted((r.topic, r.partition, r.offset, r.value) for r in df.collect())


def copied(df, base, seconds=None):
    writer = df.writeStream.format("parquet").option("path", f"{base}/out").option("checkpointLocation", f"{base}/cp")
    trigger = {"availableNow": True} if seconds is None else {"processingTime": f"{seconds} seconds"}
    return writer.trigger(**trigger).start()


def test_positions_run_through_a_topic(spark, tmp_path):
    root = str(tmp_path)
    for k in range(4):
        send(spark, root, "a", [f"{k} line\nof two 文" for _ in range(5)])
    send(spark, root, "b", ["x"])
    got = rows(messages.read_messages(spark, [f"{root}/a", f"{root}/b"]))
    assert [r[2] for r in got] == [*range(20), 0]
    assert [r[3][0] for r in got[:20]] == [str(k) for k in range(4) for _ in range(5)]
    stream = messages.stream_messages(spark, [f"{root}/a", f"{root}/b"], "folder")
    copied(stream, root).awaitTermination()
    assert rows(spark.read.parquet(f"{root}/out")) == got


def test_a_restart_goes_on_where_the_stream_stood(spark, tmp_path):
    root = str(tmp_path)
    for k in range(3):
        send(spark, root, "a", [str(k)] * 10)
        copied(messages.stream_messages(spark, [f"{root}/a"], "folder"), root).awaitTermination()
    assert [r[2] for r in rows(spark.read.parquet(f"{root}/out"))] == list(range(30))


def test_latest_leaves_out_what_is_there(spark, tmp_path):
    root = str(tmp_path)
    send(spark, root, "a", ["old"] * 3)
    for values in ([], ["new"] * 4):
        if values:
            send(spark, root, "a", values)
        copied(messages.stream_messages(spark, [f"{root}/a"], "folder", starting="latest"), root).awaitTermination()
    assert [(r[2], r[3]) for r in rows(spark.read.parquet(f"{root}/out"))] == [(o, "new") for o in range(3, 7)]


def test_bounded_batches_and_a_restart_between_them(spark, tmp_path):
    root = str(tmp_path)
    for k in range(6):
        send(spark, root, "a", [str(k)] * 10)
        send(spark, root, "b", [str(k)] * 10)
    stream = lambda: messages.stream_messages(spark, [f"{root}/a", f"{root}/b"], "folder", max_per_trigger=40)
    # One batch, as only what is available now is taken, once.
    copied(stream(), root).awaitTermination()
    assert spark.read.parquet(f"{root}/out").count() == 40
    query = copied(stream(), root, 0)
    query.processAllAvailable()
    query.stop()
    sizes = [p["numInputRows"] for p in query.recentProgress if p["numInputRows"]]
    assert sizes == [40, 40]
    assert [r[2] for r in rows(spark.read.parquet(f"{root}/out"))] == [*range(60)] * 2


def test_a_topic_that_is_not_there_yet(spark, tmp_path):
    root = str(tmp_path)
    assert messages.read_messages(spark, [f"{root}/none"]).count() == 0
    copied(messages.stream_messages(spark, [f"{root}/none"], "folder"), root).awaitTermination()
    send(spark, root, "none", ["1"])
    copied(messages.stream_messages(spark, [f"{root}/none"], "folder"), root).awaitTermination()
    assert spark.read.parquet(f"{root}/out").count() == 1


def source_of(spark, base, batches):
    for k, batch in enumerate(batches):
        spark.createDataFrame(batch, "topic string, value string").coalesce(1).write.mode("append").parquet(f"{base}/in")
        stream = spark.readStream.schema("topic string, value string").parquet(f"{base}/in")
        yield stream


def test_a_repeated_batch_adds_nothing(spark, tmp_path):
    base = str(tmp_path)
    batches = [[("a", "1"), ("b", "2")], [("a", "3")]]
    for k, stream in enumerate(source_of(spark, base, batches)):
        if k == 1:
            shutil.copytree(f"{base}/cp", f"{base}/before")
        sinks.stream_topics(stream, f"{base}/topics", f"{base}/cp", "folder").awaitTermination()
    got = rows(messages.read_messages(spark, [f"{base}/topics/a", f"{base}/topics/b"]))
    assert [(r[0], r[2], r[3]) for r in got] == [("a", 0, "1"), ("a", 1, "3"), ("b", 0, "2")]
    files = sorted(p.name for p in tmp_path.glob("topics/*/data/*"))
    # As after a loss of the second batch's commit: it runs again under its number.
    shutil.move(f"{base}/cp", f"{base}/lost")
    shutil.move(f"{base}/before", f"{base}/cp")
    stream = spark.readStream.schema("topic string, value string").parquet(f"{base}/in")
    sinks.stream_topics(stream, f"{base}/topics", f"{base}/cp", "folder").awaitTermination()
    assert rows(messages.read_messages(spark, [f"{base}/topics/a", f"{base}/topics/b"])) == got
    assert sorted(p.name for p in tmp_path.glob("topics/*/data/*")) == files


def test_a_failed_batch_leaves_nothing(spark, tmp_path):
    base = str(tmp_path)
    good = [("a", str(i)) for i in range(20)]
    for values in (good, [*good, ("no/topic", "x")], [*good, (None, "x")]):
        frame = spark.createDataFrame(values, "topic string, value string").repartition(4)
        topics.register(spark)
        write = frame.write.format(topics.FORMAT).mode("append").option("path", base)
        if values is good:
            write.save()
            files = sorted(tmp_path.glob("a/data/*"))
        else:
            with pytest.raises(Exception, match="not a topic"):
                write.save()
    assert sorted(tmp_path.glob("a/data/*")) == files
    assert messages.read_messages(spark, [f"{base}/a"]).count() == 20


def test_a_commit_stopped_between_topics_is_finished_by_its_repeat(tmp_path):
    options = {"path": str(tmp_path), "writer": "w"}
    writer = TopicSource(options).streamWriter(None, False)
    import pyarrow as pa

    batch = lambda: writer.write(iter([pa.RecordBatch.from_pydict({"topic": ["a", "b", "a"], "value": ["1", "2", "3"]})]))
    first = batch()
    TopicLog(f"{tmp_path}/a").append([first.files["a"]], "w", 7)
    writer.commit([batch(), None], 7)
    assert [TopicLog(f"{tmp_path}/{t}").size() for t in "ab"] == [1, 1]
    assert TopicLog(f"{tmp_path}/a").record(0)["files"] == [[first.files["a"][0], 2, 0]]
    writer.commit([batch()], 8)
    assert TopicLog(f"{tmp_path}/a").record(1)["end"] == 4
    # Batches of another stream have numbers of their own.
    TopicSource({**options, "writer": "v"}).streamWriter(None, False).commit([batch()], 7)
    assert TopicLog(f"{tmp_path}/a").size() == 3
    writer.abort([batch(), None], 9)
    assert len(list(tmp_path.glob("b/data/*"))) == 3 + 1  # first's part of b was never committed nor aborted


def test_a_late_head_and_a_second_writer(tmp_path):
    log = TopicLog(str(tmp_path / "t"))
    for k in range(5):
        assert log.append([(f"{k}.parquet", 1)])
    (tmp_path / "t" / "head.json").write_text(json.dumps({"record": 1}))
    assert log.size() == 5
    with pytest.raises(RuntimeError, match="second writer"):
        log._create(4, {})
    assert log.size() == 5 and log.record(4)["end"] == 5
    with pytest.raises(FileNotFoundError):
        log.record(5)


def test_names_and_options_are_checked(spark, tmp_path):
    for bad in ("", "a/b", "..", None, "a b"):
        with pytest.raises(ValueError):
            topics.topic_name(bad)
    with pytest.raises(ValueError):
        messages.read_messages(spark, [])
    with pytest.raises(ValueError):
        messages.stream_messages(spark, ["t"], "folder", max_per_trigger=0)
    with pytest.raises(ValueError):
        messages.stream_messages(spark, ["t"], "json", starting="latest")
    with pytest.raises(ValueError):
        sinks.stream_topics(spark.readStream.format("rate").load().select(F.lit("a").alias("topic"), F.lit("b").alias("value")), "x", "y", "json")


def test_write_messages_into_a_topic(spark, make_events, tmp_path):
    for _ in range(2):
        sinks.write_messages(make_events([{}, {}, {}]), f"{tmp_path}/events", "folder")
    got = messages.read_messages(spark, [f"file://{tmp_path}/events"])
    assert [r[2] for r in rows(got)] == list(range(6)) and got.first().topic == "events"
    assert _Files(0, {}).files == {}
