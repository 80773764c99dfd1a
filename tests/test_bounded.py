"""Row groups as batches, and files that triggers share."""

import shutil
from pathlib import Path

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import types as T

from tidegauge.sources import tables
from tidegauge.streaming import tables as stream_tables


SCHEMA = T.StructType([T.StructField("k", T.LongType()), T.StructField("t", T.TimestampType()), T.StructField("more", T.StringType())])


def write_file(path, first, groups, rows):
    Path(path).parent.mkdir(exist_ok=True)
    with pq.ParquetWriter(path, pa.schema([("k", pa.int64()), ("t", pa.timestamp("us", tz="UTC"))])) as out:
        for g in range(groups):
            keys = pa.array(range(first + g * rows, first + (g + 1) * rows), pa.int64())
            out.write_table(pa.table({"k": keys, "t": keys.cast(pa.timestamp("us", tz="UTC"))}))


def run(spark, base, max_rows, batches=None):
    """Until all is read, or some batches have run; gives the sizes of the batches."""
    source = tables.stream_parquet(spark, f"{base}/in", SCHEMA, max_rows=max_rows)
    writer = source.writeStream.format("parquet").option("path", f"{base}/out").option("checkpointLocation", f"{base}/cp")
    if batches:
        writer.trigger(availableNow=True).start().awaitTermination()
        return None
    query = writer.trigger(processingTime="0 seconds").start()
    query.processAllAvailable()
    query.stop()
    return [p["numInputRows"] for p in query.recentProgress if p["numInputRows"]]


def test_one_file_makes_several_batches_and_a_restart_goes_on(spark, tmp_path):
    base = str(tmp_path)
    write_file(f"{base}/in/a.parquet", 0, 7, 100)
    run(spark, base, 250, batches=1)
    assert spark.read.parquet(f"{base}/out").count() == 300
    assert run(spark, base, 250) == [300, 100]
    write_file(f"{base}/in/b.parquet", 700, 2, 100)
    (tmp_path / "in" / "_hidden.parquet").write_text("no parquet")
    assert run(spark, base, 100) == [100, 100]
    got = spark.read.parquet(f"{base}/out")
    assert sorted(r.k for r in got.collect()) == list(range(900)) and got.filter("more IS NOT NULL").count() == 0
    assert {r.t.microsecond for r in got.filter("k = 5").collect()} == {5}


def test_a_batch_may_span_files(spark, tmp_path):
    base = str(tmp_path)
    for i in range(4):
        write_file(f"{base}/in/{i}.parquet", i * 20, 2, 10)
    assert run(spark, base, 50) == [50, 30]
    with pytest.raises(ValueError):
        tables.stream_parquet(spark, f"{base}/in", SCHEMA, max_rows=0)


def start(spark, make_events, base, sizes, clock, cp="cp", max_rows=10, fmt="parquet"):
    for i, n in enumerate(sizes):
        if n:
            make_events([{"query_id": f"{len(list(Path(base).glob('in/*')))}-{i}-{k}"} for k in range(n)]).select("query_id").coalesce(1).write.mode("append").parquet(f"{base}/in")
        source = spark.readStream.schema("query_id string").parquet(f"{base}/in")
        stream_tables.stream_rolled_files(source, f"{base}/files", f"{base}/{cp}", max_rows, 60, fmt, now=clock).awaitTermination()


def closed(base, fmt="parquet"):
    return sorted(str(p.parent.name) for p in Path(base).glob(f"files/closed/v=*/*.{fmt}"))


def test_small_triggers_share_a_file(spark, make_events, tmp_path):
    base, clock = str(tmp_path), lambda: 0.0
    start(spark, make_events, base, [3, 3, 3], clock)
    assert closed(base) == []
    start(spark, make_events, base, [3, 2, 25], clock)
    assert closed(base) == ["v=3"] * 2 + ["v=5"] * 3
    stream_tables.close_files(spark, f"{base}/files", 10, spark.read.parquet(f"{base}/in").schema)
    got = spark.read.parquet(f"{base}/files/closed")
    assert got.count() == got.distinct().count() == 39


def test_old_files_are_closed(spark, make_events, tmp_path):
    base, now = str(tmp_path), [0.0]
    start(spark, make_events, base, [2], lambda: now[0])
    now[0] = 59.0
    start(spark, make_events, base, [1], lambda: now[0])
    assert closed(base) == []
    now[0] = 61.0
    start(spark, make_events, base, [1], lambda: now[0])
    assert len(closed(base)) == 1 and spark.read.parquet(f"{base}/files/closed").count() == 4


def test_a_repeated_batch_loses_and_doubles_nothing(spark, make_events, tmp_path):
    base, clock = str(tmp_path), lambda: 0.0
    start(spark, make_events, base, [6], clock)
    shutil.copytree(f"{base}/cp", f"{base}/before")
    start(spark, make_events, base, [6], clock)
    assert spark.read.parquet(f"{base}/files/closed").count() == 12
    # The closing batch runs again, then one more.
    source = spark.readStream.schema("query_id string").parquet(f"{base}/in")
    stream_tables.stream_rolled_files(source, f"{base}/files", f"{base}/before", 10, 60, now=clock).awaitTermination()
    assert spark.read.parquet(f"{base}/files/closed").distinct().count() == 12
    assert spark.read.parquet(f"{base}/files/closed").count() == 12
    for bad in ((0, 1), (1, 0)):
        with pytest.raises(ValueError):
            stream_tables.stream_rolled_files(source, "x", "y", *bad)
    with pytest.raises(ValueError):
        stream_tables.stream_rolled_files(source, "x", "y", 1, 1, "orc")
