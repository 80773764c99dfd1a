import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidegauge.operators import baselines

T0 = datetime(2024, 1, 1)
SCHEMA = "dataset_type string, arrival_timestamp timestamp, query_id string, x double"


def loop(data, alpha, start=None):
    value, out = dict(start or {}), {}
    for k, t, q, x in sorted(data):
        value[k] = x if k not in value else alpha * x + (1 - alpha) * value[k]
        out[(k, q)] = value[k]
    return out, value


def run(df, alpha, state=None):
    rows, after = baselines.baselines_and_state(df, measures={"x": F.col("x")}, alpha=alpha, state=state)
    got = {(r["dataset_type"], r["query_id"]): r["x_baseline"] for r in rows.collect()}
    return got, after


@pytest.fixture(scope="module")
def data():
    rnd = random.Random(11)
    keys = ["hot"] * 90 + ["b"] * 8 + ["rare"]
    return [(rnd.choice(keys), T0 + timedelta(seconds=rnd.randrange(900)), f"q{i:05}", rnd.choice([0.0, rnd.random() * 1e6])) for i in range(2500)]


@pytest.mark.parametrize("alpha", [0.05, 0.5, 1.0, 1e-6])
def test_equals_the_sequential_loop(spark, data, alpha):
    spark.conf.set("spark.sql.shuffle.partitions", "7")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "100")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got, after = run(spark.createDataFrame(data, SCHEMA).repartition(5), alpha)
        want, end = loop(data, alpha)
        assert got == pytest.approx(want, rel=1e-9, abs=1e-12)
        assert {r["dataset_type"]: r["x_baseline"] for r in after.collect()} == pytest.approx(end, rel=1e-9)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_state_continues_earlier_rows(spark, data):
    cut = T0 + timedelta(seconds=400)
    first, second = [r for r in data if r[1] < cut], [r for r in data if r[1] >= cut]
    _, after = run(spark.createDataFrame(first, SCHEMA), 0.05)
    got, _ = run(spark.createDataFrame(second, SCHEMA), 0.05, after)
    want, _ = loop(data, 0.05)
    assert got == pytest.approx({k: want[k] for k in got}, rel=1e-9)


def test_many_keys(spark):
    data = [(f"k{i % 500:03}", T0 + timedelta(seconds=i), f"q{i}", float(i % 13)) for i in range(3000)]
    got, _ = run(spark.createDataFrame(data, SCHEMA), 0.1)
    assert got == pytest.approx(loop(data, 0.1)[0])


def test_no_rows(spark):
    rows, after = baselines.baselines_and_state(spark.createDataFrame([], SCHEMA), measures={"x": F.col("x")})
    assert rows.count() == 0 and after.count() == 0


def test_zero_baseline_scores_the_value_itself(make_events):
    events = make_events([{"spilled_mb": 0.0}, {"spilled_mb": 4.0}]).withColumn("dataset_type", F.lit("d"))
    got = baselines.scored_events(events).orderBy("arrival_timestamp").collect()
    assert [r["spill_score"] for r in got] == [0.0, pytest.approx(20.0)]
    assert [r["scan_score"] for r in got] == [1.0, 1.0]
    assert got[0]["utilization_score"] == 1.0


def test_alpha_is_checked(spark):
    with pytest.raises(ValueError):
        baselines.ewma_baselines(spark.createDataFrame([], SCHEMA), alpha=0.0)


INF = float("inf")


def loop_values(values, alpha):
    out = []
    for x in values:
        out.append(x if not out else alpha * x + (1 - alpha) * out[-1])
    return out


@pytest.mark.parametrize("at, value", [(0, INF), (1, INF), (150, INF), (150, -INF), (299, INF)])
@pytest.mark.parametrize("alpha", [0.05, 0.999])
def test_infinite_measures(spark, at, value, alpha):
    values = [float(i % 7) for i in range(300)]
    values[at] = value
    data = [("k", T0 + timedelta(seconds=i), f"q{i}", x) for i, x in enumerate(values)]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "32")
    try:
        got, after = run(spark.createDataFrame(data, SCHEMA), alpha)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    want = loop_values(values, alpha)
    assert [got["k", f"q{i}"] for i in range(300)] == pytest.approx(want)
    assert after.first()["x_baseline"] == pytest.approx(want[-1])


def test_infinite_state_stays(spark):
    state = spark.createDataFrame([("k", INF)], "dataset_type string, x_baseline double")
    data = [("k", T0 + timedelta(seconds=i), f"q{i}", 1.0) for i in range(50)]
    got, after = run(spark.createDataFrame(data, SCHEMA), 0.999999, state)
    assert set(got.values()) == {INF} and after.first()["x_baseline"] == INF


def test_a_null_key_is_a_key(spark):
    data = [(k, T0 + timedelta(seconds=i), f"q{i}", float(i)) for i in range(40) for k in ([None] if i % 2 else ["k"])]
    frame = spark.createDataFrame(data, SCHEMA)
    got, after = run(frame, 0.5)
    want = dict(zip([q for k, _, q, _ in data if k is None], loop_values([x for k, _, _, x in data if k is None], 0.5)))
    assert {q: v for (k, q), v in got.items() if k is None} == pytest.approx(want) and len(got) == 40
    again, _ = run(frame, 0.5, after)
    assert len(again) == 40


def test_rows_equal_but_for_other_columns(spark):
    rows = [("k", T0, "q", 1.0, i) for i in range(50)]
    frame = spark.createDataFrame(rows, SCHEMA + ", other int")
    once, again = (
        {r["other"]: r["x_baseline"] for r in baselines.ewma_baselines(f, measures={"x": F.col("x")}).collect()}
        for f in (frame, frame.repartition(6))
    )
    assert once == again and len(once) == 50
    slim = baselines.ewma_baselines(frame, measures={"x": F.col("x")}, keep=["query_id"])
    assert slim.columns == ["query_id", "x_baseline"] and slim.count() == 50


def test_nothing_is_written(spark):
    import os

    base = spark.conf.get("spark.checkpoint.dir")
    before = sorted(os.walk(base))
    data = [("k", T0 + timedelta(seconds=i), f"q{i}", 1.0) for i in range(50)]
    run(spark.createDataFrame(data, SCHEMA), 0.5)
    assert sorted(os.walk(base)) == before
