"""Part tables: level cost per batch, and repeats; mergeable rollups."""

import random
from datetime import datetime, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tidegauge.operators import partials, rollups
from tidegauge.operators.joins import replace_buckets
from tidegauge.streaming.parts import PART_COL, RUNS, PartTable

SCHEMA = f"k long, batch long, {PART_COL} string"
REPLACE = lambda old, new: replace_buckets(old, new, [PART_COL, "k"])


def files(path):
    return [p for p in Path(path).rglob("*.parquet")]


def batch_rows(spark, batch, part="p", n=6):
    return spark.createDataFrame([(k, batch, part) for k in range(n)], SCHEMA).coalesce(1)


def test_many_small_batches_leave_a_bounded_number_of_files(spark, tmp_path):
    path, seen = str(tmp_path / "t"), []
    for batch in range(50):
        table = PartTable(spark, path)
        # Two parts, of which the first ends after 25 batches.
        table.merge(batch, batch_rows(spark, batch, f"p{batch // 25}"), REPLACE, ["k"])
        if batch % 10 == 9:
            seen.append((len(files(path)), len(list((tmp_path / "t" / "state").iterdir()))))
    assert max(f for f, _ in seen) <= 4 and max(s for _, s in seen) <= 6
    got = sorted((r[PART_COL], r.k, r.batch) for r in PartTable(spark, path).current().collect())
    assert got == [(p, k, b) for p, b in (("p0", 24), ("p1", 49)) for k in range(6)]


def test_appended_rows_are_written_again_once_per_level(spark, tmp_path):
    path, written, most = str(tmp_path / "t"), 0, 0
    batches = RUNS * RUNS + 3
    for batch in range(batches):
        table = PartTable(spark, path)
        table.append(batch, batch_rows(spark, batch, n=1), ["k"])
        runs = table.state(batch)["parts"]["p"]
        most = max(most, len(runs))
        written += RUNS ** runs[-1][1] if runs[-1][0] == batch else 0
    assert most <= 2 * (RUNS - 1) + 1 and written <= 3 * batches
    assert sorted(r.batch for r in PartTable(spark, path).current().collect()) == list(range(batches))
    assert len(files(path)) <= most + RUNS


def test_a_repeated_batch_changes_nothing(spark, tmp_path):
    path = str(tmp_path / "t")
    sums = lambda old, new: old.unionByName(new).groupBy("k", PART_COL).agg(F.sum("batch").alias("batch"))
    for batch in (0, 1, 1, 2, 3, 3, 3):
        PartTable(spark, path).merge(batch, batch_rows(spark, batch + 1), sums, ["k"])
    assert {r.batch for r in PartTable(spark, path).current().collect()} == {1 + 2 + 3 + 4}
    path = str(tmp_path / "a")
    for batch in [*range(RUNS), RUNS - 1, RUNS, RUNS]:
        PartTable(spark, path).append(batch, batch_rows(spark, batch, n=1), ["k"])
    assert sorted(r.batch for r in PartTable(spark, path).current().collect()) == list(range(RUNS + 1))


def test_only_touched_parts_are_read(spark, tmp_path):
    path, read = str(tmp_path / "t"), []

    def merged(old, new):
        read.append((old.count(), len(old.inputFiles())))
        return REPLACE(old, new)

    for batch in range(6):
        PartTable(spark, path).merge(batch, batch_rows(spark, batch, f"p{batch % 3}"), merged, ["k"])
    assert read == [(0, 0)] * 3 + [(6, 1)] * 3


def test_empty_batches_and_tables(spark, tmp_path):
    path = str(tmp_path / "t")
    with pytest.raises(ValueError):
        PartTable(spark, path).current()
    PartTable(spark, path).merge(0, batch_rows(spark, 0, n=0), REPLACE, ["k"])
    PartTable(spark, path).append(1, batch_rows(spark, 1, n=0), ["k"])
    PartTable(spark, path).append(2, batch_rows(spark, 2), ["k"])
    assert PartTable(spark, path).current().count() == 6
    (tmp_path / "t" / "state" / f"{2:020d}.json").unlink()
    with pytest.raises(FileNotFoundError):
        PartTable(spark, path).state(2)


@pytest.fixture(scope="module")
def minutes(make_events):
    draw = random.Random(6)
    t0 = datetime(2024, 1, 1)
    hot = [{"arrival_timestamp": t0, "execution_duration_ms": int(draw.paretovariate(1.1) * 100)} for _ in range(6000)]
    rest = [
        {"arrival_timestamp": t0 + timedelta(seconds=60 + i), "deployment_type": draw.choice(["provisioned", "serverless"]), "execution_duration_ms": draw.randrange(10_000), "queue_duration_ms": i % 3}
        for i in range(600)
    ]
    rows = hot + rest
    draw.shuffle(rows)
    return make_events(rows).repartition(7).cache()


def test_merged_partials_are_the_rollup(spark, minutes):
    batches = [minutes.filter(F.pmod(F.xxhash64("query_id"), F.lit(5)) == k) for k in range(5)]
    stored = None
    for b in batches:
        fresh = partials.minute_partials(b)
        stored = partials.merge_partials(fresh if stored is None else stored.unionByName(fresh))
    got = {(r.window_start, r.deployment_type): r for r in partials.finished(stored).collect()}
    want = {(r.window_start, r.deployment_type): r for r in rollups.rollup_minute(minutes).collect()}
    assert got.keys() == want.keys()
    for k, r in want.items():
        assert all(a == (pytest.approx(b, rel=1e-9) if isinstance(b, float) else b) for a, b in zip(got[k], r))


@pytest.mark.parametrize("share", [0.5, 0.95])
def test_merged_percentiles_are_within_the_rank_error(spark, minutes, share):
    batches = [partials.minute_partials(minutes.filter(F.pmod(F.xxhash64("query_id"), F.lit(8)) == k)) for k in range(8)]
    stored = batches[0]
    for b in batches[1:]:
        stored = stored.unionByName(b)
    got = partials.with_percentile(partials.merge_partials(stored), share).collect()
    values = {}
    for r in minutes.collect():
        values.setdefault((r.arrival_timestamp.replace(second=0, microsecond=0), r.deployment_type), []).append(r.execution_duration_ms)
    assert len(got) == len(values) and max(map(len, values.values())) == 6000
    for r in got:
        v, x = values[r.window_start, r.deployment_type], r.percentile_execution_duration_ms
        low, high = sum(a < x for a in v) / len(v), sum(a <= x for a in v) / len(v)
        slack = 0.0165 + 1 / len(v)
        assert low - slack <= share <= high + slack and r.query_count == len(v)
