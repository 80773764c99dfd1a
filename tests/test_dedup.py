import random
from datetime import datetime, timedelta

import pytest

from tidegauge.operators import dedup
from tidegauge.settings import DedupRules

T0 = datetime(2024, 1, 1)


def rows_of(spark, data):
    return spark.createDataFrame([(k, T0 + timedelta(seconds=s), v) for k, s, v in data], "query_id string, arrival_timestamp timestamp, v int")


def kept(df, keys=("query_id",), **kw):
    out = dedup.dedup_ttl(df, list(keys), **kw)
    return sorted((r["query_id"], (r["arrival_timestamp"] - T0).total_seconds(), r["v"]) for r in out.collect())


def test_ttl_exactly_reached_is_still_a_repeat(spark):
    assert kept(rows_of(spark, [("a", 0, 1), ("a", 3600, 2)])) == [("a", 0, 1)]
    assert kept(rows_of(spark, [("a", 0, 1), ("a", 3600.000001, 2)])) == [("a", 0, 1), ("a", 3600.000001, 2)]


def test_repeat_refreshes_the_clock(spark):
    data = [("a", 0, 1), ("a", 3000, 2), ("a", 6000, 3), ("a", 9601, 4)]
    assert kept(rows_of(spark, data)) == [("a", 0, 1), ("a", 9601, 4)]


def test_same_instant_keeps_the_smallest(spark):
    assert kept(rows_of(spark, [("a", 5, 9), ("a", 5, 3), ("b", 5, 7)])) == [("a", 5, 3), ("b", 5, 7)]


@pytest.mark.parametrize("block", [1, 60, 300, 86400])
def test_hot_key_in_many_blocks_equals_a_loop(spark, block):
    rnd = random.Random(7)
    data = [("hot" if rnd.random() < 0.6 else f"k{rnd.randrange(5)}", rnd.randrange(20000), i) for i in range(800)]
    want, last, at = [], {}, {}
    for k, s, v in sorted(data):
        if k not in last or s - last[k] > 30:
            want.append((k, float(s), v))
        last[k] = s
    assert kept(rows_of(spark, data), ttl_seconds=30, block_seconds=block) == want


def test_before_the_epoch(spark):
    data = [("a", -86400 * 20000, 1), ("a", -86400 * 20000 + 10, 2)]
    assert len(kept(rows_of(spark, data))) == 1


def test_default_keys_drop_every_copy(spark):
    data = [("a", 0, 2), ("a", 0, 1), ("a", 1, 5)]
    assert kept(rows_of(spark, data), keys=dedup.DEFAULT_KEYS) == [("a", 0, 1), ("a", 1, 5)]


def test_null_keys_are_one_key(spark):
    data = [(None, 0, 1), (None, 10, 2), ("a", 0, 3)]
    out = dedup.dedup_ttl(rows_of(spark, data), ["query_id"]).collect()
    assert sorted(r["v"] for r in out) == [1, 3]


def test_last_wins_and_latest(spark):
    df = rows_of(spark, [("a", 0, 1), ("a", 0, 5), ("a", 0, 3), ("b", 0, 1)])
    assert sorted(r["v"] for r in dedup.dedup_last_wins(df, "v").collect()) == [1, 5]
    assert sorted(r["v"] for r in dedup.latest_version(df, ["query_id"], "v").collect()) == [1, 5]


def test_pick_one_is_limited_before_the_shuffle(spark):
    plan = dedup.dedup_exact(rows_of(spark, [("a", 0, 1)]))._jdf.queryExecution().executedPlan().toString()
    assert "Partial" in plan and plan.index("Final") < plan.index("Exchange") < plan.index("Partial")


def test_unknown_column(spark):
    with pytest.raises(ValueError):
        dedup.dedup_ttl(rows_of(spark, []), ["nope"])
    with pytest.raises(ValueError):
        DedupRules(ttl_seconds=0)


def test_rows_that_are_all_key(spark):
    df = rows_of(spark, [("a", 0, 1), ("a", 0, 1), ("b", 0, 1)]).select("query_id", "arrival_timestamp")
    assert dedup.dedup_exact(df).count() == 2
    assert dedup.dedup_ttl(df, ["query_id"]).count() == 2


def test_rules(make_events):
    events = make_events([{"query_id": "a"}, {"query_id": "a"}, {"query_id": "b"}])
    assert dedup.dedup_by_rules(events, DedupRules(keys=("query_id",))).count() == 2
    assert dedup.dedup_by_rules(events, DedupRules(enabled=False, keys=("query_id",))).count() == 3
