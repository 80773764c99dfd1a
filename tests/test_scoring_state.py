"""The state of held rows: pieces by the hour, given out an hour at a time."""

import numpy as np
import pandas as pd

from tidegauge.operators.baselines import smoothed
from tidegauge.streaming import scoring as S


class Value:
    def __init__(self):
        self.v = None

    exists = lambda self: self.v is not None
    get = lambda self: self.v

    def update(self, v):
        self.v = v


class Map(dict):
    exists = lambda self: bool(self)
    getValue, updateValue, removeKey = dict.__getitem__, dict.__setitem__, dict.__delitem__


class Handle:
    def __init__(self):
        self.timers = []

    def getValueState(self, *_):
        return Value()

    def getMapState(self, *_):
        return Map()

    def registerTimer(self, ms):
        self.timers.append(ms)


class Mark:
    def __init__(self, ms):
        self.ms = ms

    def getCurrentWatermarkInMs(self):
        return self.ms


def test_held_rows_are_given_out_by_the_hour(monkeypatch):
    monkeypatch.setattr(S, "PIECE_ROWS", 40)
    draw = np.random.default_rng(1)
    at = draw.integers(0, 5 * S.HOUR_MS * 1000, 200)
    x = draw.random(200)
    frame = pd.DataFrame({S.KEY: "a", S.TIME: pd.NaT, "at": at, "query_id": "q", "rest": "{}", "x_m": x, "tie": np.arange(200)})
    op = S._Baselines(0.3, True, ["m"], ["at", "m_baseline"])
    op.init(Handle())
    assert list(op.handleInputRows(("a",), iter([frame[i : i + 20] for i in range(0, 200, 20)]), None)) == []
    assert {hour for hour, _ in op.held} == set(range(5)) and len(op.held) > 5
    got = []
    for ms in (S.HOUR_MS * 3 // 2, S.HOUR_MS * 4, S.HOUR_MS * 9):
        out = list(op.handleExpiredTimer(("a",), Mark(ms), None))
        # No frame holds rows of two hours.
        assert all(len({-(-t // 1000) // S.HOUR_MS for t in f["at"]}) == 1 and (f["at"] <= ms * 1000).all() for f in out)
        got += out
    got = pd.concat(got, ignore_index=True)
    order = np.argsort(at, kind="stable")
    want = smoothed(x[order][:, None], np.array([0]), np.array([200]), x[order][:1][None], 0.3)
    assert got["at"].tolist() == at[order].tolist() and np.allclose(got["m_baseline"], want[:, 0])
    assert not op.held


def test_a_batch_without_holding_goes_out_in_order_and_in_frames(monkeypatch):
    monkeypatch.setattr(S, "OUT_ROWS", 30)
    frame = pd.DataFrame({S.KEY: "a", S.TIME: pd.NaT, "at": np.arange(100)[::-1], "query_id": None, "rest": "{}", "x_m": 1.0, "tie": 0})
    op = S._Baselines(0.3, False, ["m"], ["at", "m_baseline"])
    op.init(Handle())
    out = list(op.handleInputRows(("a",), iter([frame[:50], frame[50:]]), None))
    assert [len(f) for f in out] == [30, 30, 30, 10]
    assert pd.concat(out)["at"].tolist() == list(range(100))
