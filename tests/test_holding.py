"""Held rows go through the stateful operator as pieces, packed by type and hour."""

import numpy as np
import pyarrow as pa
import pytest
from test_scoring_state import Handle, Map, Mark, Value

from tidegauge.operators.baselines import BASELINE_COLS, smoothed
from tidegauge.streaming import holding as H

NAMES = [c.removesuffix("_baseline") for c in BASELINE_COLS]


class Held(Map):
    containsKey = dict.__contains__


class Group(Handle):
    """A slot's state and its timers."""

    def getMapState(self, *_):
        return Held()

    def getValueState(self, *_):
        return Value()


def batch(at, types, x):
    n = len(at)
    keyed = {"of": types, "at": at, "query_id": ["q"] * n, **{f"x_{c}": x for c in NAMES}, "tie": np.arange(n)}
    rest = {"query_id": ["q"] * n, "place": np.arange(n)}
    return pa.RecordBatch.from_pydict({k: pa.table(v).to_struct_array().combine_chunks() for k, v in (("keyed", keyed), ("rest", rest))})


def pieces(batches):
    """Pieces by slot, as the operator gets them."""
    found = pa.Table.from_batches(list(H._to_pieces(iter(batches)))).to_pandas()
    return {slot: frame for slot, frame in found.groupby("slot")}


def operator():
    op = H._Held(0.3, NAMES)
    op.init(Group())
    return op


def given(frames):
    out = [pa.RecordBatch.from_pandas(f, preserve_index=False) for f in frames]
    return pa.Table.from_batches(list(H._to_rows(iter(out)))).to_pandas() if out else None


@pytest.mark.parametrize("together", [40, 10**6])
def test_pieces_are_scored_in_order_and_go_out_together(monkeypatch, together):
    monkeypatch.setattr(H, "PIECE_ROWS", together)
    draw = np.random.default_rng(1)
    at, x = draw.integers(1, 5 * H.HOUR_MS * 1000, 200), draw.random(200)
    types = np.where(np.arange(200) % 3 == 0, "a", "b")
    whole = batch(at, types.tolist(), x)
    by_slot = pieces([whole.slice(i, 20) for i in range(0, 200, 20)])
    assert set(by_slot) == set(range(H.SLOTS))
    n = sum(len(f[f["keyed"].map(len) > 0]) for f in by_slot.values())
    assert n == 10 if together > 200 else 10 < n <= 50
    got = {}
    for frame in by_slot.values():
        op = operator()
        assert list(op.handleInputRows((0,), iter([frame]), Mark(0))) == []
        assert op.handle.timers == [1]
        for ms in (H.HOUR_MS * 3 // 2, H.HOUR_MS * 4, H.HOUR_MS * 9):
            frames = list(op.handleExpiredTimer((0,), Mark(ms), None))
            # However many hours are due, what they hold goes out in as few frames as its rows allow.
            assert len(frames) <= 1 and op.handle.timers[-1] == ms + 1
            out = given(frames)
            if out is not None:
                assert (at[out["place"]] <= ms * 1000).all() and not set(out["place"]) & set(got)
                got.update(zip(out["place"], out[BASELINE_COLS].to_numpy()))
        assert not op.held
    assert len(got) == 200
    for kind in "ab":
        order = np.array([i for i in np.argsort(at, kind="stable") if types[i] == kind])
        values = np.repeat(x[order][:, None], len(NAMES), axis=1)
        want = smoothed(values, np.array([0]), np.array([len(values)]), values[0][None], 0.3)
        assert np.allclose([got[i] for i in order], want)


def test_rows_behind_the_watermark_of_the_batch_before_go_also_of_new_types():
    late = next(f for f in pieces([batch([5000, 9000, 9001], ["new"] * 3, [1.0] * 3)]).values() if f["keyed"].map(len).any())
    op = operator()
    empty = late[late["keyed"].map(len) == 0]
    assert len(empty) == 1
    op.handleInputRows((0,), iter([empty]), Mark(0))
    assert list(op.handleExpiredTimer((0,), Mark(9), None)) == []
    op.handleInputRows((0,), iter([late]), Mark(20))
    out = given(op.handleExpiredTimer((0,), Mark(20), None))
    # 9 ms is passed; 9.001 ms is not. The watermark of this batch itself drops nothing.
    assert out["place"].tolist() == [2] and not op.held
