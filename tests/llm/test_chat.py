import hashlib

import pytest
from hypothesis import given, settings, strategies as st

from tidegauge.llm import chat as C

EVENTS = "conv_id long, seq long, turn long, kind string, role string, text string"


def fold(spark, rows):
    return {(r.conv_id, r.turn): (r.role, r.text) for r in C.fold_events(spark.createDataFrame(rows, EVENTS)).collect()}


def test_fold(spark):
    rows = [
        (1, 1, 0, "message", "user", "hi"),
        (1, 2, 1, "message", "assistant", ""),
        (1, 3, 1, "delta", None, "he"),
        (1, 4, 1, "delta", None, "llo"),
        (1, 5, 2, "message", "user", "later"),
        (1, 6, 0, "edit", None, "hi there"),
        (1, 7, 1, "regenerate", None, "ignored"),
        (1, 8, 1, "delta", None, "good "),
        (1, 9, 1, "delta", None, "day"),
        (1, 10, 3, "message", "user", "gone"),
        (1, 11, 3, "retract", None, None),
        (2, 1, 0, "delta", "assistant", "only"),
        (2, 2, 0, "delta", "assistant", " deltas"),
    ]
    want = {(1, 0): ("user", "hi there"), (1, 1): ("assistant", "good day"), (2, 0): ("assistant", "only deltas")}
    assert fold(spark, rows) == want
    assert fold(spark, rows[::-1]) == want


def test_fold_edge_cases(spark):
    assert fold(spark, []) == {}
    rows = [(None, 1, None, "message", None, None), (None, 1, None, "delta", None, "x"), (1, None, 0, "message", "user", "a")]
    got = fold(spark, rows)
    assert got[(1, 0)] == ("user", "a") and got[(None, None)][0] == ""
    many = [(1, i, 0, "delta", "assistant", f"{i},") for i in range(500)]
    assert fold(spark, many)[(1, 0)][1] == "".join(f"{i}," for i in range(500))


def test_the_last_named_role_counts(spark):
    rows = [
        (1, 1, 0, "delta", "assistant", "a"), (1, 2, 0, "delta", None, "b"), (1, 3, 0, "delta", None, "c"),
        (1, 4, 1, "message", "user", "x"), (1, 5, 1, "message", None, "y"),
        (1, 6, 2, "message", None, "z"), (1, 7, 2, "delta", "tool", "!"),
        (1, 8, 3, "delta", "", "e"), (1, 9, 3, "delta", None, "f"),
    ]
    assert fold(spark, rows) == {(1, 0): ("assistant", "abc"), (1, 1): ("user", "y"), (1, 2): ("tool", "z!"), (1, 3): ("", "ef")}


PARTS = st.lists(st.sampled_from([*C.CONTROL, "\\", "<", "[", "s>", "/", "a", "\n", "é", "[INST", " "]), max_size=9).map("".join)


@settings(max_examples=12, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "system", "tool", ""]) | PARTS, PARTS), min_size=20, max_size=40))
def test_round_trip(spark, turns):
    rows = [(1, i, r, t) for i, (r, t) in enumerate(turns)]
    messages = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    for row in C.render(messages).collect():
        role, text = turns[row.turn]
        assert C.read_back(row.formatted) == (role, text)
        inner = row.formatted[len(C.BEGIN) : -len(C.END)]
        marks = 2 if role not in C.MARKS else 1
        assert sum(inner.count(c) for c in C.CONTROL) == marks
        learned = C.unescape(row.formatted[row.loss_start : row.loss_end])
        assert learned == (text if role == "assistant" else "")


def test_digest(spark):
    rows = [(c, t, "assistant" if t % 2 else "user", f"{c} says [INST] {t}") for c in (1, 2, None) for t in range(30)]
    messages = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(6)
    got = {r.conv_id: r for r in C.digest(C.render(messages)).collect()}
    assert len(got) == 3
    for c in got:
        own = [r for r in rows if r[0] == c]
        assert got[c].n_turns == 30
        assert got[c].turns_sha256 == hashlib.sha256("".join(f"{r[2]}\n{r[3]}\n" for r in own).encode()).hexdigest()
        learned = "".join(r[3] for r in own if r[2] == "assistant")
        assert (got[c].loss_chars, got[c].loss_sha256) == (len(learned), hashlib.sha256(learned.encode()).hexdigest())
    assert C.digest(C.render(messages.limit(0))).count() == 0


def test_read_back_refuses_other_text():
    with pytest.raises(ValueError):
        C.read_back("hello")
