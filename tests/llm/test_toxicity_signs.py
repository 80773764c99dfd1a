"""Disguised words: signs at their ends, long tokens, spaced runs and sentences."""

import numpy as np
import pytest

from tidegauge.llm import toxicity as X


@pytest.mark.parametrize("token", ["$tupid", '"$tupid",', "|diot", "!diot?", "idio+", "(idio+)", "(lown", "<lown.", "@sshole", "u$ele$$"])
def test_signs_at_the_ends_are_decoded(token):
    plain = {"$tupid": "stupid", '"$tupid",': "stupid", "|diot": "idiot", "!diot?": "idiot", "idio+": "idiot", "(idio+)": "idiot",
             "(lown": "clown", "<lown.": "clown", "@sshole": "asshole", "u$ele$$": "useless"}
    counts = np.zeros((X._K,) * 3, np.int64)
    for word in plain.values():
        s = [X._EDGE, *map(X._SYMBOL.get, word), X._EDGE]
        for t in zip(s, s[1:], s[2:]):
            counts[t] += 50
    words = X.Restorer(X.trigram_costs(counts)).words(f"you are {token} they said")
    assert plain[token] in words


def restorer(words):
    """A character model of text made of these words."""
    counts = np.zeros((X._K,) * 3, np.int64)
    text = [X._EDGE, *(s for w in words * 3 for s in (*(X._SYMBOL.get(c, X._OTHER) for c in w), X._EDGE))]
    for t in zip(text, text[1:], text[2:]):
        counts[t] += 40
    return X.Restorer(X.trigram_costs(counts))


WORDS = "you are a worthless clown and stupid loser moron idiot doof they said is this".split()


@pytest.mark.parametrize(
    "text, plain",
    [
        ("you-are-a-w0rthless-cl0wn-and-a-st0pid-l0ser", {"worthless", "clown", "loser"}),
        ("st" + "u" * 45 + "pid", {"stupid"}),
        ("stu" + "u" * 100_000 + "pid", {"stupid"}),
        (" ".join("worthlessclownmoronstupidloserworthlessmoron"), {"worthless", "clown", "moron", "stupid", "loser"}),
        ("they are a m o r o n", {"moron"}),
        ("you d ö ö f", {"dööf"}),
        ("is (i d i o t) this", {"idiot"}),
        ("i·d·i·o·t", {"idiot"}),
        ("m.o.r.o.n", {"moron"}),
        ("i d i o t", {"idiot"}),
        ("w_0_r_t_h_l_3_s_s", {"worthless"}),
    ],
)
def test_long_and_spaced_tokens(text, plain):
    assert plain <= restorer(WORDS).words(text)


def test_every_spaced_run_passes_the_check():
    import random

    draw = random.Random(2)
    alphabet = "ab ü文.-_*~·1 \n" + "  .."
    for _ in range(20_000):
        text = "".join(draw.choice(alphabet) for _ in range(draw.randrange(14)))
        if X._SPACED.search(text):
            assert X._may_be_spaced(text), text


def test_trigrams_of_texts_together_are_those_of_each():
    texts = [b"", "abc d, é文".encode(), b"x", b"a\nb", "ünï".encode()]
    want = np.zeros(X._K**3, np.int64)
    for t in texts:
        if t:
            s = [X._EDGE, *(v for v in X._BYTE_SYMBOL[np.frombuffer(t, np.uint8)].tolist() if v >= 0), X._EDGE]
            for a, b, c in zip(s, s[1:], s[2:]):
                want[a * X._K * X._K + b * X._K + c] += 1
    assert (X._trigrams(texts) == want).all() and not X._trigrams([]).any()
