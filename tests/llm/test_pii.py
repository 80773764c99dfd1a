import random
import re

import pytest
from hypothesis import given, settings, strategies as st

from tidegauge.llm import pii as P

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        d = int(d) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def brute(text):
    out = {}
    for kind, pattern in PATTERNS.items():
        out[kind] = []
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            good = {
                "email": True,
                "ip": kind == "ip" and all(int(p) <= 255 for p in m.group().split(".")),
                "card": 13 <= len(digits) <= 19 and luhn(digits),
                "phone": 9 <= len(digits) <= 15,
            }[kind]
            if good:
                out[kind].append(m.span())
    return out


@settings(max_examples=1500, deadline=None)
@given(st.text(alphabet="a1.@2 -+(%50", max_size=50))
def test_plain_spans(text):
    assert P.plain_spans(text) == brute(text)


def test_plain_spans_on_longer_texts():
    draw = random.Random(3)
    parts = ["a.b@c.de", "@", "192.168.0.1", "256.1.1.1", "4111 1111 1111 1111", "4111111111111112", "+1 (743) 555-3824", ".", "x", "1-", " ", "é", "00012.3.4.5"]
    for _ in range(3000):
        text = "".join(draw.choice(parts) for _ in range(draw.randrange(8)))
        assert P.plain_spans(text) == brute(text), text


CARD = "four one one one one one one one one one one one one one one one"


@pytest.mark.parametrize(
    "before, span, after, kind",
    [
        ("mail ", "john.doe [at] example [dot] com", " now", "email"),
        ("to ", "john dot doe at example dot com", " please", "email"),
        ("an ", "max (at) firma (punkt) de", "!", "email"),
        ("é ", "user＠mail.example.com", "", "email"),
        ("", "ivan.petrоv@mail.example.com", " hi", "email"),
        ("", "john @ example.com", "", "email"),
        ("call ", "plus one seven four three five five five three eight two four", " ok", "phone"),
        ("call ", "+1 (743) five five five 3824", " ok", "phone"),
        ("tel ", "＋１ (743) 555-3824", ".", "phone"),
        ("no. ", CARD, " end", "card"),
        ("", "4111​1111​1111​1111", "", "card"),
        ("ip ", "one two seven dot zero dot zero dot one", ".", "ip"),
        ("", "192[.]168[.]1[.]20", " host", "ip"),
    ],
)
def test_disguises_map_back_to_the_source(before, span, after, kind):
    found = [s for s in P.find_spans(before + span + after) if s.disguised]
    assert found == [P.Span(kind, len(before), len(before) + len(span), True)]


@pytest.mark.parametrize(
    "text",
    ["look at example.com today", "meet at the dot", "one, two, three dots", "un deux trois soleil", "größer (at) home", "1, 2, 3, 4 and 5", "x at y", "привет мир", "am Punkt. Net", "un 4 5 6", "one 12 34 56 78 90 12", "plus 100 200 300 400"],
)
def test_clean_texts(text):
    assert P.find_spans(text) == []


def test_base_spans_stay():
    text = "a@b.co at x dot com 10.0.0.1 john [at] example [dot] com"
    plain = {(s.kind, s.start, s.stop) for s in P.find_spans(text) if not s.disguised}
    assert plain == {(k, *s) for k, v in brute(text).items() for s in v}


def test_redact():
    assert P.redact("x a@b.co, 10.0.0.1; ivan.petrоv@mail.example.com") == "x [EMAIL], [IP]; [EMAIL]"
    assert P.redact("nothing") == "nothing"


def test_edge_cases(edge_docs, no_docs):
    got = edge_docs.select("doc_id", P.pii_spans("text").alias("s"), P.span_list(P.pii_spans("text")).alias("l")).collect()
    assert len(got) == edge_docs.count() and all(r.s == [] and r.l == "" for r in got)
    out = P.redact_documents(edge_docs)
    assert out.columns == edge_docs.columns
    assert sorted(map(repr, out.collect())) == sorted(map(repr, edge_docs.collect()))
    assert P.redact_documents(no_docs).count() == 0


def test_redacted_length(make_docs):
    row = P.redact_documents(make_docs([(1, "mail a@b.co")])).first()
    assert row.text == "mail [EMAIL]" and row.n_chars == len(row.text)


def test_long_runs_are_fast():
    for text in ("a" * 300_000, "1" * 300_000, "1." * 100_000, "+1" * 100_000, "a@" * 100_000, "one " * 50_000, "a dot " * 30_000, "4 " * 100_000):
        P.find_spans(text)


_NUMBER = "four one one one one one one one one one one one one one one one"


@pytest.mark.parametrize(
    ("text", "kind"),
    [
        *[(f"write to max {o}{gap}{at}{gap}{c} firma.de today", "email")
          for o, c in ("[]", "()", "{}", "<>") for gap in ("", " ") for at in ("at", "AT", "arroba", "arobase", "klammeraffe", "chez", "@")],
        *[(f"write to max@firma{o}{gap}{dot}{gap}{c}de today", "email")
          for o, c in ("[]", "()", "{}", "<>") for gap in ("", " ") for dot in ("dot", "Punkt", "punto", "point", ".")],
        *[(f"x_{at}_firma {dot} de", "email") for at in ("at", "chez") for dot in ("dot", "punkt")],
        ("call +1 seven 4 three 5 five 5 three 8 two 4 now", "phone"),
        *[(f'"{_NUMBER.replace(" ", gap)}"', "card") for gap in (" ", ".", "/", ",", ", ", "-", "\t")],
    ],
)
def test_every_accepted_form_is_looked_at(text, kind):
    assert [s.kind for s in P.find_spans(text) if s.disguised] == [kind]
    assert f"[{kind.upper()}]" in P.redact(text)


def test_a_long_name_is_taken_whole():
    name = "a.b_c-d%" * 25 + "z"
    for text in (f"to {name} [at] example.com", f"to {name} at example dot com", f"to {name.replace('.', ' dot ')} (at) example (dot) com"):
        spans = [s for s in P.find_spans(text) if s.disguised]
        assert [(s.kind, s.start, s.stop) for s in spans] == [("email", 3, len(text))]
        assert P.redact(text) == "to [EMAIL]"


@pytest.mark.parametrize(
    "before, span, after, kind",
    [
        ("host ", "192 dot 168 dot one dot five", " up", "ip"),
        ("host ", "192.168.one.5", "", "ip"),
        ("card ", "four 111 1111 1111 1111", " ok", "card"),
        ("card ", "4111 1111 1111 111 one", ".", "card"),
        ("call ", "+49 30 1234567 acht", " an", "phone"),
        ("", "plus 49 drei 0 1234567", "", "phone"),
    ],
)
def test_one_spelled_digit_is_enough(before, span, after, kind):
    found = [s for s in P.find_spans(before + span + after) if s.disguised]
    assert found == [P.Span(kind, len(before), len(before) + len(span), True)]


def test_names_begin_where_the_pattern_says():
    """Against the pattern of a name, on short texts."""
    import random

    draw = random.Random(6)
    name = re.compile(rf"(?:[A-Za-z0-9%+-][A-Za-z0-9_%+-]*(?:\.|{P._HIDDEN_DOT}))*[A-Za-z0-9%+-][A-Za-z0-9_%+-]*\Z", re.IGNORECASE)
    for _ in range(20_000):
        text = "".join(draw.choice(["a", "b1", "_", ".", " dot ", "[.]", " ", "-", "é", "(punkt)"]) for _ in range(draw.randrange(9)))
        found = name.search(text)
        joints = list(P._DOT.finditer(text))
        if any(a.end() == b.start() for a, b in zip(joints, joints[1:])) or re.search(r"[ _-]{2}", text):
            continue  # signs that two joints could share
        assert P._name_start(text, len(text), 0, P._hidden_dots(text)) == (found.start() if found else len(text)), text


def test_every_spelled_number_passes_the_check():
    import random

    draw = random.Random(7)
    parts = ["one", "Four", "fünf", "12", "3", " ", "-", ", ", " dot ", " punkt ", "plus ", "x", ".", "a1", "(", "null"]
    for _ in range(30_000):
        text = "".join(draw.choice(parts) for _ in range(draw.randrange(4, 16)))
        spelled = any(any(p["digit"] for p in P._SPELLED_PART.finditer(text, *r.span())) for r in P._SPELLED.finditer(text))
        words = P._WORD.findall(text.translate(P._FOLD).lower())
        assert not spelled or P._SOME_SPELLED.search("".join(map(P._letter, words))), text


@pytest.mark.parametrize("text, span", [("tel +1 (848) 555-1373 Un an", (4, 21)), ("tel +1 (848) 555-1373, one more", (4, 21))])
def test_an_article_beside_a_number_is_no_digit(text, span):
    assert P.find_spans(text) == [P.Span("phone", *span, False)]
