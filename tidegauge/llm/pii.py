"""Personal data in plain and in disguised form, with source offsets.

Plain identifiers (e-mail, IP address, card and phone number) are found by fixed
patterns in the text as it is. Disguised ones are found in a normalised copy, which
two transducers make: the first maps look-alike, full-width and other-script
characters to ASCII and drops invisible ones; the second rewrites spelled digits and
the words or brackets that stand for ``@`` and ``.``. Each transducer keeps, for
every character it writes, the source characters it came from, so a span found in
the copy is mapped back to the source. Plain spans always stay; a span of the copy is
added if something in it was rewritten and no plain span of its kind covers it.

A spelled number is four or more numbers and spelled digits in a row, at least one of
them spelled; it counts if what it says is a card, phone or IP number. Names of any
length are taken whole. Of spans of one kind that start together the longer comes last.

Offsets count code points; ends are exclusive. Null and empty texts have no spans.
Time and memory are linear in the text. Repeated rows are searched each; an empty
table gives none; other columns are not read.
"""

from __future__ import annotations

import re
import unicodedata
from bisect import bisect_right
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

KINDS = ("email", "ip", "card", "phone")
SPANS = T.ArrayType(
    T.StructType(
        [
            T.StructField("kind", T.StringType()),
            T.StructField("start", T.IntegerType()),
            T.StructField("stop", T.IntegerType()),
            T.StructField("disguised", T.BooleanType()),
        ]
    )
)


class Span(NamedTuple):
    kind: str
    start: int
    stop: int
    disguised: bool


# --- plain identifiers -------------------------------------------------------

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_AT_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_NUMERIC = re.compile(r"[0-9][0-9. \-]{5,}[0-9]")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_NOT_DIGIT = re.compile(r"[^0-9]+")


def _luhn(digits: str) -> bool:
    doubled = sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return (doubled + sum(map(int, digits[-1::-2]))) % 10 == 0


def _emails(text: str) -> list[tuple[int, int]]:
    # The part before an @ is the longest run of its characters, back to the last match.
    found, last = [], 0
    for m in _AT_DOMAIN.finditer(text):
        start = m.start()
        while start > last and text[start - 1] in _LOCAL:
            start -= 1
        if start < m.start():
            found.append((start, m.end()))
            last = m.end()
    return found


def plain_spans(text: str) -> dict[str, list[tuple[int, int]]]:
    """Spans of each kind: leftmost, not overlapping, failing ones dropped."""
    ips, cards = [], []
    for run in _NUMERIC.finditer(text):
        ips += [
            m.span()
            for m in _IP.finditer(text, *run.span())
            if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m.group().split("."))
        ]
        for m in _CARD.finditer(text, *run.span()):
            digits = _NOT_DIGIT.sub("", m.group())
            if 13 <= len(digits) <= 19 and _luhn(digits):
                cards.append(m.span())
    phones = [m.span() for m in _PHONE.finditer(text) if 9 <= len(_NOT_DIGIT.sub("", m.group())) <= 15]
    return {"email": _emails(text) if "@" in text else [], "ip": ips, "card": cards, "phone": phones}


# --- transducers -------------------------------------------------------------


class Mapped:
    """A text with, for each character, the source range it came from."""

    def __init__(self, text: str, starts: np.ndarray, stops: np.ndarray, changed: np.ndarray):
        self.text, self.starts, self.stops, self.changed = text, starts, stops, changed

    @classmethod
    def of(cls, text: str) -> Mapped:
        place = np.arange(len(text) + 1, dtype=np.int64)
        return cls(text, place[:-1], place[1:], np.zeros(len(text), bool))

    def rewrite(self, edits: list[tuple[int, int, str]]) -> Mapped:
        """Replace ranges, given in order and without overlap, by other texts."""
        if not edits:
            return self
        texts, starts, stops, changed, at = [], [], [], [], 0
        for a, b, new in [*edits, (len(self.text), len(self.text), "")]:
            texts += [self.text[at:a], new]
            starts.append(self.starts[at:a])
            stops.append(self.stops[at:a])
            changed.append(self.changed[at:a])
            if new:
                starts.append(np.full(len(new), self.starts[a]))
                stops.append(np.full(len(new), self.stops[b - 1]))
                changed.append(np.ones(len(new), bool))
            at = b
        return Mapped("".join(texts), np.concatenate(starts), np.concatenate(stops), np.concatenate(changed))

    def source(self, start: int, stop: int) -> tuple[int, int]:
        return int(self.starts[start]), int(self.stops[stop - 1])


# Cyrillic, Greek and other letters that look like a Latin one.
_LOOKALIKE = dict(
    zip(
        "АВЕЅІЈКМНОРСТХУаеорсухѕіјһԁԛԝ" "ΑΒΕΖΗΙΚΜΝΟΡΤΥΧαονρυ" "ıɡ",
        "ABESIJKMHOPCTXYaeopcyxsijhdqw" "ABEZHIKMNOPTYXaovpu" "ig",
        strict=True,
    )
)
# Characters that are not seen, dashes, spaces, and other full stops.
_INVISIBLE = "­᠎​‌‍⁠﻿"
_DASHES = "‐‑‒–—−"
_SPACES = "            　"
_STOPS = "。․·•"
_FIXED = {
    **_LOOKALIKE,
    **dict.fromkeys(_INVISIBLE, ""),
    **dict.fromkeys(_DASHES, "-"),
    **dict.fromkeys(_SPACES, " "),
    **dict.fromkeys(_STOPS, "."),
}
#: All but ASCII, accented Latin letters, common signs and quotation marks.
_UNUSUAL = re.compile(
    "[^\\x00-\\x7f¡-¬®-¶¸-İĲ-ɏḀ-ỿ‘-‟…]"
)


def _ascii_of(ch: str) -> str | None:
    if ch in _FIXED:
        return _FIXED[ch]
    digit = unicodedata.digit(ch, None)
    if digit is not None:
        return str(digit)
    plain = unicodedata.normalize("NFKC", ch)
    return plain if len(plain) == 1 and plain.isascii() else None


def _characters(m: Mapped) -> Mapped:
    edits = [(x.start(), x.end(), new) for x in _UNUSUAL.finditer(m.text) if (new := _ascii_of(x.group())) is not None]
    return m.rewrite(edits)


# Words for @ and full stop, and for digits, in four languages.
_AT_WORDS = "at|arroba|arobase|klammeraffe|chez"
_DOT_WORDS = "dot|punkt|punto|point"
DIGIT_WORDS = {
    "zero": "0", "oh": "0", "one": "1", "two": "2", "three": "3", "four": "4", "five": "5", "six": "6", "seven": "7",
    "eight": "8", "nine": "9",
    "null": "0", "eins": "1", "zwei": "2", "drei": "3", "vier": "4", "fünf": "5", "sechs": "6", "sieben": "7",
    "acht": "8", "neun": "9",
    "zéro": "0", "un": "1", "deux": "2", "trois": "3", "quatre": "4", "cinq": "5", "sept": "7", "huit": "8", "neuf": "9",
    "cero": "0", "uno": "1", "dos": "2", "tres": "3", "cuatro": "4", "cinco": "5", "seis": "6", "siete": "7",
    "ocho": "8", "nueve": "9",
}
_TLDS = "com|org|net|edu|gov|info|biz|io|co|me|dev|app|uk|de|fr|es|it|nl|eu|us|ca|ch|at|be|pl|ru|in|jp|cn|br|au|test|example"

_OPEN, _CLOSE = r"[ \t]*[\[({<][ \t]*", r"[ \t]*[\])}>][ \t]*"
_AT = re.compile(
    rf"(?P<sure>{_OPEN}(?:{_AT_WORDS}|@){_CLOSE}|[ \t]+@[ \t]*|[ \t]*@[ \t]+)|(?P<word>[ \t_-]+(?:{_AT_WORDS})[ \t_-]+)|(?P<plain>@)",
    re.IGNORECASE,
)
_HIDDEN_DOT = rf"(?:{_OPEN}(?:{_DOT_WORDS}|\.){_CLOSE}|[ \t_-]+(?:{_DOT_WORDS})[ \t_-]+)"
_DOT = re.compile(_HIDDEN_DOT, re.IGNORECASE)
_DOMAIN = re.compile(rf"[A-Za-z0-9-]{{1,63}}(?:(?:\.|{_HIDDEN_DOT})[A-Za-z0-9-]{{1,63}})+", re.IGNORECASE)
_NAME_SIGNS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789_%+-")
_TLD = re.compile(rf"(?:{_TLDS})\Z", re.IGNORECASE)

_DIGIT = "|".join(sorted(DIGIT_WORDS, key=lambda w: (-len(w), w)))
_GAP = r"[ \t,./()-]{0,4}"
_SPELLED = re.compile(
    rf"(?:\bplus\b[ \t]*|\+[ \t]*)?(?:(?<![^\W_])(?:{_DIGIT})(?![^\W_])|(?<![^\W_])[0-9]+(?![^\W_]))"
    rf"(?:(?:[ \t]+(?:{_DOT_WORDS})[ \t]+|{_GAP})(?:(?<![^\W_])(?:{_DIGIT})(?![^\W_])|(?<![^\W_])[0-9]+(?![^\W_]))){{3,}}",
    re.IGNORECASE,
)
_SPELLED_PART = re.compile(rf"(?P<plus>plus\b[ \t]*|\+[ \t]*)|(?P<dot>[ \t]+(?:{_DOT_WORDS})[ \t]+)|(?P<digit>(?<![^\W_])(?:{_DIGIT})(?![^\W_]))|(?P<gap>[ \t,./()-]+)", re.IGNORECASE)
_WORD = re.compile(r"[^\W_]+")
# Spelled digits that are articles as well.
_ARTICLES = frozenset(("un", "uno", "one"))
_DOT_WORD = frozenset(_DOT_WORDS.split("|"))
#: Four numbers or spelled digits in a row, dots between; one spelled digit among them.
_SOME_SPELLED = re.compile(r"(?=[nd.]*n)(?:[nd]\.*){4}")
#: Letters that match s and i where case is ignored.
_FOLD = str.maketrans("ſıİ", "sii")
#: What every rewritten address has: a hidden @ in any form but a word, or a hidden dot. (A word needs a dot as well.)
_HIDDEN = re.compile(
    rf"[\[({{<][ \t]*(?:{_AT_WORDS}|{_DOT_WORDS}|@|\.)[ \t]*[\])}}>]|[ \t]@|@[ \t]|[ \t_-](?:{_DOT_WORDS})[ \t_-]", re.IGNORECASE
)


def _name_start(text: str, stop: int, low: int, dots: dict[int, int]) -> int:
    """Where the name that ends at ``stop`` begins: runs of its signs, joined by dots, plain or hidden.

    ``dots`` has the start of each hidden dot by its end. A run does not begin with ``_``.
    """
    start = stop
    while True:
        at = start
        while at > low and text[at - 1] in _NAME_SIGNS:
            at -= 1
        while at < start and text[at] == "_":
            at += 1
        if at == start:
            break
        start = at
        joint = start - 1 if start > low and text[start - 1] == "." else dots.get(start, -1)
        if joint <= low or text[joint - 1] not in _NAME_SIGNS:
            break
        before = joint
        while before > low and text[before - 1] in _NAME_SIGNS:
            before -= 1
        if text[before:joint].strip("_") == "":
            break
        start = joint
    return start


def _hidden_dots(text: str) -> dict[int, int]:
    """The start of each hidden dot by its end; blanks before it are its own, also those that end another."""
    found = {}
    for d in _DOT.finditer(text):
        start = d.start()
        while start and text[start - 1] in " \t":
            start -= 1
        found[d.end()] = start
    return found


def _addresses(m: Mapped) -> Mapped:
    """Hidden signs of e-mail addresses written out, and hidden dots of IP addresses."""
    edits, last = [], 0
    hidden = _hidden_dots(m.text)
    for at in _AT.finditer(m.text):
        domain = _DOMAIN.match(m.text, at.end())
        if not domain:
            continue
        start = _name_start(m.text, at.start(), last, hidden)
        if start == at.start():
            continue
        dots = list(_DOT.finditer(m.text, at.end(), domain.end()))
        end = domain.group().rsplit(".", 1)[-1] if not dots else m.text[max(dots[-1].end(), m.text.rfind(".", at.end(), domain.end()) + 1) : domain.end()]
        if at["word"] and not (dots and _TLD.match(end)):
            continue  # "look at example.com" is no address
        if dots and not at["sure"] and not _TLD.match(end):
            continue
        before = list(_DOT.finditer(m.text, start, at.start())) if not at["word"] or dots else []
        own = [(d.start(), d.end(), ".") for d in before]
        if not at["plain"]:
            own.append((at.start(), at.end(), "@"))
        own += [(d.start(), d.end(), ".") for d in dots]
        edits += [e for e in own if e[0] >= last]
        last = max(last, domain.end())
    return m.rewrite(sorted(edits))


def _numbers(m: Mapped, tight: bool) -> Mapped:
    """Spelled digits written as digits; ``tight`` closes the gaps between them."""
    edits = []
    for run in _SPELLED.finditer(m.text):
        own: list[tuple[int, int, str]] = []
        for p in _SPELLED_PART.finditer(m.text, *run.span()):
            if p["plus"]:
                new = "+"
            elif p["dot"]:
                new = "."
            elif p["digit"]:
                new = DIGIT_WORDS[p.group().translate(_FOLD).lower()]
            else:
                plain = p.group() == "-" or "(" in p.group() or ")" in p.group()
                # A full stop beside a number written in digits is that of an address.
                beside = m.text[p.start() - 1 : p.start()] + m.text[p.end() : p.end() + 1]
                stop = p.group() == "." and any(c in "0123456789" for c in beside)
                new = ("." if stop else "") if tight else p.group() if plain else " "
            if new != p.group():
                own.append((p.start(), p.end(), new))
        if any(new.isdigit() for _, _, new in own):
            edits += own
    return m.rewrite(edits)


def _hidden_ips(m: Mapped) -> Mapped:
    edits = []
    for run in re.finditer(rf"(?<![0-9])[0-9]{{1,3}}(?:(?:\.|{_HIDDEN_DOT})[0-9]{{1,3}}){{3}}(?![0-9])", m.text, re.IGNORECASE):
        edits += [(d.start(), d.end(), ".") for d in _DOT.finditer(m.text, *run.span())]
    return m.rewrite(edits)


def _letter(word: str) -> str:
    """What a word may be in a spelled number: a spelled digit, digits, a dot, or no part of it."""
    if word in DIGIT_WORDS:
        return "n"
    return "." if word in _DOT_WORD else "d" if word.isascii() and word.isdigit() else "x"


def disguised_spans(text: str) -> dict[str, set[tuple[int, int]]]:
    """Source spans found only after normalisation."""
    found: dict[str, set[tuple[int, int]]] = {k: set() for k in KINDS}
    unusual = not text.isascii() and _UNUSUAL.search(text)
    base = _characters(Mapped.of(text)) if unusual else Mapped.of(text)
    hidden = _HIDDEN.search(base.text)
    words = _WORD.findall(base.text.translate(_FOLD).lower() if unusual or not text.isascii() else text.lower())
    spelled = not DIGIT_WORDS.keys().isdisjoint(words) and _SOME_SPELLED.search("".join(map(_letter, words)))
    copies: list[tuple[Mapped, tuple[str, ...]]] = []
    if hidden:
        copies.append((_addresses(base), ("email",)))
        copies.append((_hidden_ips(base), ("ip",)))
    if spelled:
        copies.append((_numbers(base, tight=False), ("card", "phone")))
        copies.append((_numbers(base, tight=True), ("ip",)))
    if unusual:
        copies.append((base, KINDS))
    for copy, kinds in copies:
        if copy.changed.any() or len(copy.text) != len(text):
            spans = plain_spans(copy.text)
            for kind in kinds:
                for a, b in spans[kind]:
                    start, stop = copy.source(a, b)
                    if copy.changed[a:b].any() or stop - start != b - a:
                        found[kind].add((start, stop))
    return found


def _adds_an_article(text: str, span: tuple[int, int], own: list[tuple[int, int]], i: int) -> bool:
    """Whether ``span`` is a plain one with a word beside it that is a digit, but more often an article."""
    for a, b in own[max(0, i - 1) : i + 1]:
        if span[0] <= a and b <= span[1]:
            return (text[span[0] : a] + text[b : span[1]]).strip(" \t,./()-").lower() in _ARTICLES
    return False


def find_spans(text: str) -> list[Span]:
    """All spans, by kind, then start, then end."""
    plain, hidden = plain_spans(text), disguised_spans(text)
    out = []
    for kind in KINDS:
        own = plain[kind]
        starts = [a for a, _ in own]
        added = [s for s in hidden[kind] if not (i := bisect_right(starts, s[0])) or own[i - 1][1] < s[1]]
        added = [s for s in added if not _adds_an_article(text, s, own, bisect_right(starts, s[0]))]
        out += sorted([*(Span(kind, a, b, False) for a, b in own), *(Span(kind, a, b, True) for a, b in added)], key=lambda s: s[1:])
    return out


def redact(text: str) -> str:
    """``text`` with every identified range replaced by its kind in brackets."""
    spans = sorted(find_spans(text), key=lambda s: (s.start, -s.stop))
    parts, at = [], 0
    for s in spans:
        if s.start >= at:
            parts += [text[at : s.start], f"[{s.kind.upper()}]"]
        at = max(at, s.stop)
    return "".join([*parts, text[at:]]) if parts else text


@F.arrow_udf(SPANS)
def pii_spans(texts: pa.Array) -> pa.Array:
    """Column form of :func:`find_spans`."""
    rows = [[s._asdict() for s in find_spans(t.as_py() or "")] for t in texts]
    kind = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("stop", pa.int32()), ("disguised", pa.bool_())])
    return pa.array(rows, pa.list_(kind))


@F.arrow_udf(T.StringType())
def _redacted(texts: pa.Array) -> pa.Array:
    return pa.array([None if (text := t.as_py()) is None else redact(text) for t in texts], pa.string())


def redact_documents(docs: DataFrame, length_col: str | None = "n_chars") -> DataFrame:
    """``docs`` with ``text`` redacted, and ``length_col``, if there, counted anew; null texts stay null."""
    out = docs.withColumn("text", _redacted(F.col("text")))
    if length_col in docs.columns:
        kind = docs.schema[length_col].dataType
        out = out.withColumn(length_col, F.char_length("text").cast(kind))
    return out


def span_list(spans: Column) -> Column:
    """``kind:start:end`` of each span, joined by commas."""
    one = F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["stop"]))
    return F.array_join(one, ",")
