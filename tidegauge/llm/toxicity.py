"""Toxicity of documents whose words may be disguised.

Restoring. A token with digits or symbols inside a word, a letter repeated three
times or more, or single letters set apart (``i d i o t``) is taken as what a
noisy channel made of a plain word. Each character opens a column of a lattice:
itself, the letters it may stand for, or nothing (separators and repeated
letters). Viterbi decoding finds the cheapest path under a character trigram model,
whose counts are taken over all documents, plus the cost of each substitution. A token
with separators is read twice: as one word, and with separators that may also end a
word, at the model's price, so that a spelled-out sentence falls into its words. Tokens
and runs of any length are decoded whole, in time linear in them.

Scoring. Words and their beginnings get a weight from labelled documents: the lower
confidence bound of the log odds of appearing in a toxic document. A document is
described by its strongest weights, over its plain and its restored words, and a
logistic regression turns these into a score; weights used for fitting that
regression come from the other half of the labelled documents.

Labels come from about ``PER_CLASS`` documents of either label, chosen by a hash of
the id; the trigram counts cover all documents. Null and empty texts have no words
and get the score of a document without any weight. If a label is missing
altogether every document scores 0. Repeated rows are scored each; an empty table
gives none; other columns are not read.
"""

from __future__ import annotations

import re
import string
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tidegauge.llm.learning import fit_logistic, label_sample, sigmoid

PER_CLASS = 10_000
THRESHOLD = 0.7
#: Confidence bound in standard errors, and the least weight that is kept.
ERRORS, LEAST_WEIGHT = 2.5, 0.5
#: Beginnings of words that are features of their own, in characters.
STEMS = (5, 6, 7, 8)
STRONGEST = 3

# Letters that a digit or symbol may stand for.
LEET = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "il", "|": "il", "+": "t", "(": "c", "<": "c", "€": "e", "£": "l",
}
SEPARATORS = " .-_*~·"
_COST_LEET, _COST_GAP, _COST_REPEAT, _COST_KEEP = 0.7, 0.7, 0.9, 6.0
#: Restored words of tokens up to this length are kept for the next time (longer ones are decoded anew).
_KEPT = 64

_LETTERS = "abcdefghijklmnopqrstuvwxyz"
_EDGE, _OTHER = 0, 27
_K = 28
_SYMBOL = {c: i + 1 for i, c in enumerate(_LETTERS)}

_BYTE_SYMBOL = np.zeros(256, np.int16)
for _c, _i in _SYMBOL.items():
    _BYTE_SYMBOL[ord(_c)] = _BYTE_SYMBOL[ord(_c.upper())] = _i
_BYTE_SYMBOL[0x80:0xC0] = -1  # the rest of a character
_BYTE_SYMBOL[0xC3:] = _OTHER

_STRIP = string.punctuation + "…«»“”„‘’¡¿"
#: Marks around words that stand for no letter.
_MARKS = "".join(c for c in _STRIP if c not in LEET)
_SPACED = re.compile(r"(?<![^\W_])[^\W_](?:([ .\-_*~·])[^\W_]\1)(?:[^\W_]\1)*[^\W_](?![^\W_])")
_RUN = re.compile(r"([^\W\d_])\1\1")
_INNER = re.compile(r"[^\W\d_][0-9@$!|+(<€£.\-_*~·]+[^\W\d_]|^[0-9@$!|+(<€£]+[^\W\d_]{2}|[^\W\d_]{2}[0-9@$!|+(<€£]+$")


# --- the character model -----------------------------------------------------


def trigram_counts(docs: DataFrame) -> np.ndarray:
    """Counts of letter trigrams over all texts; at most 28 to the third numbers."""

    def run(batches):
        total = np.zeros(_K**3, np.int64)
        held, size = [], 0
        for batch in batches:
            for text in batch.column(0).cast(pa.binary()):
                held.append(text.as_py() or b"")
                size += len(held[-1])
                if size > _TOGETHER:
                    total += _trigrams(held)
                    held, size = [], 0
        total += _trigrams(held)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], names=["trigram", "n"])

    rows = docs.select("text").mapInArrow(run, "trigram int, n long").groupBy("trigram").agg(F.sum("n").alias("n"))
    counts = np.zeros(_K**3, np.int64)
    for r in rows.collect():
        counts[r["trigram"]] = r["n"]
    return counts.reshape(_K, _K, _K)


#: Bytes of text that are counted together.
_TOGETHER = 4_000_000


def _trigrams(texts: list[bytes]) -> np.ndarray:
    """Trigrams of each text with an edge before and after it."""
    if not any(texts):
        return np.zeros(_K**3, np.int64)
    # A newline maps to an edge, as any other byte that is no letter does.
    s = _BYTE_SYMBOL[np.frombuffer(b"".join(b"\n%b\n" % t for t in texts if t), np.uint8)]
    of = np.repeat(np.arange(sum(map(bool, texts))), [len(t) + 2 for t in texts if t])
    of, s = of[s >= 0], s[s >= 0].astype(np.int64)
    whole = of[:-2] == of[2:]
    codes = s[:-2] * (_K * _K) + s[1:-1] * _K + s[2:]
    return np.bincount(codes[whole], minlength=_K**3)


def trigram_costs(counts: np.ndarray) -> np.ndarray:
    """Negative log probabilities of a symbol after two others, smoothed by shorter histories."""
    single = counts.sum((0, 1)) + 1.0
    single = single / single.sum()
    double = counts.sum(0) + 20.0 * single
    double = double / double.sum(1, keepdims=True)
    triple = counts + 20.0 * double[None]
    return -np.log(triple / triple.sum(2, keepdims=True))


def restore(token: str, costs: np.ndarray, split: bool = False) -> str:
    """The cheapest plain word behind a lower-case token; with ``split`` words, apart by spaces."""
    # A state is the last two symbols; a path is a chain of (letter, path before).
    paths: dict = {(_EDGE, _EDGE): (0.0, None)}
    before, runs = "", set(_RUN.findall(token))
    for ch in token:
        options: list[tuple[str, int, float]] = []  # letter written, its symbol (-1: none), cost
        if ch.isalpha():
            options.append((ch, _SYMBOL.get(ch, _OTHER), 0.0))
            if ch == before:
                options.append(("", -1, _COST_REPEAT / 3 if ch in runs else _COST_REPEAT))
        else:
            options += [(c, _SYMBOL[c], _COST_LEET) for c in LEET.get(ch, "")]
            options.append(("", -1, _COST_GAP if ch in SEPARATORS else _COST_KEEP))
            if split and ch in SEPARATORS:
                options.append((" ", _EDGE, _COST_GAP))
        before = ch
        following: dict = {}
        for (a, b), (cost, path) in paths.items():
            for out, c, extra in options:
                if c >= 0:
                    state, total = (b, c), cost + extra + costs[a, b, c]
                else:
                    state, total = (a, b), cost + extra
                if state not in following or total < following[state][0]:
                    following[state] = (total, (out, path) if out else path)
        paths = following
    _, path = min(((cost + costs[a, b, _EDGE], path) for (a, b), (cost, path) in paths.items()), key=lambda p: p[0])
    letters = []
    while path is not None:
        letter, path = path
        letters.append(letter)
    return "".join(reversed(letters))


class Restorer:
    """Plain words of texts, and the restored words of disguised tokens."""

    def __init__(self, costs: np.ndarray):
        self.costs, self.known = costs, {}

    def _plain(self, token: str) -> tuple[str, ...]:
        found = self.known.get(token)
        if found is None:
            found = {restore(token, self.costs)}
            if not _SEPARATED.isdisjoint(token):
                found.update(restore(token, self.costs, split=True).split())
            found = tuple(found)
            if len(token) <= _KEPT:
                if len(self.known) > 200_000:
                    self.known.clear()
                self.known[token] = found
        return found

    def words(self, text: str) -> set[str]:
        """Distinct lower-case words, without marks around them, and restored ones."""
        low = text.lower()
        tokens = set(low.split())
        found = {w.strip(_STRIP) for w in tokens}
        # A sign at an end may be a letter or a mark: either end is read both ways.
        signed = {w.strip(_MARKS) for w in tokens} - found
        signed |= {w.lstrip(_STRIP) for w in signed} | {w.rstrip(_STRIP) for w in signed}
        odd = {w for w in found | signed if not w.isalpha() and len(w) > 2 and _INNER.search(w)}
        if _RUN.search(low):
            odd.update(w for w in found if _RUN.search(w))
        if _may_be_spaced(low):
            odd.update(m.group() for m in _SPACED.finditer(low))
        for w in odd:
            found.update(self._plain(w))
        found.discard("")
        return found


_SEPARATED = frozenset(SEPARATORS)
_IS_SEP = np.zeros(257, bool)
_IS_SEP[[ord(c) for c in SEPARATORS]] = True


def _may_be_spaced(low: str) -> bool:
    """Whether one separator stands twice with a single character between, as in every spaced run."""
    codes = np.frombuffer(low.encode("utf-32-le", "surrogatepass"), np.uint32)
    return len(codes) > 4 and bool((_IS_SEP[np.minimum(codes[:-2], 256)] & (codes[:-2] == codes[2:])).any())


# --- weights -----------------------------------------------------------------


def _features(words: set[str]) -> set[str]:
    stems = {w[:n] + "-" for w in words if len(w) > STEMS[0] for n in STEMS if len(w) > n}
    return words | stems


def _weights(toxic: np.ndarray, clean: np.ndarray, n_toxic: int, n_clean: int) -> np.ndarray:
    odds = np.log((toxic + 0.5) / (n_toxic + 1.0)) - np.log((clean + 0.5) / (n_clean + 1.0))
    return odds - ERRORS * np.sqrt(1 / (toxic + 0.5) + 1 / (clean + 0.5))


@dataclass(frozen=True)
class ToxicityModel:
    """Trigram costs, weights of features, and the regression over the strongest."""

    costs: np.ndarray
    weights: dict[str, float] = field(repr=False)
    regression: np.ndarray | None
    shift: float = 0.0

    def strengths(self, words: set[str]) -> list[float]:
        return _strengths(words, self.weights)

    def score(self, rows: np.ndarray) -> np.ndarray:
        if self.regression is None:
            return np.zeros(len(rows))
        return sigmoid(_design(rows) @ self.regression + self.shift)


def _strengths(words: set[str], weights: dict[str, float]) -> list[float]:
    get = weights.get
    best = []
    for w in words:
        v = get(w, 0.0)
        n = len(w)
        if n > 5:
            for k in STEMS:
                if k >= n:
                    break
                u = get(w[:k] + "-")
                if u is not None and u > v:
                    v = u
        if v:
            best.append(v)
    best.sort(reverse=True)
    return [*best[:STRONGEST], *[0.0] * (STRONGEST - len(best)), float(np.log1p(len(best))), float(np.log1p(len(words)))]


def _design(rows: np.ndarray) -> np.ndarray:
    return np.column_stack([rows, rows[:, :1] ** 2, np.ones(len(rows))])


def fit_toxicity(docs: DataFrame, labels: DataFrame, label_col: str = "toxic", per_class: int = PER_CLASS) -> ToxicityModel:
    """Fit on the labelled documents; ``labels`` has ``doc_id`` and the label."""
    spark = docs.sparkSession
    costs = trigram_costs(trigram_counts(docs))
    sent = spark.sparkContext.broadcast(costs)
    chosen = label_sample(labels, label_col, per_class).select(F.col("doc_id").alias("labelled_id"), "label")
    half = F.pmod(F.xxhash64(F.lit("half"), "labelled_id"), F.lit(2)).cast("int")
    # At most a few rows per class and id: small enough to send to every executor.
    joined = docs.select("doc_id", "text").join(F.broadcast(chosen), F.col("doc_id") == F.col("labelled_id"))
    joined = joined.select("text", (F.col("label") * 2 + half).alias("kind"))

    def count(batches):
        restorer, seen, documents = Restorer(sent.value), [Counter() for _ in range(4)], [0] * 4
        names = ["feature", "kind", "n"]

        def out():
            for kind, counter in enumerate(seen):
                if counter:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(list(counter), pa.string()), pa.array([kind] * len(counter), pa.int32()),
                         pa.array(list(counter.values()), pa.int64())], names=names)
                    counter.clear()

        for batch in batches:
            for text, kind in zip(batch.column(0), batch.column(1).to_pylist()):
                seen[kind].update(_features(restorer.words(text.as_py() or "")))
                documents[kind] += 1
                if sum(map(len, seen)) > 500_000:
                    yield from out()
        yield from out()
        yield pa.RecordBatch.from_arrays(
            [pa.array([None] * 4, pa.string()), pa.array(range(4), pa.int32()), pa.array(documents, pa.int64())], names=names
        )

    counted = joined.mapInArrow(count, "feature string, kind int, n long")
    sums = [F.sum(F.when(F.col("kind") == k, F.col("n")).otherwise(0)).alias(f"n{k}") for k in range(4)]
    # Few features are seen in more than a handful of toxic documents: only those come to the driver.
    kept = counted.groupBy("feature").agg(*sums).filter("feature IS NULL OR n2 + n3 > 2 AND n2 + n3 > (n0 + n1) / 20")
    table = kept.toArrow()
    n = np.column_stack([table.column(f"n{k}").to_numpy() for k in range(4)]).astype(float).reshape(-1, 4)
    names = table.column("feature").to_pylist()
    whole = names.index(None) if None in names else None
    totals = n[whole] if whole is not None else np.zeros(4)
    if min(totals[0] + totals[1], totals[2] + totals[3]) == 0:
        return ToxicityModel(costs, {}, None)

    def weights(kinds: tuple[int, ...]) -> dict[str, float]:
        toxic, clean = (sum(n[:, k + 2] for k in kinds), sum(n[:, k] for k in kinds))
        values = _weights(toxic, clean, sum(totals[k + 2] for k in kinds), sum(totals[k] for k in kinds))
        return {f: float(v) for f, v in zip(names, values) if f is not None and v > LEAST_WEIGHT}

    other_half = spark.sparkContext.broadcast([weights((1,)), weights((0,))])

    def describe(batches):
        restorer = Restorer(sent.value)
        for batch in batches:
            kinds = batch.column(1).to_pylist()
            rows = [
                _strengths(restorer.words(t.as_py() or ""), other_half.value[k % 2]) for t, k in zip(batch.column(0), kinds)
            ]
            yield pa.RecordBatch.from_arrays(
                [pa.array(kinds, pa.int32()), pa.array(rows, pa.list_(pa.float64()))], names=["kind", "row"]
            )

    rows = joined.mapInArrow(describe, "kind int, row array<double>").toArrow()
    y = rows.column("kind").to_numpy() // 2
    x = np.array(rows.column("row").to_pylist()).reshape(-1, STRONGEST + 2)
    order = np.lexsort([*x.T, y])  # the same fit however rows arrive
    x, y = x[order], y[order]
    regression = fit_logistic(_design(x), y, ridge=1.0)
    # Toxic documents are over-represented in the sample: weigh back, and cut where F1 is best.
    known = labels.select(F.col(label_col).cast("int").alias("y")).filter(F.col("y").isin(0, 1))
    share = known.agg(F.avg("y")).first()[0]
    margin = _design(x) @ regression
    order = np.argsort(-margin, kind="stable")
    hit = np.where(y == 1, share / (y == 1).sum(), 0.0)[order].cumsum()
    miss = np.where(y == 0, (1 - share) / (y == 0).sum(), 0.0)[order].cumsum()
    f1 = 2 * hit / (hit + miss + share)
    at = int(np.argmax(f1))
    edge = margin[order]
    cut = (edge[at] + edge[min(at + 1, len(edge) - 1)]) / 2
    return ToxicityModel(costs, weights((0, 1)), regression, float(np.log(THRESHOLD / (1 - THRESHOLD)) - cut))


def toxicity_score(docs: DataFrame, model: ToxicityModel, text: Column) -> Column:
    """Score of a text column of ``docs``, 0 to 1."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        m = sent.value
        restorer = _restorer(m.costs)
        rows = np.array([m.strengths(restorer.words(t.as_py() or "")) for t in texts]).reshape(-1, STRONGEST + 2)
        return pa.array(m.score(rows))

    return score.asNondeterministic()(text)  # computed once, never copied into filters


_RESTORERS: dict[bytes, Restorer] = {}


def _restorer(costs: np.ndarray) -> Restorer:
    """The restorer of this process for ``costs``; one is kept, so its words stay known."""
    key = costs.tobytes()[:4096]
    if key not in _RESTORERS:
        _RESTORERS.clear()
        _RESTORERS[key] = Restorer(costs)
    return _RESTORERS[key]
