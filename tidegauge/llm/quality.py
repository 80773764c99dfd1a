"""Document quality by a Bradley-Terry model of pairwise preferences.

A document of label 1 is preferred to one of label 0. The probability that ``a``
is preferred to ``b`` is the logistic function of ``w . (f(a) - f(b))``, where
``f`` are features of the whole text, so fitting ``w`` is a logistic regression on
feature differences. A document's strength ``w . f`` is then compared with a
quantile of the training strengths: the share of label 0 among the labels. The
score is the logistic function of the distance, shifted so that the quantile has
score 0.7; documents at or above it are good.

Fitting reads every labelled document. Their features are computed once and dealt to
groups of about ``GROUP`` by a hash of the id, into which the rarer label goes often enough
for each to have some; in a group each document meets ``MEETINGS`` or more of the other
label. Means, losses and ranks are sums over all groups, a pass over the stored features
each. Null and empty texts have
the features of an empty text and are scored like others. If a label is missing
altogether there are no pairs and all documents score 0.7. Texts of any length are
read whole; documents of equal strength have equal scores. Repeated rows are scored each; an empty table gives none; other columns are not read.
"""

from __future__ import annotations

import zlib
from collections import Counter
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tidegauge.llm.common import fresh_name, remove, stored
from tidegauge.llm.learning import fit_newton, sigmoid, value_at_rank

#: Documents of a group, of these at least of the rarer label, and meetings of a document.
GROUP, RARER, MEETINGS = 4_096, 64, 16
#: All pairs together weigh as much as so many.
PAIRS = 60_000
RIDGE = 20.0
#: Labelled ids that are broadcast at most.
BROADCAST_ROWS = 1_000_000
THRESHOLD = 0.7

# Groups of bytes whose shares are features.
_GROUPS = (
    b"ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    b"abcdefghijklmnopqrstuvwxyz",
    b"0123456789",
    b" \t",
    b"\n",
    b".",
    b",;:",
    b"!",
    b"?",
    b"\"'()",
    b"|",
    b"#$%&*",
    b"+-/<=>@[\\]^_`{}~",
    bytes(range(128, 256)),
)
_SHARES = np.zeros((256, len(_GROUPS)))
for _j, _g in enumerate(_GROUPS):
    _SHARES[list(_g), _j] = 1.0
N_FEATURES = 2 * len(_GROUPS) + 12


def text_features(text: bytes) -> np.ndarray:
    """Shares of byte groups, and measures of words, lines and repetition."""
    counts = np.bincount(np.frombuffer(text, np.uint8), minlength=256) if text else np.zeros(256)
    shares = counts @ _SHARES / max(1, len(text))
    words = text.split()
    n = max(1, len(words))
    seen = Counter(words)
    lines = text.split(b"\n")
    n_lines = len(lines)
    letters = max(1e-9, shares[0] + shares[1])
    rest = [
        np.log1p(len(words)),
        len(text) / n / 10,
        len(seen) / n,
        len(seen) / np.sqrt(n) / 10,
        max(seen.values(), default=0) / n,
        sum(map(eq, words, words[1:])) / n,
        len(set(lines)) / n_lines,
        np.log1p(len(words) / n_lines),
        len(zlib.compress(text, 1)) / max(8, len(text)),
        shares[0] / letters,
        np.log1p(len(words) / (1 + counts[46] + counts[33] + counts[63])),
        float(not words),
    ]
    return np.concatenate([shares, np.sqrt(shares), rest])


@dataclass(frozen=True)
class QualityModel:
    """Feature means and scales, weights, and the strength that scores ``THRESHOLD``."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    cut: float

    def score(self, features: np.ndarray) -> np.ndarray:
        # Features far outside the training range count as its edge.
        z = np.clip((features - self.mean) / self.scale, -8, 8)
        return sigmoid(z @ self.weights - self.cut + np.log(THRESHOLD / (1 - THRESHOLD)))


def _feature_rows(texts: pa.Array) -> np.ndarray:
    return np.array([text_features(t.as_py() or b"") for t in texts.cast(pa.binary())]).reshape(-1, N_FEATURES)


def _labelled_features(docs: DataFrame, labels: DataFrame, label_col: str) -> DataFrame:
    """``label_id``, ``label`` and ``features`` of every labelled document."""
    label = F.col(label_col).cast("int")
    known = labels.select(F.col("doc_id").alias("label_id"), label.alias("label"))
    known = known.filter(F.col("label_id").isNotNull() & F.col("label").isin(0, 1))

    def run(batches):
        for batch in batches:
            flat = pa.array(_feature_rows(batch.column("text")).ravel())
            offsets = pa.array(np.arange(0, len(flat) + 1, N_FEATURES, dtype=np.int32))
            kept = [batch.column(c) for c in range(batch.num_columns - 1)]
            names = [*batch.schema.names[:-1], "features"]
            yield pa.RecordBatch.from_arrays([*kept, pa.ListArray.from_arrays(offsets, flat)], names=names)

    of = docs.select("doc_id", "text")
    same = F.col("doc_id") == F.col("label_id")
    kind = of.schema["doc_id"].dataType.simpleString()
    if known.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        joined = of.join(F.broadcast(known), same).select("label_id", "label", "text")
        kind = known.schema["label_id"].dataType.simpleString()
        return joined.mapInArrow(run, f"label_id {kind}, label int, features array<double>")
    # Features are far shorter than texts: these stay where they are.
    features = of.mapInArrow(run, f"doc_id {kind}, features array<double>")
    return features.join(known, same).select("label_id", "label", "features")


def _grouped(rows: DataFrame, counts: dict[int, int]) -> DataFrame:
    """A row per group: ``good`` and ``bad``, the features of its documents, in an order of their own."""
    groups = -(-sum(counts.values()) // GROUP)
    rarer = min(counts, key=lambda k: (counts[k], k))
    copies = min(groups, max(1, -(-RARER * groups // counts[rarer])))
    first = F.pmod(F.xxhash64("label_id"), F.lit(groups))
    places = F.when(F.col("label") == rarer, F.sequence(F.lit(0), F.lit(copies - 1))).otherwise(F.array(F.lit(0)))
    # Copies go to groups next to each other, so that none gets one twice.
    dealt = rows.select("label", "features", first.alias("first"), F.explode(places).alias("place"))
    dealt = dealt.select(((F.col("first") + F.col("place")) % groups).alias("team"), "label", "features")

    def run(table: pa.Table) -> pa.Table:
        y = table.column("label").to_numpy()
        x = table.column("features").combine_chunks().flatten().to_numpy().reshape(-1, N_FEATURES)
        order = np.lexsort([*x.T, y])  # the same pairs however rows arrive
        x, y = x[order], y[order]
        x = x[mixed := np.random.default_rng(0).permutation(len(y))]
        y = y[mixed]
        return pa.table({"good": pa.array([x[y == 1].tobytes()], pa.binary()), "bad": pa.array([x[y == 0].tobytes()], pa.binary())})

    return dealt.groupBy("team").applyInArrow(run, "good binary, bad binary")


def _sums(rows: DataFrame, of_batch) -> np.ndarray:
    """The sum of ``of_batch`` over all Arrow batches of ``rows``; a task sends one row."""

    def run(batches):
        total = 0.0
        for batch in batches:
            if batch.num_rows:
                total = total + of_batch(batch)
        if not np.isscalar(total):
            yield pa.RecordBatch.from_pydict({"sums": pa.array([total.tolist()], pa.list_(pa.float64()))})

    return np.sum([r[0] for r in rows.mapInArrow(run, "sums array<double>").collect()], axis=0)


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column("features").flatten().to_numpy().reshape(-1, N_FEATURES)


def fit_quality(docs: DataFrame, labels: DataFrame, label_col: str = "quality") -> QualityModel:
    """Fit on all labelled documents; ``labels`` has ``doc_id`` and the label."""
    rows = stored(_labelled_features(docs, labels, label_col), "quality-features")
    counts = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}
    if len(counts) < 2:
        remove(rows)
        return QualityModel(np.zeros(N_FEATURES), np.ones(N_FEATURES), np.zeros(N_FEATURES), 0.0)
    n = sum(counts.values())
    mean = _sums(rows, lambda b: _matrix(b).sum(0)) / n
    scale = np.sqrt(_sums(rows, lambda b: ((_matrix(b) - mean) ** 2).sum(0)) / n)
    scale[scale < 1e-9] = 1.0
    teams = stored(_grouped(rows, counts), "quality-groups")

    def pairs(good: bytes, bad: bytes) -> np.ndarray:
        g, b = (np.clip((np.frombuffer(v).reshape(-1, N_FEATURES) - mean) / scale, -8, 8) for v in (good, bad))
        if not len(g) or not len(b):
            return np.zeros((0, N_FEATURES))
        most, least = max(len(g), len(b)), min(len(g), len(b))
        # Whoever is in the smaller half meets as many, in turn: none is left out.
        at = np.arange(most)
        turns = [(at + least * k // MEETINGS) % least for k in range(MEETINGS)]
        return np.concatenate([(g - b[t]) if len(g) == most else (g[t] - b) for t in turns])

    def evaluate(w: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        def of_batch(batch: pa.RecordBatch) -> np.ndarray:
            total = np.zeros(2 + N_FEATURES + N_FEATURES**2)
            for good, bad in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                x = pairs(good, bad)
                m = x @ w
                p = sigmoid(m)
                total += np.concatenate([[len(x), np.logaddexp(0.0, -m).sum()], x.T @ (p - 1), ((x * (p * (1 - p))[:, None]).T @ x).ravel()])
            return total

        total = _sums(teams, of_batch)
        total = total[1:] * (PAIRS / max(1.0, total[0]))
        return float(total[0]), total[1 : 1 + N_FEATURES], total[1 + N_FEATURES :].reshape(N_FEATURES, N_FEATURES)

    # Each pair once with either side first would only double the loss.
    weights = fit_newton(evaluate, N_FEATURES, RIDGE)

    def strengths(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"strength": np.clip((_matrix(batch) - mean) / scale, -8, 8) @ weights})

    # The quantile is that of the labels, also of those without a document.
    known = labels.select(F.col(label_col).cast("int").alias("y")).filter(F.col("y").isin(0, 1))
    share = known.agg(F.avg(1 - F.col("y"))).first()[0]
    strong = stored(rows.mapInArrow(strengths, "strength double"), "quality-strengths")
    rank = min(max(1, round(share * n)), n - 1)
    cut = (value_at_rank(strong, "strength", rank - 1) + value_at_rank(strong, "strength", rank)) / 2
    for table in (rows, teams, strong):
        remove(table)
    return QualityModel(mean, scale, weights, float(cut))


def quality_score(model: QualityModel, text: Column) -> Column:
    """Score of a text column, 0 to 1."""

    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        return pa.array(model.score(_feature_rows(texts)))

    return score.asNondeterministic()(text)  # computed once, never copied into filters


def keep_good(docs: DataFrame, model: QualityModel) -> DataFrame:
    """The rows of ``docs`` that score ``THRESHOLD`` or more, all columns kept."""
    name = fresh_name(docs, "quality_score")
    return docs.withColumn(name, quality_score(model, F.col("text"))).filter(F.col(name) >= THRESHOLD).drop(name)
