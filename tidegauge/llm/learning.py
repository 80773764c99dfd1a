"""Label samples, linear models fitted on the driver or by passes over a table, and exact ranks."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame, functions as F


def label_sample(labels: DataFrame, label_col: str, per_class: int, id_col: str = "doc_id") -> DataFrame:
    """``id_col`` and ``label`` (0 or 1) of about ``per_class`` rows of either label.

    Rows are chosen by a hash of the id, so the choice is the same in every run;
    ids or labels that are null, and labels other than 0 and 1, are left out.
    """
    label = F.col(label_col).cast("int")
    known = labels.select(id_col, label.alias("label")).filter(F.col(id_col).isNotNull() & F.col("label").isin(0, 1))
    counts = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}
    scale = 1 << 30
    share = F.lit(0)
    for value, n in counts.items():
        share = F.when(F.col("label") == value, int(scale * min(1.0, per_class / n))).otherwise(share)
    return known.filter(F.pmod(F.xxhash64(id_col), F.lit(scale)) < share)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1.0 + np.tanh(0.5 * np.asarray(x, dtype=float)))


def fit_logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray | None = None, ridge: float = 1.0) -> np.ndarray:
    """Weights of a logistic regression by damped Newton steps; a column of ones makes an intercept."""
    w = np.zeros(x.shape[1])
    weight = np.ones(len(y)) if weight is None else weight

    def loss(v: np.ndarray) -> float:
        m = x @ v
        return float(weight @ (np.logaddexp(0.0, m) - y * m) + 0.5 * ridge * v @ v)

    now = loss(w)
    for _ in range(50):
        p = sigmoid(x @ w)
        gradient = x.T @ (weight * (p - y)) + ridge * w
        curvature = (x * (weight * p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        step = np.linalg.solve(curvature, gradient)
        size = 1.0
        while size > 1e-4 and loss(w - size * step) > now:
            size /= 2
        w, before = w - size * step, now
        now = loss(w)
        if before - now < 1e-9 * max(1.0, before):
            break
    return w


def fit_newton(evaluate: Callable[[np.ndarray], tuple[float, np.ndarray, np.ndarray]], size: int, ridge: float) -> np.ndarray:
    """Weights of least loss by damped Newton steps; ``evaluate`` gives loss, gradient and curvature at a point.

    Every call may be a pass over a table: a step that is taken needs no second one.
    """

    def at(v: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        loss, gradient, curvature = evaluate(v)
        return loss + 0.5 * ridge * v @ v, gradient + ridge * v, curvature + ridge * np.eye(size)

    w = np.zeros(size)
    now, gradient, curvature = at(w)
    for _ in range(50):
        step, share = np.linalg.solve(curvature, gradient), 1.0
        found = at(w - step)
        while found[0] > now and share > 1e-4:
            share /= 2
            found = at(w - share * step)
        if found[0] >= now:
            break
        w, before = w - share * step, now
        now, gradient, curvature = found
        if before - now < 1e-9 * max(1.0, before):
            break
    return w


def value_at_rank(df: DataFrame, column: str, rank: int, bins: int = 4096, few: int = 100_000) -> float:
    """The value with ``rank`` smaller rows before it, exactly: bins are counted, and the one that holds it is cut anew."""
    rows = df.select(F.col(column).alias("v"))
    while True:
        n, low, high = rows.agg(F.count("v"), F.min("v"), F.max("v")).first()
        if n <= few:
            return float(np.sort(rows.toArrow().column(0).to_numpy())[rank])
        if low == high:
            return float(low)
        place = F.least(F.floor((F.col("v") - low) / (high - low) * bins), F.lit(bins - 1))
        held = None
        for at, count in sorted(tuple(r) for r in rows.groupBy(place.alias("at")).count().collect()):
            if rank < count:
                held = at
                break
            rank -= count
        rows = rows.filter(place == held)
