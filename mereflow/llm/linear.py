"""Small linear models, fitted on bounded samples."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def logistic(a: np.ndarray, y: np.ndarray, weight: np.ndarray | None = None, l2: float = 1.0, rounds: int = 60) -> np.ndarray:
    """Weights of a logistic regression by damped Newton steps; the first column is the intercept and is not shrunk."""
    weight = np.ones(len(y)) if weight is None else weight
    shrink = np.full(a.shape[1], l2)
    shrink[0] = 1e-6
    w = np.zeros(a.shape[1])

    def loss(v):
        z = np.clip(a @ v, -30, 30)
        return (weight * (np.logaddexp(0, z) - y * z)).sum() + (shrink * v * v).sum() / 2

    now = loss(w)
    for _ in range(rounds):
        p = sigmoid(a @ w)
        step = np.linalg.solve(a.T @ (a * (weight * (p * (1 - p) + 1e-9))[:, None]) + np.diag(shrink), a.T @ (weight * (y - p)) - shrink * w)
        size = 1.0
        while size > 1e-4 and (new := loss(w + size * step)) > now:
            size /= 2
        if size <= 1e-4 or now - new < 1e-7 * len(y):
            break
        w, now = w + size * step, new
    return w


def sparse_logistic(index: np.ndarray, cuts: np.ndarray, dense: np.ndarray, y: np.ndarray, weight: np.ndarray, width: int, rounds: int = 80, rate: float = 0.5, l2: float = 1e-4) -> np.ndarray:
    """Weights (width for the present features, then one per dense column, then the intercept) by AdaGrad on all rows."""
    n, extra = len(y), dense.shape[1]
    w, seen = np.zeros(width + extra + 1), np.full(width + extra + 1, 1e-8)
    row = np.repeat(np.arange(n), np.diff(cuts))
    total = weight.sum()
    for _ in range(rounds):
        z = np.bincount(row, w[index], n) + dense @ w[width : width + extra] + w[-1]
        r = weight * (sigmoid(z) - y) / total
        g = np.concatenate([np.bincount(index, r[row], width), dense.T @ r, [r.sum()]]) + l2 * w
        g[-1] -= l2 * w[-1]
        seen += g * g
        w -= rate * g / np.sqrt(seen)
    return w


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, per_class: int, longest: int, id_col: str = "doc_id", text_col: str = "text") -> tuple[list[tuple[str, int]], dict[int, int]]:
    """Up to ``per_class`` (text, label) of each label 0 and 1, in hash order of the id, and how many rows have each label.

    The bound is the sample's: texts of over ``longest`` characters are not drawn, so that it holds at
    most twice per_class times longest characters. Null labels and ids are left out; an id labelled
    more than once counts once, with its largest label; a null text counts as empty.
    """
    own = labels.select(F.col("doc_id").alias("__id"), F.col(label).cast("int").alias("__y")).where("__id is not null and __y in (0, 1)")
    own = own.groupBy("__id").agg(F.max("__y").alias("__y"))
    sizes = {r["__y"]: r["n"] for r in own.groupBy("__y").agg(F.count(F.lit(1)).alias("n")).collect()}
    drawn = None
    for y in (0, 1):
        part = own.where(F.col("__y") == y).orderBy(F.xxhash64("__id"), "__id").limit(per_class)
        drawn = part if drawn is None else drawn.union(part)
    texts = docs.select(F.col(id_col).alias("__id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("t")).where(F.length("t") <= longest)
    rows = texts.join(F.broadcast(drawn), "__id").select("__id", "t", "__y").collect()  # drawn has 2 * per_class rows at most
    seen: dict = {}
    for r in sorted(rows, key=lambda r: (r["__id"], r["t"])):
        seen.setdefault(r["__id"], (r["t"], r["__y"]))
    return list(seen.values()), sizes


def natural(y: np.ndarray, sizes: dict[int, int]) -> np.ndarray:
    """Weights that give a sample the labels' true shares."""
    total = sum(sizes.values())
    share = np.array([sizes.get(k, 0) / total / max(1, (y == k).sum()) for k in (0, 1)])
    return share[y.astype(int)] * len(y)
