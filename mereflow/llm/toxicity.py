"""Toxicity by a classifier chain.

Categories are predicted one after the other by linear models over the words of a text. Every later
model also gets the earlier categories' probabilities; in training these are out-of-fold
predictions, so that later models see them as they will be on new texts. The labels know toxic texts but not their
kinds, so the earlier categories are kinds that the labelled toxic texts fall into by the words that set them apart,
in whatever language; the last is the label itself.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mereflow.llm.common import arrow_rows
from mereflow.llm.linear import labelled_sample, natural, sigmoid, sparse_logistic

WORD = re.compile(r"[^\W\d_]+")
WIDTH = 1 << 20
FOLDS = 4
STEMS = (4, 5, 6)
#: Normal score from which a word's shares among the labels count as different.
SIGNIFICANT = 4.0
#: Kinds of toxic texts before the last category, and the most telling words that part them.
KINDS, TELLING = 3, 512


def _hash(w: str) -> int:
    return zlib.crc32(w.encode("utf-8", "surrogatepass")) % WIDTH


def _features(text: str, known: dict[str, tuple[int, ...]]) -> np.ndarray:
    """Hashed distinct words and their beginnings of 4, 5 and 6 letters, which words with other endings share."""
    out: set[int] = set()
    for w in set(WORD.findall(text.lower())):
        if (k := known.get(w)) is None:
            if len(known) >= 500_000:
                known.clear()
            k = known[w] = (_hash(w), *(_hash(w[:n] + "-") for n in STEMS if len(w) >= n))
        out.update(k)
    return np.fromiter(out, np.int64, len(out))


def _logit(p: np.ndarray) -> np.ndarray:
    return np.log(np.clip(p, 1e-6, 1 - 1e-6) / (1 - np.clip(p, 1e-6, 1 - 1e-6)))


def _kinds(found: list[np.ndarray], telling: np.ndarray, k: int) -> np.ndarray:
    """Kind 0 to k - 1 of each text, the largest first, by spherical k-means over its telling words; -1 for a text without any.

    Centres start at the text least like the centres so far, so that the same texts always give the same kinds.
    """
    place = {int(w): i for i, w in enumerate(telling)}
    x = np.zeros((len(found), len(telling)), np.float32)
    for i, f in enumerate(found):
        x[i, [place[int(w)] for w in f if int(w) in place]] = 1
    size = np.linalg.norm(x, axis=1)
    some = np.flatnonzero(size > 0)
    out = np.full(len(found), -1)
    if not len(some):
        return out
    x = x[some] / size[some, None]
    centres = [x[np.argmax(x @ x.mean(0))]]
    while len(centres) < min(k, len(some)):
        centres.append(x[np.argmin(np.max(np.stack(centres) @ x.T, axis=0))])
    c = np.stack(centres)
    of = None
    for _ in range(50):
        new = np.argmax(x @ c.T, axis=1)
        if of is not None and (new == of).all():
            break
        of = new
        for j in range(len(c)):
            if (of == j).any():
                m = x[of == j].mean(0)
                c[j] = m / max(np.linalg.norm(m), 1e-9)
    order = np.argsort(-np.bincount(of, minlength=len(c)), kind="stable")
    out[some] = np.argsort(order)[of]
    return out


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", per_class: int = 2500, longest: int = 50_000, kinds: int = KINDS, least: int = 3) -> dict:
    """The chain, from at most ``per_class`` labelled texts of each class of at most ``longest`` characters.

    Words of fewer than ``least`` sampled texts have no weight. A category without both sorts of
    examples is its share among the labels.
    """
    rows, sizes = labelled_sample(docs, labels, label, per_class, longest)
    names = [*(f"kind_{k + 1}" for k in range(kinds)), label]
    if not rows:
        return {"names": names, "links": [0.0] * len(names), "slot": np.full(WIDTH, -1, np.int32)}
    known: dict[str, tuple[int, ...]] = {}
    found = [_features(t, known) for t, _ in rows]
    toxic = np.array([v for _, v in rows], float)
    # words that one label holds more often than chance would have it; the rest only fit noise
    in_toxic, in_other = (np.bincount(np.concatenate([f for f, y in zip(found, toxic) if y == k] or [np.empty(0, np.int64)]), minlength=WIDTH) for k in (1, 0))
    n1, n0 = max(1.0, toxic.sum()), max(1.0, (1 - toxic).sum())
    share = (in_toxic + in_other) / (n1 + n0)
    z = (in_toxic / n1 - in_other / n0) / np.sqrt(np.maximum(share * (1 - share), 1e-9) * (1 / n1 + 1 / n0))
    often = (in_toxic + in_other >= least) & (np.abs(z) > SIGNIFICANT)
    slot = np.full(WIDTH, -1, np.int32)
    slot[often] = np.arange(often.sum(), dtype=np.int32)
    of = np.full(len(rows), -1)
    telling = np.flatnonzero(often & (z > 0))
    telling = np.sort(telling[np.argsort(-z[telling], kind="stable")[:TELLING]])
    bad = np.flatnonzero(toxic == 1)
    of[bad] = _kinds([found[i] for i in bad], telling, kinds)
    found = [slot[f][slot[f] >= 0] for f in found]
    weight, width = natural(toxic, sizes), int(often.sum())
    fold = np.arange(len(rows)) % FOLDS
    dense = np.zeros((len(rows), 0))
    links: list = []

    def lay(some):
        return np.concatenate([found[i] for i in some] or [np.empty(0, np.int64)]).astype(np.int64), np.concatenate([[0], np.cumsum([len(found[i]) for i in some])])

    def predict(w, some):
        index, cuts = lay(some)
        z = np.bincount(np.repeat(np.arange(len(some)), np.diff(cuts)), w[index], len(some))
        return sigmoid(z + dense[some] @ w[width:-1] + w[-1])

    for step, name in enumerate(names):
        y = toxic if name == label else (of == step).astype(float)
        everyone = np.arange(len(rows))
        if min(y.sum(), len(y) - y.sum()) < FOLDS:
            links.append(float((y * weight).sum() / weight.sum()))
            out = np.full(len(rows), links[-1])
        else:
            out = np.empty(len(rows))
            for k in range(FOLDS):
                some = everyone[fold != k]
                out[fold == k] = predict(sparse_logistic(*lay(some), dense[some], y[some], weight[some], width), everyone[fold == k])
            links.append(sparse_logistic(*lay(everyone), dense, y, weight, width))
        dense = np.column_stack([dense, _logit(out)])
    return {"names": names, "links": links, "slot": slot}


def score(docs: DataFrame, model: dict, threshold: float = 0.5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, a probability per earlier category, score, predicted) of every whole text.

    ``score`` is the chance of the last category. Null counts as empty; rows go one by one.
    """
    spark = docs.sparkSession
    arrow_rows(spark)
    shared = spark.sparkContext.broadcast(model)  # at most WIDTH weights a link
    names = [*model["names"][:-1], "score"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m, known = shared.value, {}
        for batch in batches:
            found = [m["slot"][_features(t or "", known)] for t in batch.column("text").to_pylist()]
            found = [f[f >= 0] for f in found]
            row = np.repeat(np.arange(len(found)), [len(f) for f in found])
            index = np.concatenate(found or [np.empty(0, np.int64)])
            dense = np.zeros((len(found), 0))
            for w in m["links"]:
                if isinstance(w, float):
                    p = np.full(len(found), w)
                else:
                    k = dense.shape[1]
                    p = sigmoid(np.bincount(row, w[index], len(found)) + dense @ w[len(w) - 1 - k : -1] + w[-1])
                dense = np.column_stack([dense, _logit(p)])
            p = sigmoid(dense)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(p[:, k]) for k in range(p.shape[1])), pa.array((p[:, -1] >= threshold).astype(np.int32))], names=["doc_id", *names, "predicted"])

    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return own.mapInArrow(run, "doc_id long, " + ", ".join(f"`{n}` double" for n in names) + ", predicted int")
