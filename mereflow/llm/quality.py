"""Quality by compression: dictionaries of good and bad text, and the difference they make.

Each text is compressed with either dictionary, as it is and with its letters and digits levelled to
their kinds. The differences of the sizes, normalised, and the size per byte that they are
relative to, go through a logistic calibration on labelled texts that built no dictionary.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mereflow.llm.common import arrow_rows, id_fold
from mereflow.llm.linear import labelled_sample, logistic, natural, sigmoid

LEVEL = 3
DICTIONARY_BYTES = 64 << 10

_KIND = np.arange(256, dtype=np.uint8)
_KIND[97:123], _KIND[65:91], _KIND[48:58], _KIND[128:] = 97, 65, 48, 97
_KINDS = _KIND.tobytes()


def _views(text: str) -> tuple[bytes, bytes]:
    raw = text.encode("utf-8", "surrogatepass")
    return raw, raw.translate(_KINDS)


def _dictionary(samples: list[bytes]) -> bytes:
    """A trained dictionary, or the samples themselves where they are too few to train on."""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-DICTIONARY_BYTES:]


class _Measure:
    """Features of texts by four compressors: good and bad, for either view."""

    def __init__(self, dictionaries: list[bytes]):
        self.compress = []
        for d in dictionaries:
            made = zstandard.ZstdCompressionDict(d)
            made.precompute_compress(level=LEVEL)
            self.compress.append(zstandard.ZstdCompressor(level=LEVEL, dict_data=made).compress)

    def features(self, texts: list[str]) -> np.ndarray:
        out = np.zeros((len(texts), 6))
        for k, t in enumerate(texts):
            for v, raw in enumerate(_views(t)):
                if raw:
                    good, bad = len(self.compress[2 * v](raw)), len(self.compress[2 * v + 1](raw))
                    out[k, 3 * v : 3 * v + 3] = (bad - good) / max(good, bad), (bad - good) / len(raw), np.log(min(good, bad) / len(raw))
        return out


def _design(x: np.ndarray, mean: np.ndarray, sd: np.ndarray) -> np.ndarray:
    z = np.clip((x - mean) / sd, -6, 6)
    return np.column_stack([np.ones(len(z)), z, z * z])


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", per_class: int = 3000, longest: int = 50_000) -> dict:
    """A model from at most ``per_class`` labelled texts of each class, of at most ``longest`` characters each.

    Half of each class builds its dictionary, the rest calibrates. With texts of only one class, or
    none, the model is the share of label 1 (0.5 without any).
    """
    rows, sizes = labelled_sample(docs, labels, label, per_class, longest)
    texts, y = [t for t, _ in rows], np.array([v for _, v in rows], float)
    if min((y == 0).sum(), (y == 1).sum()) < 4:
        return {"share": sizes.get(1, 0) / sum(sizes.values()) if sizes else 0.5}
    build = np.zeros(len(y), bool)
    for k in (0, 1):
        own = np.flatnonzero(y == k)
        build[own[: len(own) // 2]] = True
    dictionaries = [_dictionary([_views(texts[i])[v] for i in np.flatnonzero(build & (y == k)) if texts[i]]) for v in (0, 1) for k in (1, 0)]
    rest = np.flatnonzero(~build)
    x = _Measure(dictionaries).features([texts[i] for i in rest])
    mean, sd = x.mean(0), x.std(0) + 1e-9
    w = logistic(_design(x, mean, sd), y[rest], natural(y[rest], sizes))
    return {"dictionaries": dictionaries, "mean": mean, "sd": sd, "w": w}


def score(docs: DataFrame, model: dict, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, *keep, score): calibrated chance of label 1 for every whole text; null counts as empty, rows go one by one."""
    spark = docs.sparkSession
    arrow_rows(spark)
    shared = spark.sparkContext.broadcast(model)  # four dictionaries of bounded size and a few numbers
    own = docs.select(F.col(id_col).alias("doc_id"), *keep, F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("__text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        measure = None if "share" in m else _Measure(m["dictionaries"])
        for batch in batches:
            texts = batch.column("__text").to_pylist()
            s = np.full(len(texts), m["share"]) if measure is None else sigmoid(_design(measure.features(texts), m["mean"], m["sd"]) @ m["w"])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(batch.column(k) for k in keep), pa.array(s)], names=["doc_id", *keep, "score"])

    types = dict(own.dtypes)
    return own.mapInArrow(run, ", ".join([*(f"`{k}` {types[k]}" for k in ("doc_id", *keep)), "score double"]))


def predictions(docs: DataFrame, labels: DataFrame, folds: int = 5, held: int = 0, threshold: float = 0.3) -> DataFrame:
    """(doc_id, held_out, score, predicted); labels of held-out ids are never learned from."""
    model = fit(docs, labels.where(id_fold("doc_id", folds) != held))
    out = score(docs, model)
    return out.select("doc_id", (id_fold("doc_id", folds) == held).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """``docs`` whose score reaches the threshold; all columns stay."""
    model = fit(docs, labels.where(id_fold("doc_id", 5) != 0))
    spark = docs.sparkSession
    arrow_rows(spark)
    shared = spark.sparkContext.broadcast(model)

    def judge(texts):
        import pandas as pd

        m = shared.value
        if "share" in m:
            return pd.Series(np.full(len(texts), m["share"]))
        if "__measure" not in judge.__dict__:
            judge.__measure = _Measure(m["dictionaries"])
        return pd.Series(sigmoid(_design(judge.__measure.features([t or "" for t in texts]), m["mean"], m["sd"]) @ m["w"]))

    from pyspark.sql.types import DoubleType

    return docs.where(F.pandas_udf(judge, DoubleType())(F.col("text").cast("string")) >= threshold)
