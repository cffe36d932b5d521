"""Language by interpolated Kneser-Ney character models.

Runs of four characters are counted per language over all learnable documents. The highest order
uses these counts, the lower ones the numbers of different left neighbours, each order with its own discount
and interpolated with the next lower one; all of it in grouped tables, whatever their size. To score,
the documents' different runs are joined to these tables once. What that gives is an array sorted by a
hash of the run, with the log-probabilities for every language side by side; where it is too large to send to
every task, the documents' runs are joined to it instead. The language of least cross-entropy per
character is chosen.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mereflow import scratch
from mereflow.llm.common import arrow_rows, id_fold
from mereflow.llm.linear import logistic

ORDER = 4
CHUNK = 1 << 18
#: Bytes of log-probabilities that are broadcast; more are joined by a shuffle.
BROADCAST_BYTES = 128 << 20

_LETTER = np.array([chr(c).isalpha() if not 0xD800 <= c < 0xE000 else True for c in range(1 << 16)])
_ASTRAL = re.compile("[\U00010000-\U0010ffff\ud800-\udfff]")
_ODD = np.uint64(0x9E3779B97F4A7C15)


def has_letter(text: str | None) -> bool:
    return bool(text) and (text.isalpha() or any(map(str.isalpha, text)))


def _units(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """16-bit units of the texts' lower-cased words with one space between, three spaces before each text; and where texts begin."""
    parts = []
    for t in texts:
        t = t.lower()
        if not t.isascii() and _ASTRAL.search(t):
            t = _ASTRAL.sub(lambda m: m[0] if m[0].isalpha() else " ", t)
        parts.append("\x00" + t + " ")
    raw = np.frombuffer("".join(parts).encode("utf-16-le"), "<u2")
    sizes = np.array([len(p.encode("utf-16-le")) // 2 if not p.isascii() else len(p) for p in parts])
    begins = np.cumsum(sizes) - sizes
    letter = _LETTER[raw]
    out = np.where(letter, raw, np.uint16(32))
    keep = letter | np.concatenate([[True], letter[:-1]])
    keep[begins] = True
    kept = np.flatnonzero(keep)
    at = np.searchsorted(kept, begins)
    lift = np.repeat(np.arange(len(at)) * (ORDER - 2), np.diff(np.concatenate([at, [len(kept)]])))
    seq = np.full(len(kept) + len(at) * (ORDER - 2), 32, np.uint16)
    seq[np.arange(len(kept)) + lift + (ORDER - 2)] = out[kept]
    return seq, at + np.arange(len(at)) * (ORDER - 2)


def _runs(seq: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Keys of all runs of four that lie in one text, and the text of each."""
    n = len(seq) - ORDER + 1
    if n <= 0:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    s = seq.astype(np.uint64)
    key = (s[:n] << np.uint64(48)) | (s[1 : n + 1] << np.uint64(32)) | (s[2 : n + 2] << np.uint64(16)) | s[3 : n + 3]
    text = np.repeat(np.arange(len(begins)), np.diff(np.concatenate([begins, [len(seq)]])))
    inside = text[:n] == text[ORDER - 1 :]
    return key[inside], text[:n][inside]


def _lots(texts: list[str]) -> Iterator[tuple[int, list[str]]]:
    """(first text, texts) of about CHUNK characters; a longer text is a lot of its own."""
    a, held = 0, 0
    for i, t in enumerate(texts):
        held += len(t)
        if held >= CHUNK or i == len(texts) - 1:
            yield a, texts[a : i + 1]
            a, held = i + 1, 0


class _Sorted:
    """Rows found by key: hashes in order, with the places where their leading bits begin."""

    def __init__(self, keys: np.ndarray):
        h = keys * _ODD
        self.order = np.argsort(h)
        self.hash = h[self.order]
        self.bits = np.uint64(max(1, 64 - int(max(1, len(h))).bit_length() - 1))
        self.start = np.searchsorted(self.hash >> self.bits, np.arange((1 << (64 - int(self.bits))) + 1, dtype=np.uint64))
        self.longest = int(np.diff(self.start).max()) if len(h) else 0

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Place in the order of each key, or -1."""
        out = np.full(len(keys), -1)
        if not len(self.hash):
            return out
        h = keys * _ODD
        at = self.start[(h >> self.bits).astype(np.int64)]
        left, last = np.arange(len(keys)), len(self.hash) - 1
        for _ in range(self.longest):
            here = self.hash[np.minimum(at, last)]
            same = here == h
            out[left[same]] = at[same]
            more = ~same & (here < h) & (at < last)
            if not more.any():
                break
            left, h, at = left[more], h[more], at[more] + 1
        return out


def count_runs(docs: DataFrame, lang_col: str = "lang", text_col: str = "text") -> DataFrame:
    """(lang, run, n) over all documents with a language; counts are added up per batch before the shuffle."""
    own = docs.where(F.col(lang_col).isNotNull()).select(F.col(lang_col).cast("string").alias("key"), F.col(text_col).cast("string").alias("text"))
    return _counted(own, "string").groupBy(F.col("key").alias("lang"), "run").agg(F.sum("n").alias("n"))


def _counted(own: DataFrame, kind: str) -> DataFrame:
    """(key, run, n) for texts (key, text): the runs of each batch's texts, counted by key."""
    arrow_rows(own.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            by_key: dict = {}
            for k, t in zip(batch.column("key").to_pylist(), batch.column("text").to_pylist()):
                if t:
                    by_key.setdefault(k, []).append(t)
            for k, texts in by_key.items():
                keys = np.concatenate([_runs(*_units(lot))[0] for _, lot in _lots(texts)])
                u, n = np.unique(keys, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array([k] * len(u), batch.column("key").type), pa.array(u.view(np.int64)), pa.array(n.astype(np.int64))], names=["key", "run", "n"])

    return own.mapInArrow(run, f"key {kind}, run long, n long")


@dataclass
class Model:
    """Kneser-Ney tables by order, and what calibrates them."""

    names: list[str]  # languages, in order
    seen: list[DataFrame] = field(default_factory=list)  # per order: key, lp: by language, null where it never saw the key
    back: list[DataFrame] = field(default_factory=list)  # per order above 1: context, g: log weight of the next lower order
    floor: list[float] = field(default_factory=list)  # by language: of a character that it never saw
    slope: tuple[float, float] = (0.0, 1.0)
    strange: np.ndarray = field(default_factory=lambda: np.empty(0))


def _short(key: Column, order: int) -> Column:
    """The last ``order`` characters of a run."""
    return key if order == ORDER else key.bitwiseAND(F.lit((1 << (16 * order)) - 1))


def probabilities(runs: DataFrame) -> tuple[list[DataFrame], list[DataFrame], int]:
    """Per order 1, 2, ...: (lang, key, p) of the keys that a language saw, and (lang, context, gamma); and the number of characters and one more.

    The chance of a key that a language did not see is its context's gamma, 1 for an unseen context, times the chance of the key without its
    first character; below order 1 it is one by that number.
    """
    counts = [runs.select("lang", F.col("run").alias("key"), F.col("n").alias("c"))]
    for order in range(ORDER - 1, 0, -1):
        counts.insert(0, scratch.save(counts[0].groupBy("lang", _short(F.col("key"), order).alias("key")).agg(F.count(F.lit(1)).alias("c")), f"order-{order}"))
    letters = counts[0].select("key").distinct().count() + 1
    seen, back = [], []
    for order, own in enumerate(counts, 1):
        often = lambda n: F.count(F.when(F.col("c") == n, 1))  # noqa: E731, B023
        d = own.groupBy("lang").agg(F.when((often(1) > 0) & (often(2) > 0), often(1) / (often(1) + 2 * often(2))).otherwise(0.5).alias("d"))
        context = F.shiftrightunsigned("key", 16).alias("context") if order > 1 else F.lit(0).cast("long").alias("context")
        own = own.select("lang", "key", "c", context)
        total = own.groupBy("lang", "context").agg(F.sum("c").alias("total"), F.count(F.lit(1)).alias("kinds"))
        gamma = scratch.save(total.join(d, "lang").select("lang", "context", "total", "d", (F.col("d") * F.col("kinds") / F.col("total")).alias("gamma")), f"contexts-{order}")
        p = own.join(gamma, ["lang", "context"]).withColumn("share", F.greatest(F.col("c") - F.col("d"), F.lit(0.0)) / F.col("total"))
        if order == 1:
            p = p.withColumn("low", F.lit(1.0 / letters))
        else:
            p = p.withColumn("short", _short(F.col("key"), order - 1)).join(seen[-1].select("lang", F.col("key").alias("short"), F.col("p").alias("low")), ["lang", "short"])
        seen.append(scratch.save(p.select("lang", "key", (F.col("share") + F.col("gamma") * F.col("low")).alias("p")), f"seen-{order}"))
        back.append(gamma.select("lang", "context", "gamma"))
    return seen, back, letters


def _by_language(table: DataFrame, key: str, value: str, names: list[str]) -> DataFrame:
    """(key, logs): the logarithms of a value side by side for all languages, null where one has none."""
    number = F.array_position(F.array(*map(F.lit, names)), F.col("lang")).cast("int")
    by = table.groupBy(key).agg(F.map_from_entries(F.collect_list(F.struct(number.alias("l"), F.log(value).alias("v")))).alias("m"))
    return by.select(key, F.transform(F.sequence(F.lit(1), F.lit(len(names))), lambda l: F.element_at("m", l)).alias("logs"))


def log_probabilities(runs: DataFrame, model: Model) -> DataFrame:
    """(run, lp) for distinct runs: the log-probability of the last character after those before it, by language."""
    out = runs.select("run")
    for order in range(ORDER, 0, -1):
        s = model.seen[order - 1].select(F.col("key").alias(f"k{order}"), F.col("logs").alias(f"s{order}"))
        out = out.withColumn(f"k{order}", _short(F.col("run"), order)).join(s, f"k{order}", "left")
        if order > 1:
            g = model.back[order - 1].select(F.col("context").alias(f"c{order}"), F.col("logs").alias(f"g{order}"))
            out = out.withColumn(f"c{order}", F.shiftrightunsigned(f"k{order}", 16)).join(g, f"c{order}", "left")

    def at(order: int, l: Column) -> Column:
        if order == 0:
            return F.get(F.array(*map(F.lit, model.floor)), l)
        own = F.get(F.col(f"s{order}"), l)
        weight = F.get(F.col(f"g{order}"), l) if order > 1 else F.lit(0.0)
        return F.coalesce(own, F.coalesce(weight, F.lit(0.0)) + at(order - 1, l))

    return out.select("run", F.transform(F.sequence(F.lit(0), F.lit(len(model.names) - 1)), lambda l: at(ORDER, l)).alias("lp"))


def cross_entropies(docs: DataFrame, model: Model, most: int = BROADCAST_BYTES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ce) of every row: the mean negative log-probability per character by language, null for texts without a letter.

    Log-probabilities of up to ``most`` bytes go to every task as arrays in the order of hashes; beyond, different texts' runs are joined to them.
    """
    spark, width = docs.sparkSession, len(model.names)
    arrow_rows(spark)
    text = F.col(text_col).cast("string")
    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"))
    asked = _counted(own.select(F.lit(0).alias("key"), "text"), "int").select("run").distinct()
    table = scratch.save(log_probabilities(asked, model), "log-probabilities")
    rows = table.count()
    if rows * (8 + 8 * width) > most:
        return _joined_entropies(own, table, width)
    got = table.toArrow()  # of the bytes just counted
    runs = got["run"].to_numpy().astype(np.int64).view(np.uint64)
    find = _Sorted(runs)
    lp = got["lp"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, width)[find.order] if rows else np.zeros((0, width))
    shared = spark.sparkContext.broadcast((find, lp))
    scratch.drop(table)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find, lp = shared.value
        for batch in batches:
            texts = batch.column("text").to_pylist()
            some = [i for i, t in enumerate(texts) if has_letter(t)]
            ce: list = [None] * len(texts)
            for a, lot in _lots([texts[i] for i in some]):
                keys, text = _runs(*_units(lot))
                total = np.zeros((len(lot), width))
                for b in range(0, len(keys), CHUNK):
                    own, part = text[b : b + CHUNK], lp[find.find(keys[b : b + CHUNK])]
                    first = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
                    total[own[first]] += np.add.reduceat(part, first, axis=0)
                mean = -total / np.maximum(np.bincount(text, minlength=len(lot)), 1)[:, None]
                for k in range(len(lot)):
                    ce[some[a + k]] = mean[k]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(ce, pa.list_(pa.float64()))], names=["doc_id", "ce"])

    return own.mapInArrow(run, "doc_id long, ce array<double>")


def _joined_entropies(own: DataFrame, table: DataFrame, width: int) -> DataFrame:
    """The same by a join of the runs of each different text."""
    told = own.withColumn("h", F.xxhash64("text"))
    runs = _each(told.select("h", "text").dropDuplicates(["h"]))
    sums = runs.join(table, "run").groupBy("h").agg(F.sum("n").alias("n"), *(F.sum(F.col("n") * F.col("lp")[j]).alias(f"t{j}") for j in range(width)))
    ce = sums.select(F.col("h").alias("h_"), F.array(*(-F.col(f"t{j}") / F.col("n") for j in range(width))).alias("ce"))
    return told.join(ce, F.col("h") == F.col("h_"), "left").select("doc_id", "ce")


def _each(texts: DataFrame) -> DataFrame:
    """(h, run, n) of every text with a letter."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for h, t in zip(batch.column("h").to_pylist(), batch.column("text").to_pylist()):
                if has_letter(t):
                    u, n = np.unique(_runs(*_units([t]))[0], return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(u), h, np.int64)), pa.array(u.view(np.int64)), pa.array(n.astype(np.int64))], names=["h", "run", "n"])

    return texts.mapInArrow(run, "h long, run long, n long")


def fit(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", id_col: str = "doc_id", sample: int = 2000, longest: int = 20_000) -> Model | None:
    """Models of all languages of ``docs``; none if none has text.

    Counts cover all documents. The confidence is calibrated on at most ``sample`` documents of at
    most ``longest`` characters, in hash order.
    """
    runs = scratch.save(count_runs(docs, lang_col, text_col), "runs")
    names = [r["lang"] for r in runs.select("lang").distinct().orderBy("lang").collect()]  # as many as languages
    if not names:
        return None
    seen, back, letters = probabilities(runs)
    by = lambda t, key, value, name: scratch.save(_by_language(t, key, value, names), name)
    lowest = {r["lang"]: r["gamma"] / letters for r in back[0].collect()}  # as many as languages
    model = Model(names, [by(t, "key", "p", "model") for t in seen], [by(t, "context", "gamma", "model") for t in back], [float(np.log(lowest.get(k, 1 / letters))) for k in names])
    text = F.col(text_col).cast("string")
    drawn = docs.where(F.col(lang_col).isNotNull() & (F.length(text) <= longest) & (F.length(text) > 0))
    drawn = drawn.select(F.xxhash64(id_col).alias("o"), F.col(lang_col).cast("string").alias("l"), text.alias("t"))
    first = drawn.select("o").orderBy("o").limit(sample).distinct()  # hashes only, so that no task sends texts it may not need to
    rows = sorted(drawn.join(F.broadcast(first), "o").limit(sample).collect())
    kinds = [(k, r["l"], t) for r in rows for k, t in enumerate((r["t"], r["t"][:40])) if has_letter(t)]  # whole texts, and short ones for the slope
    if kinds and len(names) > 1:
        spark = docs.sparkSession
        given = spark.createDataFrame([(i, t) for i, (_, _, t) in enumerate(kinds)], "doc_id long, text string")
        ce = {r["doc_id"]: np.array(r["ce"]) for r in cross_entropies(given, model).collect()}  # at most twice ``sample`` rows
        x, y, best = [], [], []
        for i, (k, lang, _) in enumerate(kinds):
            for j, name in enumerate(names):
                x.append(np.delete(ce[i], j).min() - ce[i][j])
                y.append(float(lang == name))
            if k == 0:
                best.append(ce[i][names.index(lang)])
        w = logistic(np.column_stack([np.ones(len(x)), x]), np.array(y), l2=1e-3)
        model.slope, model.strange = (float(w[0]), float(w[1])), np.sort(np.array(best))
    return model


def predict(docs: DataFrame, model: Model | None, reject: float | None = None, id_col: str = "doc_id", text_col: str = "text", most: int = BROADCAST_BYTES) -> DataFrame:
    """(doc_id, lang_pred, score) of every whole text.

    ``und`` and score 0 for null, for texts without a letter and where there is no model. With ``reject``, also for texts
    whose best cross-entropy only that share of the calibrating texts exceeds in their own language.
    Rows go one by one; ties go to the first language by name.
    """
    if model is None:
        return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"))
    limit = float("inf")
    if reject is not None and len(model.strange):
        limit = float(np.quantile(model.strange, 1 - reject))
    ce = cross_entropies(docs, model, most, id_col, text_col)
    low = F.array_min("ce")
    best = F.array_position("ce", low).cast("int")
    rest = F.array_min(F.filter("ce", lambda x, i: i != best - 1))
    z = F.lit(model.slope[0]) + F.lit(model.slope[1]) * F.coalesce(rest - low, F.lit(30.0))
    p = 1 / (1 + F.exp(-F.least(F.greatest(z, F.lit(-30.0)), F.lit(30.0))))
    known = F.col("ce").isNotNull() & (low <= limit)
    name = F.element_at(F.array(*map(F.lit, model.names)), best)
    return ce.select("doc_id", F.when(known, name).otherwise("und").alias("lang_pred"), F.when(known, p).otherwise(0.0).alias("score"))


def predictions(docs: DataFrame, folds: int = 3, held: int = 1) -> DataFrame:
    """(doc_id, held_out, lang_pred, score); held-out documents are never learned from."""
    fold = id_fold("doc_id", folds)
    out = predict(docs, fit(docs.where(fold != held)))
    return out.select("doc_id", (fold == held).alias("held_out"), "lang_pred", "score")
