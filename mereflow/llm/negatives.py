"""Hard negatives: rows of another label that score just under an anchor's positives, by coordinate pruning.

Rows become integer vectors and are range-sorted by label and falling length into buckets, each with its rows in the order of
every coordinate. A row whose score reaches a threshold has at least some cosine with the anchor, so each of its coordinates
lies in a range around the anchor's. For the anchor's largest coordinates the buckets' sorted lists give the rows in range;
what is in all of them is verified exactly. Lots of anchors stay where they are: each task reads the buckets from the shared
folder one after the other, longest first, with a running threshold.
"""

from __future__ import annotations

import heapq
import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mereflow import scratch
from mereflow.llm.bitsliced import quantised
from mereflow.llm.common import arrow_rows, open_file

BUCKET_ROWS, LOT_ROWS = 16_384, 512
#: The anchor's largest coordinates, whose lists are intersected.
FOCUS = 4
#: Scores below this are exact in doubles; beyond it they are added as Python's integers.
_EXACT = float(1 << 53)
_LONG = (1 << 63) - 1


def _buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (dims, label, length, vec_id, q), sorted, to buckets with a sorted list for each coordinate."""

    def dump(rows: list[dict]) -> pa.RecordBatch:
        q = np.array([r["q"] for r in rows], np.int64).reshape(len(rows), -1)
        size = np.sqrt((q.astype(float) ** 2).sum(1))
        unit = np.divide(q, size[:, None], out=np.zeros(q.shape), where=size[:, None] > 0)
        small = q.astype(np.int16) if q.size and np.abs(q).max() < 1 << 15 else q
        data = {"ids": np.array([r["vec_id"] for r in rows], np.int64), "labels": np.array([r["label"] for r in rows], np.int64), "q": small, "order": np.argsort(unit, 0, kind="stable").astype(np.int32)}
        head = [rows[0]["dims"], int(data["labels"].min()), int(data["labels"].max()), float(size.max()), pickle.dumps(data, 5)]
        return pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(head, (pa.int32(), pa.int64(), pa.int64(), pa.float64(), pa.binary()))], names=["dims", "low", "high", "longest", "data"])

    held: list[dict] = []
    for batch in batches:
        for row in batch.to_pylist():
            if held and (len(held) == BUCKET_ROWS or row["dims"] != held[0]["dims"]):
                yield dump(held)
                held = []
            held.append(row)
    if held:
        yield dump(held)


class _Bucket:
    def __init__(self, uri: str):
        with open_file(uri) as f:
            data = pickle.loads(pq.read_table(f, columns=["data"]).column("data")[0].as_py())
        self.ids, self.labels, self.order = data["ids"], data["labels"], data["order"]
        self.q = data["q"].astype(np.int64)
        self.exact = self.q.astype(float)
        size = np.sqrt((self.exact**2).sum(1))
        self.longest = float(size.max(initial=0.0))
        self.largest = float(np.abs(self.exact).max(initial=0.0))
        self.unit = np.divide(self.exact, size[:, None], out=np.zeros(self.exact.shape), where=size[:, None] > 0)

    def candidates(self, q: np.ndarray, least: float) -> np.ndarray | None:
        """Rows that may score ``least`` or more; None for all."""
        length = float(np.sqrt((q.astype(float) ** 2).sum()))
        if least <= 0 or not length or not self.longest:
            return None if least <= 0 else np.empty(0, np.int64)
        cosine = least / (length * self.longest) * (1 - 1e-9) - 1e-9
        if cosine > 1:
            return np.empty(0, np.int64)
        if cosine <= 0:
            return None
        own, wide = q / length, np.arccos(cosine)
        focus = np.argsort(-np.abs(own), kind="stable")[:FOCUS]
        angle = np.arccos(np.clip(own[focus], -1, 1))
        low, high = np.cos(np.minimum(angle + wide, np.pi)) - 1e-9, np.cos(np.maximum(angle - wide, 0)) + 1e-9
        lists = []
        for f, a, z in zip(focus, low, high):
            order = self.order[:, f]
            values = self.unit[order, f]
            lists.append(order[np.searchsorted(values, a) : np.searchsorted(values, z, side="right")])
        lists.sort(key=len)
        found = np.zeros(len(self.ids), np.uint8)
        for rows in lists:
            found[rows] += 1
        return lists[0][found[lists[0]] == len(lists)]

    def scores(self, q: np.ndarray, rows: np.ndarray | None) -> np.ndarray:
        """Exact scores; as Python's integers where a double or a long may not hold them."""
        if self.largest * float(np.abs(q.astype(float)).max(initial=0.0)) * max(1, len(q)) < _EXACT:
            own = self.exact if rows is None else self.exact[rows]
            return (own @ q.astype(float)).astype(np.int64)
        own = self.q if rows is None else self.q[rows]
        return (own.astype(object) * q.astype(object)).sum(1) if len(q) else np.zeros(len(own), np.int64)


class _Best:
    """The k best (score, smaller id first) so far."""

    def __init__(self, k: int):
        self.k, self.heap = k, []

    def least(self) -> float:
        return self.heap[0][0] if len(self.heap) == self.k else -np.inf

    def add(self, ids: np.ndarray, scores: np.ndarray) -> None:
        if len(ids) > self.k:
            top = np.lexsort((ids, -scores))[: self.k] if scores.dtype != object else sorted(range(len(ids)), key=lambda i: (-scores[i], ids[i]))[: self.k]
            ids, scores = ids[top], scores[top]
        for i, s in zip(ids.tolist(), scores.tolist()):
            (heapq.heappush if len(self.heap) < self.k else heapq.heappushpop)(self.heap, (s, -i))

    def rows(self) -> list[tuple[int, int]]:
        return [(-i, s) for s, i in sorted(self.heap, reverse=True)]


def _search(heads: str, positives: int, negatives: int, low: int, high: int):
    """A lot of anchors (dims, label, vec_id, q) against all buckets, first for their positives, then for the negatives of each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lot = [(r["dims"], r["label"], r["vec_id"], np.array(r["q"], np.int64)) for b in batches for r in b.to_pylist()]
        if not lot:
            return
        with open_file(heads) as f:
            index = sorted(pq.read_table(f).to_pylist(), key=lambda h: -h["longest"])
        near = [_Best(positives) for _ in lot]
        for h in index:
            asked = [i for i, a in enumerate(lot) if a[0] == h["dims"] and h["low"] <= a[1] <= h["high"]]
            bucket = _Bucket(h["file"]) if asked else None
            for i in asked:
                _, label, own, q = lot[i]
                rows = bucket.candidates(q, near[i].least())
                rows = np.arange(len(bucket.ids)) if rows is None else rows
                rows = rows[(bucket.labels[rows] == label) & (bucket.ids[rows] != own)]
                near[i].add(bucket.ids[rows], bucket.scores(q, rows))
        # a negative's score is between low and high percent of the positive's, so a positive below zero has none
        wanted = [[(p, s, _Best(negatives)) for p, s in best.rows() if low * s <= high * s] for best in near]
        for h in index:
            asked = [i for i, a in enumerate(lot) if wanted[i] and a[0] == h["dims"] and not h["low"] == h["high"] == a[1]]
            bucket = _Bucket(h["file"]) if asked else None
            for i in asked:
                _, label, own, q = lot[i]
                rows = bucket.candidates(q, float(min(max(-(-low * s // 100), best.least()) for _, s, best in wanted[i])))
                rows = np.arange(len(bucket.ids)) if rows is None else rows
                rows = rows[(bucket.labels[rows] != label) & (bucket.ids[rows] != own)]
                scores = bucket.scores(q, rows)
                for _, s, best in wanted[i]:
                    ok = (scores >= -(-low * s // 100)) & (scores <= high * s // 100)
                    best.add(bucket.ids[rows[ok]], scores[ok])
        out = [(a[2], p, rank, n, s, t) for a, w in zip(lot, wanted) for p, s, best in w for rank, (n, t) in enumerate(best.rows(), 1)]
        columns = [np.array([min(max(int(r[c]), -_LONG), _LONG) for r in out], np.int32 if c == 2 else np.int64) for c in range(6)]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"])

    return run


def mine(vectors: DataFrame, anchors: DataFrame, positives: int = 5, negatives: int = 5, low: int = 80, high: int = 100, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label", scale: int = 256) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) of every anchor and each of its positives.

    A row's score is its integer inner product with the anchor, whose positives are its best other rows of its label. For each the
    best rows of other labels follow whose score is ``low`` to ``high`` percent of the positive's; ties go to the smaller id. Rows
    without an id or a label, and vectors that are null or hold a null or non-finite component, take no part; an anchor meets
    vectors of its own length only. Rows that share the anchor's id are no others; one that is repeated is one candidate for each
    repeat. Equal anchors are asked once. Components saturate at the range of a long, scores are exact whatever their size, and
    such as a long cannot hold are returned as its bounds.
    """
    spark = vectors.sparkSession
    arrow_rows(spark, 2048)
    q = quantised(F.col(vec_col), scale)
    rows, asked = (df.select(F.size(q).alias("dims"), F.col(label_col).cast("long").alias("label"), F.col(id_col).cast("long").alias("vec_id"), q.alias("q")).where("q is not null and label is not null and vec_id is not null") for df in (vectors, anchors))
    length = F.aggregate("q", F.lit(0.0), lambda a, v: a + v.cast("double") * v.cast("double"))
    parts = max(1, -(-rows.count() // BUCKET_ROWS))
    order = ["dims", "label", F.desc("length"), "vec_id"]
    dealt = rows.withColumn("length", length).repartitionByRange(parts, *order).sortWithinPartitions(*order)
    index = scratch.save(dealt.mapInArrow(_buckets, "dims int, low long, high long, longest double, data binary"), "buckets", maxRecordsPerFile="1")
    heads = scratch.save(index.select(F.col("_metadata.file_path").alias("file"), "dims", "low", "high", "longest").coalesce(1), "directory")
    lots = asked.distinct()
    n = max(1, -(-lots.count() // LOT_ROWS), min(lots.count(), 64))
    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    files = heads.inputFiles()
    if not files:
        return spark.createDataFrame([], schema)
    return lots.repartition(n).mapInArrow(_search(files[0], positives, negatives, low, high), schema)


#: The same rows in DuckDB SQL, for anchors whose id 100 divides; a label of a row whose id 7 divides is the next one's.
ORACLE = """
with v as (
  select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label, list_transform(embedding, lambda x: floor(256 * cast(x as double))) as q from embeddings
  where label is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
s as (
  select a.vec_id as anchor_id, b.vec_id, a.label = b.label as same, cast(list_dot_product(a.q, b.q) as bigint) as score
  from v a join v b on a.vec_id % 100 = 0 and a.vec_id <> b.vec_id),
p as (select anchor_id, vec_id as positive_id, score as positive_score from s where same qualify row_number() over (partition by anchor_id order by score desc, vec_id) <= 5),
n as (
  select p.*, s.vec_id as negative_id, s.score as negative_score, cast(row_number() over (partition by p.anchor_id, positive_id order by s.score desc, s.vec_id) as integer) as rank
  from p join s on s.anchor_id = p.anchor_id and not s.same and 80 * positive_score <= 100 * s.score and 100 * s.score <= 100 * positive_score)
select anchor_id, positive_id, rank, negative_id, positive_score, negative_score from n where rank <= 5
"""
