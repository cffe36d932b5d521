"""Exact top-k inner products over a bit-sliced index.

Vectors become integers, and a block of them is kept as bitmaps: one per component and binary
digit, over the block's rows. A query's weighted digits are added with bitmap adders, the lowest
digits left out, which gives every row's score from below and a bound on what is missing. The best
rows are picked from the most significant slice downward, above what earlier blocks gave; rows that
the bound leaves open are resolved exactly. Lots of queries stay in their tasks, and each task reads
the blocks of its stripe from the shared folder one after the other.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mereflow import scratch
from mereflow.llm.common import arrow_rows, open_file

BLOCK_ROWS = 16_384
#: Queries of a lot, 4 MB of 64 components, and blocks that a task reads for it.
LOT_ROWS, STRIPE_BLOCKS = 8192, 64
#: Added to a score for a key of bytes in the scores' order.
_LIFT, _LONG = 1 << 159, (1 << 63) - 1
#: Digits of the sum that are left to the exact step.
DROPPED = 5
_ONE = np.uint64(1)


def quantised(embedding: Column, scale: int = 256) -> Column:
    """floor(scale * x) of every component, x as double; null where a component is null or not finite, or the vector null."""
    x = F.transform(embedding, lambda v: v.cast("double"))
    bad = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    return F.when(embedding.isNull() | bad, None).otherwise(F.transform(x, lambda v: F.floor(v * scale)))


def _matrix(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(ids, values) for each vector length."""
    ids, lists = [], []
    for batch in batches:
        ids += batch.column("vec_id").to_pylist()
        lists += [np.array(x, np.int64) for x in batch.column("q").to_pylist()]
    sizes = np.array([len(x) for x in lists])
    for n in np.unique(sizes):
        own = np.flatnonzero(sizes == n)
        yield np.array([ids[i] for i in own], np.int64), np.array([lists[i] for i in own], np.int64).reshape(len(own), n)


def _index(k: int):
    """Rows (vec_id, q) of a partition to bit-sliced blocks of distinct vectors.

    Of equal vectors the k + 1 smallest ids are kept, each with up to k of its rows: no other can be
    among a query's k best, as the query leaves out the rows of one id only.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, values in _matrix(batches):
            order = np.lexsort((ids, *values.T)) if values.shape[1] else np.argsort(ids)
            ids, values = ids[order], values[order]
            new = np.concatenate([[True], (values[1:] != values[:-1]).any(1)])
            group = np.cumsum(new) - 1
            fresh = new | np.concatenate([[True], ids[1:] != ids[:-1]])
            number = np.cumsum(fresh)  # of the (vector, id)
            copy = np.arange(len(ids)) - np.flatnonzero(fresh)[number - 1]
            near = (number - number[np.flatnonzero(new)[group]] <= k) & (copy < k)
            base = values.min(0) if values.size else np.zeros(values.shape[1], np.int64)
            distinct = values[new]
            lifted = (distinct - base).astype(np.uint64)
            digits = np.array([int(c).bit_length() for c in lifted.max(0)], np.int64) if lifted.size else np.zeros(values.shape[1], np.int64)
            words = -(-len(distinct) // 64)
            slices = []
            for d, n in enumerate(digits):
                for b in range(n):
                    bits = np.zeros(words * 64, np.uint8)
                    bits[: len(distinct)] = (lifted[:, d] >> np.uint64(b)) & _ONE
                    slices.append(np.packbits(bits, bitorder="little"))
            block = {"n": len(distinct), "base": base, "digits": digits, "slices": np.array(slices, np.uint8).reshape(len(slices), words * 8), "ids": ids[near], "group": group[near]}
            yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()], pa.int32()), pa.array([values.shape[1]], pa.int32()), pa.array([_dump(block)], pa.binary())], names=["block", "dims", "data"])

    return run


def _dump(x: dict) -> bytes:
    import pickle

    return pickle.dumps(x, 5)


def _load(x: bytes) -> dict:
    import pickle

    return pickle.loads(x)


def _add(levels: dict[int, list[np.ndarray]]) -> dict[int, np.ndarray]:
    """Bitmaps by significance, added up to one bitmap per significance."""
    out, p = {}, min(levels, default=0)
    while levels:
        own = levels.pop(p, [])
        above = levels.setdefault(p + 1, []) if len(own) > 1 else None
        while len(own) > 2:
            a, b, c = own.pop(), own.pop(), own.pop()
            x = a ^ b
            own.append(x ^ c)
            above.append((a & b) | (x & c))
        if len(own) == 2:
            a, b = own
            own = [a ^ b]
            above.append(a & b)
        if own:
            out[p] = own[0]
        p += 1
    return out


def _best(block: dict, query_id: int, q: np.ndarray, k: int, found: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """(score, id) of the k best rows among ``found`` and a block's, the query's own id left out."""
    n, digits, base, slices = block["n"], block["digits"], block["base"], block["slices"].view(np.uint64)
    first = np.cumsum(digits) - digits
    weights = [abs(int(w)) for w in q]
    # with every component's digits, complemented where the query is negative, a score is their weighted sum and this
    shift = sum(int(w) * int(b) - (abs(int(w)) * ((1 << int(d)) - 1) if w < 0 else 0) for w, b, d in zip(q, base, digits))
    most = sum(w * ((1 << int(d)) - 1) for w, d in zip(weights, digits))
    least = found[-1][0] - shift if len(found) == k else 0  # what could still be among the best
    if least > most:
        return found
    full = np.full(slices.shape[1], ~np.uint64(0))
    if n % 64:
        full[-1] = (_ONE << np.uint64(n % 64)) - _ONE
    levels: dict[int, list[np.ndarray]] = {}
    missing = 0
    for d in np.flatnonzero((q != 0) & (digits > 0)):
        w, flip = weights[d], q[d] < 0
        for b in range(int(digits[d])):
            s = None
            for j in range(w.bit_length()):
                if w >> j & 1:
                    if b + j < DROPPED:
                        missing += 1 << (b + j)
                        continue
                    if s is None:
                        s = slices[first[d] + b] ^ full if flip else slices[first[d] + b]
                    levels.setdefault(b + j, []).append(s)
    total = _add(levels)
    own_vectors = len(np.unique(block["group"][block["ids"] == query_id]))
    sure, even, need = np.zeros_like(full), full, k + own_vectors  # the query's own rows may be among them
    floor = 0
    for p in sorted(total, reverse=True):
        up = even & total[p]
        if int(np.bitwise_count(sure).sum() + np.bitwise_count(up).sum()) >= need:
            even, floor = up, floor | 1 << p
        else:
            sure, even = sure | up, even & ~total[p]
    least = max(0, floor - missing, least - missing)
    above, even = np.zeros_like(full), full
    for p in range(max([least.bit_length() - 1, *total]), -1, -1):
        s = total.get(p)
        if least >> p & 1:
            even = even & s if s is not None else np.zeros_like(full)
        elif s is not None:
            above, even = above | (even & s), even & ~s
    rows = np.flatnonzero(np.unpackbits((above | even).view(np.uint8), bitorder="little"))
    word, bit = rows >> 6, (rows & 63).astype(np.uint64)
    own = (slices[:, word] >> bit) & _ONE
    # Python's integers where a long might not hold a score
    kind = np.int64 if most + abs(shift) + sum(w * abs(int(b)) for w, b in zip(weights, base)) < _LONG else object
    score = np.full(len(rows), sum(int(w) * int(b) for w, b in zip(q, base)), kind)
    for d in np.flatnonzero((q != 0) & (digits > 0)):
        score += int(q[d]) * (own[first[d] : first[d] + digits[d]] << np.arange(digits[d], dtype=np.uint64)[:, None]).sum(0).astype(kind)
    a, z = np.searchsorted(block["group"], rows), np.searchsorted(block["group"], rows, side="right")
    ids = np.concatenate([block["ids"][i:j] for i, j in zip(a, z)] or [np.empty(0, np.int64)])
    other = ids != query_id
    ids, score = ids[other], np.repeat(score, z - a)[other]
    if kind is np.int64 and len(ids) > k:
        top = np.lexsort((ids, -score))[:k]
        ids, score = ids[top], score[top]
    return sorted([*found, *zip(score.tolist(), ids.tolist())], key=lambda x: (-x[0], x[1]))[:k]


def _search(heads: str, stripes: int, k: int):
    """Lots of queries (stripe, vec_id, q), each against the blocks of its stripe."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lots: dict[tuple[int, int], list] = {}
        for batch in batches:
            for stripe, i, q in zip(*(batch.column(c).to_pylist() for c in ("stripe", "vec_id", "q"))):
                lots.setdefault((stripe, len(q)), []).append((i, np.array(q, np.int64)))
        if not lots:
            return
        with open_file(heads) as f:
            index = sorted(pq.read_table(f).to_pylist(), key=lambda h: h["file"])
        for (stripe, dims), lot in lots.items():
            best: list[list[tuple[int, int]]] = [[] for _ in lot]
            for h in index[stripe::stripes]:
                if h["dims"] == dims:
                    with open_file(h["file"]) as f:
                        block = _load(pq.read_table(f, columns=["data"]).column("data")[0].as_py())
                    best = [_best(block, i, q, k, found) for (i, q), found in zip(lot, best)]
            out = [(i, v, min(max(s, -_LONG), _LONG), (s + _LIFT).to_bytes(20, "big")) for (i, _), found in zip(lot, best) for s, v in found]
            columns = [pa.array([o[c] for o in out], pa.binary() if c == 3 else pa.int64()) for c in range(4)]
            yield pa.RecordBatch.from_arrays(columns, names=["query_id", "vec_id", "score", "key"])

    return run


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 5, id_col: str = "vec_id", vec_col: str = "embedding", scale: int = 256) -> DataFrame:
    """(query_id, rank, vec_id, score): the k rows of largest integer inner product for each query, ties to the smaller id.

    ``queries`` are rows of the same kind. Vectors that are null or hold null or non-finite components
    take no part, nor do rows without an id; a query meets vectors of its own length only. Candidates
    are rows: one that is repeated takes a rank for each repeat. Rows that share the query's id count
    as its own. Queries repeated with their vector are asked once; different vectors under one query id are
    asked together, and their scores ranked as one list. Components saturate at the range of a long; rows are
    ranked by exact scores whatever their size, and scores that a long cannot hold are returned as its bounds.
    """
    spark = vectors.sparkSession
    arrow_rows(spark, 4096)
    schema = "query_id long, rank int, vec_id long, score long"
    own = [df.select(F.col(id_col).cast("long").alias("vec_id"), quantised(F.col(vec_col), scale).alias("q")).where("vec_id is not null and q is not null") for df in (vectors, queries)]
    asked = own[1].distinct()
    rows, wanted = own[0].count(), asked.count()
    blocks = max(1, -(-rows // BLOCK_ROWS))
    index = scratch.save(own[0].repartition(blocks).mapInArrow(_index(k), "block int, dims int, data binary"), "bit-slices", maxRecordsPerFile="1")
    heads = scratch.save(index.select(F.col("_metadata.file_path").alias("file"), "dims").coalesce(1), "directory").inputFiles()
    if not heads:
        return spark.createDataFrame([], schema)
    # a task has one lot and one stripe: queries are copied once a stripe, and blocks are read once a lot
    stripes = -(-blocks // STRIPE_BLOCKS)
    lots = max(1, -(-wanted // LOT_ROWS), min(64, -(-wanted // 32)))
    dealt = asked.withColumn("lot", F.pmod(F.xxhash64("vec_id", "q"), F.lit(lots)).cast("int")).withColumn("stripe", F.explode(F.sequence(F.lit(0), F.lit(stripes - 1))))
    dealt = dealt.repartitionById(lots * stripes, F.col("stripe") * lots + F.col("lot")).select("stripe", "vec_id", "q")
    found = dealt.mapInArrow(_search(heads[0], stripes, k), "query_id long, vec_id long, score long, key binary")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("key"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


#: The same rows in DuckDB SQL, for queries whose id 50 divides.
ORACLE = """
with v as (
  select vec_id, list_transform(embedding, lambda x: floor(256 * cast(x as double))) as q from embeddings
  where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
s as (
  select a.vec_id as query_id, b.vec_id, cast(list_dot_product(a.q, b.q) as bigint) as score
  from v a join v b on a.vec_id % 50 = 0 and a.vec_id <> b.vec_id),
r as (select *, cast(row_number() over (partition by query_id order by score desc, vec_id) as integer) as rank from s)
select query_id, rank, vec_id, score from r where rank <= 5
"""
