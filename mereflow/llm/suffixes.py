"""Removal of repeated byte strings by bucket-pointer refinement.

Suffixes are put into buckets by their first byte; the bucket identifier of a suffix together with
that of the suffix 1, 2, 4, 8 and 16 bytes later gives its bucket by twice as many bytes, and each
new identifier is used again by the next step. With 32-byte buckets every string of ``length`` bytes
is stood for by its least bucket (a suffix of least identifier within it), so only every 35th suffix
or so is shuffled. Those alone in their bucket are done. Others are refined by the identifiers of the
later offsets that span all strings they stand for; what is equal there is settled for all of these
strings at once, and the rest, at the rims of repeats, is refined string by string.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mereflow import scratch
from mereflow.llm.common import arrow_rows

Q = 32
#: Bytes of text refined at once; a longer text is cut into overlapping pieces.
PIECE = 2 << 20
_INDEX = np.uint64((1 << 24) - 1)
_rng = np.random.default_rng(20240501)
_BYTE = _rng.integers(0, 1 << 64, 256, dtype=np.uint64)
_ODD = _rng.integers(0, 1 << 63, 16, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
NO_ID = -(1 << 63)


def _mix(a: np.ndarray, b: np.ndarray, level: int) -> np.ndarray:
    h = a * _ODD[level]
    h += b
    h ^= h >> np.uint64(31)
    return h


def _buckets(raw: np.ndarray) -> np.ndarray:
    """Identifiers by ``Q`` bytes of the suffixes that have as many."""
    ids, step, level = _BYTE[raw], 1, 0
    while step < Q:
        ids = _mix(ids[:-step], ids[step:], level)
        step, level = 2 * step, level + 1
    return ids


def _deeper(ids: np.ndarray, at: np.ndarray, n: np.ndarray | int) -> np.ndarray:
    """Identifiers of the strings of n bytes at ``at``: 64 <= n <= 256, from overlapping doubled buckets."""
    def b64(i):
        return _mix(ids[i], ids[i + 32], 5)

    n = np.broadcast_to(np.asarray(n), at.shape)
    short = n <= 128
    out = np.empty(len(at), np.uint64)
    i, m = at[short], n[short]
    out[short] = _mix(_mix(b64(i), b64(i + m - 64), 6), m.astype(np.uint64), 7)
    i, m = at[~short], n[~short]
    b128 = lambda j: _mix(b64(j), b64(j + 64), 8)
    out[~short] = _mix(_mix(b128(i), b128(i + m - 128), 9), m.astype(np.uint64), 10)
    return out


def _pieces(texts: list[bytes], length: int) -> Iterator[list[tuple[int, int, bytes]]]:
    """Lots of (text's number, offset, bytes) of about ``PIECE`` bytes; each string of ``length`` bytes lies in one piece."""
    lot, held = [], 0
    for k, t in enumerate(texts):
        for a in range(0, max(1, len(t) - length + 1), PIECE):
            part = t[a : a + PIECE + length - 1]
            if len(part) < length:
                continue
            if lot and held + len(part) > PIECE:
                yield lot
                lot, held = [], 0
            lot.append((k, a, part))
            held += len(part)
    if lot:
        yield lot


def _joined(doc: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Spans merged where they touch, by document."""
    if not len(doc):
        return doc, start, end
    order = np.lexsort((start, doc))
    doc, start, end = doc[order], start[order], end[order]
    number = np.cumsum(np.concatenate([[0], (doc[1:] != doc[:-1]).astype(np.int64)]))
    lift = int(end.max()) + 1
    far = np.maximum.accumulate(end + number * lift)  # the furthest end so far, reset by document
    new = np.concatenate([[True], start[1:] + number[1:] * lift > far[:-1]])
    first = np.flatnonzero(new)
    last = np.concatenate([first[1:], [len(doc)]]) - 1
    return doc[first], start[first], far[last] - number[last] * lift


def _first(keys: tuple[np.ndarray, ...], doc: np.ndarray, h: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers of those of each key that no other comes before, and of those that have an earlier one.

    Earlier is: of a smaller doc, or of the same doc and h and at a smaller place.
    """
    order = np.lexsort((at, h, doc, *keys))
    same = np.ones(max(0, len(order) - 1), bool)
    for k in keys:
        same &= k[order][1:] == k[order][:-1]
    lead = np.concatenate([[True], ~same])[: len(order)]
    text = np.concatenate([[True], ~same | (doc[order][1:] != doc[order][:-1]) | (h[order][1:] != h[order][:-1])])[: len(order)]
    head, own = (order[np.maximum.accumulate(np.where(x, np.arange(len(order)), 0))] for x in (lead, text))
    later = (doc[order] != doc[head]) | (at[order] != at[own])
    return order[text & ~later], order[later]


#: q: bucket by Q bytes; c: bucket by all that a run of strings spans, its lowest byte the run's length less one; doc and h:
#: the row of the text; lo: the run's first byte. Where lo < 0 the row is a repeat from byte -lo - 1 on of c + 1 strings.
_SAMPLED = pa.schema([("q", pa.int64()), ("c", pa.int64()), ("doc", pa.int64()), ("h", pa.int64()), ("lo", pa.int64())])
_KINDS = "q long, c long, doc long, h long, lo long"
_BYTE_MASK = np.uint64(255)
#: Contested buckets of up to so many different contexts are refined within one task, larger ones string by string; the spans are the same.
SMALL = 4096
#: Slots of fewer rows never weigh on a task.
LIGHT = 256


def _rows(schema: pa.Schema, *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c.view(np.int64) if c.dtype == np.uint64 else c, f.type) for c, f in zip(columns, schema)], schema=schema)


def _sample(length: int):
    """Texts to sampled suffixes and, where a lot itself holds an earlier copy, spans to remove."""
    width = length - Q + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, hashes = (batch.column(k).to_numpy(zero_copy_only=False) for k in ("doc", "h"))
            for lot in _pieces([x or b"" for x in batch.column("text").cast(pa.binary()).to_pylist()], length):
                ids = _buckets(np.frombuffer(b"".join(p for _, _, p in lot), np.uint8))
                low = (ids & ~_INDEX) | np.arange(len(ids), dtype=np.uint64)
                step = 1
                while 2 * step <= width:
                    low = np.minimum(low[:-step], low[step:])
                    step *= 2
                if width > step:
                    low = np.minimum(low[: len(low) - (width - step)], low[width - step :])
                low = (low & _INDEX).astype(np.int64)
                sizes = np.array([len(p) for _, _, p in lot])
                begins = np.cumsum(sizes) - sizes
                n = sizes - length + 1
                total = np.cumsum(n)
                own = np.repeat(np.arange(len(lot)), n)
                at = np.arange(total[-1]) + np.repeat(begins - (total - n), n)
                least = low[at]
                turn = np.flatnonzero(np.concatenate([[True], (least[1:] != least[:-1]) | (own[1:] != own[:-1])]))
                lo, hi = at[turn], at[np.concatenate([turn[1:], [len(at)]]) - 1]
                x, own = least[turn], own[turn]
                span = hi - lo + length
                q = ids[x]
                c = (_mix(_deeper(ids, lo, span), (x - lo).astype(np.uint64), 11) & ~_BYTE_MASK) | (hi - lo).astype(np.uint64)
                text = np.array([k for k, _, _ in lot])[own]
                doc, h = keys[text], hashes[text]
                shift = np.array([a for _, a, _ in lot])[own] - begins[own]
                lo, hi = lo + shift, hi + shift
                keep, drop = _first((c, q), doc, h, lo)
                yield _rows(_SAMPLED, q[keep], c[keep], doc[keep], h[keep], lo[keep])
                yield from _repeats(doc[drop], h[drop], lo[drop], hi[drop] + length, length)

    return run


def _repeats(doc: np.ndarray, h: np.ndarray, start: np.ndarray, end: np.ndarray, length: int) -> Iterator[pa.RecordBatch]:
    rows, first, text = np.unique(np.column_stack([doc, h]), axis=0, return_index=True, return_inverse=True) if len(doc) else (doc, doc, doc)
    k, s, e = _joined(text.ravel(), start, end)
    if len(k):
        d, h = rows[k, 0], rows[k, 1]
        yield _rows(_SAMPLED, d, e - s - length, d, h, -s - 1)


def _contexts(length: int):
    """Texts with contested runs to a row per run with the bytes that it spans (runs: q, lo, n)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            q, doc, hs, lo, raw = [], [], [], [], []
            for d, h, text, runs in zip(*(batch.column(k).to_pylist() for k in ("doc", "h")), batch.column("text").cast(pa.binary()).to_pylist(), batch.column("at").to_pylist()):
                for r in runs:
                    q.append(r["q"])
                    doc.append(d)
                    hs.append(h)
                    lo.append(r["lo"])
                    raw.append(text[r["lo"] : r["lo"] + r["n"] + length])
            yield pa.RecordBatch.from_arrays([*(pa.array(x, pa.int64()) for x in (q, doc, hs, lo)), pa.array(raw, pa.binary())], names=["q", "doc", "h", "lo", "raw"])

    return run


def _spell(q, doc, h, lo, raw: list[bytes], length: int) -> tuple[np.ndarray, ...]:
    """(q, bucket by ``length`` bytes, doc, h, first byte) of every string of the runs."""
    ids = _buckets(np.frombuffer(b"".join(raw), np.uint8))
    sizes = np.array([len(r) for r in raw])
    n = sizes - length + 1
    total = np.cumsum(n)
    step = np.arange(total[-1]) - np.repeat(total - n, n)
    at = np.repeat(np.cumsum(sizes) - sizes, n) + step
    return np.repeat(q, n), _deeper(ids, at, length), np.repeat(doc, n), np.repeat(h, n), np.repeat(lo, n) + step


def _refine_within(length: int):
    """Runs sorted by q, whole buckets at a time, to repeats."""

    def settle(rows):
        q, c, doc, h, at = _spell(*(np.concatenate([r[k] for r in rows]) for k in range(4)), [x for r in rows for x in r[4]], length)
        _, drop = _first((c, q), doc, h, at)
        yield from _repeats(doc[drop], h[drop], at[drop], at[drop] + length, length)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            new = tuple(batch.column(k).to_numpy(zero_copy_only=False) for k in ("q", "doc", "h", "lo")) + (batch.column("raw").to_pylist(),)
            done = int(np.flatnonzero(np.concatenate([[True], new[0][1:] != new[0][:-1]]))[-1])  # the last bucket may go on
            if held and (done or held[-1][0][-1] != new[0][0]):
                own = [*held, tuple(x[:done] for x in new)] if done else held
                yield from settle(own)
                held = [tuple(x[done:] for x in new)]
            elif done:
                yield from settle([tuple(x[:done] for x in new)])
                held = [tuple(x[done:] for x in new)]
            else:
                held.append(new)
        if held:
            yield from settle(held)

    return run


def _refine_apart(length: int):
    """Runs of large buckets to a row for each string, by its own bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            q, c, doc, h, at = _spell(*(batch.column(k).to_numpy(zero_copy_only=False) for k in ("q", "doc", "h", "lo")), batch.column("raw").to_pylist(), length)
            c = c & ~_BYTE_MASK
            keep, drop = _first((c, q), doc, h, at)
            yield _rows(_SAMPLED, q[keep], c[keep], doc[keep], h[keep], at[keep])
            yield from _repeats(doc[drop], h[drop], at[drop], at[drop] + length, length)

    return run


#: Buckets are counted by so many slots before they are dealt.
SLOTS = 1 << 16


def _crowded(rows: DataFrame, least: int) -> Column | None:
    """c where the bucket is in a slot of so many rows that it would weigh on its task, else null; None if there is no such slot.

    A crowded slot holds over a quarter of a task's fair share, so there are at most four per task.
    """
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    slot = F.pmod(F.col("q"), F.lit(SLOTS))
    counts = scratch.save(rows.where("lo >= 0").groupBy(slot.alias("slot")).agg(F.count(F.lit(1)).alias("n")), "slots")
    total = counts.agg(F.sum("n")).first()[0] or 0
    most = max(least, total / (4 * parts), 4 * total / SLOTS)
    slots = [r["slot"] for r in counts.where(F.col("n") > most).select("slot").collect()]  # at most 4 x parts numbers
    scratch.drop(counts)
    return F.when(slot.isin(slots), F.col("c")) if slots else None


def _settle(rows: DataFrame, apart: Column | None, small: int) -> DataFrame:
    """Adds ``later`` (an earlier row has the same q and c) and ``rivals`` (how many c its q has, if it is the first of its c).

    Buckets of which ``apart`` is not null are dealt by it too; they count as having more than ``small`` rivals.
    """
    by = [F.col("q")] if apart is None else [F.col("q"), apart]
    in_order = Window.partitionBy(*by).orderBy("c", "doc", "h", "lo")
    changed = lambda *of: F.coalesce(F.lag(F.struct(*of)).over(in_order) != F.struct(*of), F.lit(True))
    own = F.col("lo") >= 0
    dealt = rows.withColumns({"lead": own & changed("c"), "text": own & changed("c", "doc", "h")})
    so_far = in_order.rowsBetween(Window.unboundedPreceding, 0)
    head = lambda mark, c: F.last(F.when(F.col(mark), F.col(c)), ignorenulls=True).over(so_far)
    rivals = F.sum(F.col("lead").cast("int")).over(Window.partitionBy(*by))
    if apart is not None:
        rivals = F.when(apart.isNull(), rivals).otherwise(small + 1)
    dealt = dealt.withColumns({"head": head("lead", "doc"), "place": head("text", "lo"), "rivals": rivals})
    return dealt.withColumn("later", ~own | (F.col("doc") != F.col("head")) | (F.col("lo") != F.col("place"))).drop("head", "place", "lead", "text")


def _extent(rows: DataFrame, length: int) -> DataFrame:
    """(doc, h, s, e) of rows that are repeats as a whole."""
    own = F.col("lo") >= 0
    s = F.when(own, F.col("lo")).otherwise(-F.col("lo") - 1)
    return rows.select("doc", "h", s.alias("s"), (s + F.when(own, F.col("c").bitwiseAND(F.lit(255))).otherwise(F.col("c")) + length).alias("e"))


def _rows_of(docs: DataFrame, id_col: str, text_col: str) -> tuple[Column, Column]:
    """What tells the rows of ``docs`` apart: the id, the least long for null, and a hash of the text where ids repeat, else 0."""
    doc = F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID))
    repeated = docs.select(doc.alias("doc")).groupBy("doc").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return doc, F.lit(0).cast("long") if repeated.isEmpty() else F.xxhash64(F.col(text_col).cast("string"))


def repeated_spans(docs: DataFrame, length: int = 100, id_col: str = "doc_id", text_col: str = "text", small: int = SMALL) -> DataFrame:
    """(doc, h, spans): per row the byte ranges [s, e) covered by earlier strings of ``length`` bytes, not yet merged.

    Earlier is: in a row of smaller id, or in the same row from an earlier byte. ``doc`` is the id, or
    the least long for a null id, which so counts as the smallest; ``h`` is a hash of the text where ids
    repeat, else 0. Rows that share an id leave each other alone, whatever their texts.
    """
    if not 64 <= length <= 128:
        raise ValueError("length is from 64 to 128 bytes")
    arrow_rows(docs.sparkSession)
    doc, h = _rows_of(docs, id_col, text_col)
    texts = docs.select(doc.alias("doc"), h.alias("h"), F.col(text_col).cast("string").alias("text"))
    contested = ~F.col("later") & (F.col("rivals") > 1)
    suffixes = texts.mapInArrow(_sample(length), _KINDS)
    sampled = _settle(suffixes, _crowded(suffixes, min(small, LIGHT)), small).where(F.col("later") | contested).select("later", "rivals", *_SAMPLED.names)
    first = scratch.save(sampled, "suffixes")
    spans = _extent(first.where("later"), length)
    for apart in (False, True):
        own = first.where(~F.col("later") & ((F.col("rivals") > small) if apart else (F.col("rivals") <= small)))
        if apart and own.isEmpty():
            break
        runs = own.groupBy("doc", "h").agg(F.collect_list(F.struct("q", "lo", F.col("c").bitwiseAND(F.lit(255)).alias("n"))).alias("at"))
        raw = texts.join(runs, ["doc", "h"]).select("doc", "h", "text", "at").mapInArrow(_contexts(length), "q long, doc long, h long, lo long, raw binary")
        if apart:
            found = _settle(raw.mapInArrow(_refine_apart(length), _KINDS), F.col("c"), small).where("later")
        else:
            found = raw.repartition("q").sortWithinPartitions("q").mapInArrow(_refine_within(length), _KINDS)
        spans = spans.union(_extent(found, length))
    return spans.groupBy("doc", "h").agg(F.collect_list(F.struct("s", "e")).alias("spans"))


def _with_spans(docs: DataFrame, length: int, id_col: str, text_col: str) -> DataFrame:
    """``docs`` with a column ``__spans``."""
    doc, h = _rows_of(docs, id_col, text_col)
    spans = repeated_spans(docs, length, id_col, text_col).select(F.col("doc").alias("__doc"), F.col("h").alias("__h"), F.col("spans").alias("__spans"))
    own = docs.withColumns({"__d": doc, "__t": h})
    return own.join(spans, (F.col("__d") == F.col("__doc")) & (F.col("__t") == F.col("__h")), "left").drop("__doc", "__h", "__d", "__t")


def _cut(raw: bytes, spans: list[dict] | None) -> tuple[bytes, list[tuple[int, int]]]:
    gone: list[tuple[int, int]] = []
    for s, e in sorted((x["s"], min(x["e"], len(raw))) for x in spans or [] if x["s"] < len(raw)):
        if gone and s <= gone[-1][1]:
            gone[-1] = (gone[-1][0], max(e, gone[-1][1]))
        else:
            gone.append((s, e))
    kept, at = [], 0
    for s, e in gone:
        kept.append(raw[at:s])
        at = e
    return b"".join([*kept, raw[at:]]), gone


def digests(docs: DataFrame, length: int = 100) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) of every document; a null text is empty."""
    import hashlib

    schema = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for raw, spans in zip(batch.column("text").cast(pa.binary()).to_pylist(), batch.column("spans").to_pylist()):
                kept, gone = _cut(raw or b"", spans)
                out.append((len(raw or b""), sum(e - s for s, e in gone), len(gone), hashlib.sha256(kept).hexdigest()))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(c, f.type) for c, f in zip(zip(*out), list(schema)[1:]))] if out else [pa.array([], f.type) for f in schema], schema=schema)

    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    joined = _with_spans(own, length, "doc_id", "text").select("doc_id", "text", F.col("__spans").alias("spans"))
    return joined.mapInArrow(run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def remove(docs: DataFrame, length: int = 100, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with repeated bytes cut from its texts; every other column and row stays.

    A character of which only some bytes are repeated stays, so that texts stay valid. Null stays null.
    """

    def cut(texts, spans):
        import pandas as pd

        out = []
        for t, s in zip(texts, spans):
            if t is None or s is None or not len(s):
                out.append(t)
                continue
            raw = t.encode()
            _, gone = _cut(raw, [{"s": x["s"], "e": x["e"]} for x in s])
            kept, at = [], 0
            for a, z in gone:
                while a < z and raw[a] & 0xC0 == 0x80:
                    a += 1
                while z > a and z < len(raw) and raw[z] & 0xC0 == 0x80:
                    z -= 1
                kept.append(raw[at:a])
                at = max(at, z)
            out.append(b"".join([*kept, raw[at:]]).decode())
        return pd.Series(out, dtype=object)

    from pyspark.sql.types import StringType

    joined = _with_spans(docs, length, id_col, text_col)
    return joined.withColumn(text_col, F.pandas_udf(cut, StringType())(F.col(text_col), F.col("__spans"))).drop("__spans")


#: The same rows in DuckDB SQL, for documents whose ids are not null and differ: every string of 100 bytes, in hex, by its digest.
ORACLE = """
with t as materialized (select doc_id, hex(encode(coalesce(text, ''))) as h, strlen(coalesce(text, '')) as n from documents),
w as (select doc_id, p, md5(substr(h, 2 * p + 1, 200)) as k from t, unnest(range(0, greatest(n - 99, 0))) as u(p)),
r as (select doc_id, p from (select doc_id, p, row_number() over (partition by k order by doc_id, p) as r from w) where r > 1),
g as (select doc_id, p, case when p - lag(p) over (partition by doc_id order by p) <= 100 then 0 else 1 end as new from r),
i as (select doc_id, p, sum(new) over (partition by doc_id order by p) as run from g),
s as (select doc_id, run, min(p) as a, max(p) + 100 as z from i group by 1, 2),
m as (select doc_id, count(*) as n_spans, sum(z - a) as n_removed from s group by 1),
e as (select doc_id, a, z from s union all select doc_id, n, n from t),
k as (select doc_id, a, coalesce(lag(z) over (partition by doc_id order by a, z), 0) as b from e),
o as (select doc_id, string_agg(substr(h, 2 * b + 1, 2 * (a - b)), '' order by b) as kept from k join t using (doc_id) where a > b group by 1)
select t.doc_id, cast(n as bigint) as n_bytes, cast(coalesce(n_removed, 0) as bigint) as n_removed, cast(coalesce(n_spans, 0) as bigint) as n_spans, sha256(unhex(coalesce(kept, ''))) as kept_sha256
from t left join m using (doc_id) left join o using (doc_id)
"""
