"""SimHash near-duplicates by deletion-variant signatures.

Two 64-bit fingerprints that differ in at most four bits agree up to one bit in one of three
segments. Every distinct fingerprint is indexed under its segments with one bit struck out, equal
keys are joined, and the join itself verifies the distance. Segments of 21 or 22 bits keep the
chance groups at a millionth of the fingerprints; five exact segments would have to do with 12 bits.
Keys that very many fingerprints share go on to variants of the whole fingerprint.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mereflow import scratch
from mereflow.llm.common import arrow_rows, join_hot
from mereflow.llm.xxh import xxh64
from mereflow.llm.xxh_sql import xxh64 as xxh64_sql
from mereflow.operators.components import connected_components

#: (first bit, bits) of the three segments.
SEGMENTS = ((0, 21), (21, 21), (42, 22))
CHUNK_BYTES = 2 << 20
#: For signatures, of which more arrays are held at a time.
SIGNED_BYTES = 512 << 10
#: Keys of more distinct fingerprints than this go on to variants of the whole fingerprint.
DENSE = 1024

_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: A byte's bits, most significant first, as the eight bytes of a word.
_SPREAD = np.ascontiguousarray(np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1)).view(np.uint64).ravel()


def _votes(h: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """Fingerprints of the hashes between the cuts: a bit is set if over half of them have it."""
    n = np.diff(cuts)
    pieces = -(-n // 255)
    owner = np.repeat(np.arange(len(n)), pieces)
    starts = np.repeat(cuts[:-1], pieces) + 255 * (np.arange(len(owner)) - np.repeat(np.cumsum(pieces) - pieces, pieces))
    octets = np.ascontiguousarray(h.astype(">u8")).view(np.uint8).reshape(-1, 8)
    sums = np.empty((len(owner), 64), np.int64)
    for k in range(8):
        sums[:, 8 * k : 8 * k + 8] = np.add.reduceat(_SPREAD[octets[:, k]], starts).view(np.uint8).reshape(-1, 8)
    total = np.add.reduceat(sums, np.cumsum(pieces) - pieces, axis=0)
    return np.packbits(2 * total > n[:, None], axis=1).view(">u8").ravel().astype(np.uint64)


def _words(texts: list[bytes]) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray]:
    """The lower-cased texts with one space after each word; and where each word begins and stops in it, and its text."""
    raw = _FOLD[np.frombuffer(b" ".join(texts) + b" ", np.uint8)]
    ends = np.cumsum([len(t) + 1 for t in texts])
    gap = _SPACE[raw]
    after = np.concatenate([[True], gap[:-1]])
    kept = np.flatnonzero(~gap | ~after)
    norm = raw[kept]
    stop = np.flatnonzero(gap[kept])  # the one gap after each word
    norm[stop] = 0x20
    begin = np.concatenate([[0], stop[:-1] + 1]) if len(stop) else stop
    return norm.tobytes(), begin, stop, np.searchsorted(ends, kept[stop], side="right")


def _shingles(norm: bytes, begin: np.ndarray, stop: np.ndarray, doc: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Texts that have words, their shingles' hashes one after the other, and the cuts between texts."""
    owners, first, n = np.unique(doc, return_index=True, return_counts=True)
    shingles = np.maximum(1, n - size + 1)
    total = np.cumsum(shingles)
    i = np.repeat(first - (total - shingles), shingles) + np.arange(total[-1])
    last = np.minimum(i + size - 1, np.repeat(first + n - 1, shingles))
    return owners, xxh64(norm, begin[i], stop[last]), np.concatenate([[0], total])


def fingerprints_of(texts: list[bytes], size: int = 4) -> np.ndarray:
    """Fingerprints of texts by XXH64 of their shingles of ``size`` words; no word gives 0."""
    out = np.zeros(len(texts), np.uint64)
    norm, begin, stop, doc = _words(texts)
    if len(stop):
        owners, h, cuts = _shingles(norm, begin, stop, doc, size)
        out[owners] = _votes(h, cuts)
    return out


def _distinct(h: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each text's different hashes in order, and the cuts between texts."""
    own = np.repeat(np.arange(len(cuts) - 1), np.diff(cuts))
    order = np.lexsort((h, own))
    h, own = h[order], own[order]
    new = np.concatenate([[True], (h[1:] != h[:-1]) | (own[1:] != own[:-1])])
    return h[new], np.concatenate([[0], np.cumsum(np.bincount(own[new], minlength=len(cuts) - 1))])


def _scatter(h: np.ndarray, k: int) -> np.ndarray:
    """The k-th of independent hashes made of one."""
    h = h * np.uint64(0x9E3779B97F4A7C15 + 2 * k * 0x632BE59BD9B4E019 & (1 << 64) - 1)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def fingerprints(docs: DataFrame, shingle: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, h, fp) of every whole text; ``h`` is a hash of the text. Null and wordless texts have fingerprint 0."""
    arrow_rows(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [x or b"" for x in batch.column("text").cast(pa.binary()).to_pylist()]
            fps, a, held = [], 0, 0
            for i, t in enumerate(texts):
                held += len(t)
                if held >= CHUNK_BYTES or i == len(texts) - 1:
                    fps.append(fingerprints_of(texts[a : i + 1], shingle))
                    a, held = i + 1, 0
            fp = pa.array(np.concatenate(fps).astype(np.int64) if fps else [], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("h"), fp], names=["doc_id", "h", "fp"])

    text = F.col(text_col).cast("string")
    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("h"), text.alias("text"))
    return own.mapInArrow(run, "doc_id long, h long, fp long")


def _keys(fp: str, space: str) -> Column:
    """A key for each segment and struck-out bit, which go into its upper half, as does the space above them."""
    over = F.shiftleft(F.col(space).cast("long"), 40)
    return F.array(
        *(
            (F.shiftrightunsigned(fp, lo).bitwiseAND(F.lit(((1 << n) - 1) & ~(1 << j)))).bitwiseOR(F.lit((s * 32 + j) << 32)).bitwiseOR(over)
            for s, (lo, n) in enumerate(SEGMENTS)
            for j in range(n)
        )
    )


def _place(key: str | Column) -> Column:
    """Segment times 32 plus struck-out bit of a key."""
    return F.shiftright(key, 32).bitwiseAND(F.lit(127))


def _crowded(fps: DataFrame, most: int) -> DataFrame:
    """Keys of the segments' values that over half of ``most`` fingerprints have: among them are all that over ``most`` share.

    A struck-out bit makes one key of two values, so three values of a fingerprint are counted instead of its 64 keys.
    """
    values = F.array(*(F.struct("space", F.lit(s).alias("s"), F.shiftrightunsigned("fp", lo).bitwiseAND(F.lit((1 << n) - 1)).alias("v")) for s, (lo, n) in enumerate(SEGMENTS)))
    heavy = fps.select(F.explode(values).alias("x")).groupBy("x").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > most // 2)
    back = F.lit(None).cast("long")
    for s, (lo, _) in enumerate(SEGMENTS):
        back = F.when(F.col("x.s") == s, F.shiftleft("x.v", lo)).otherwise(back)
    own = heavy.select("x.space", "x.s", back.alias("fp"))
    return own.select(F.explode(F.filter(_keys("fp", "space"), lambda k: F.shiftright(_place(k), 5) == F.col("s"))).alias("key")).distinct()


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _first_key(differs: Column) -> Column:
    """Of the keys that two fingerprints share, this is the first: so each link comes once."""
    at = _place("key")
    none = F.lit(False)
    for s, (lo, n) in reversed(list(enumerate(SEGMENTS))):
        apart = F.bit_count(differs.bitwiseAND(F.lit(_signed(((1 << n) - 1) << lo))))
        here = (at >= s * 32) & (at < s * 32 + 32) & ((apart == 1) | (at == s * 32))
        none = F.when(apart <= 1, here).otherwise(none)
    return none


def _around(fps: DataFrame, radius: int, inner: int) -> DataFrame:
    """(node, space, v, inside) with v each value within ``radius`` bits of the node's fingerprint; ``inside`` if within ``inner`` bits."""
    one = [1 << i for i in range(64)]
    masks = np.array([0, *one, *(one[i] | one[j] for i in range(64) for j in range(i))], np.uint64)
    masks = masks[np.bitwise_count(masks) <= radius]
    near = np.bitwise_count(masks) <= inner

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = batch.column("fp").to_numpy(zero_copy_only=False)
            row = pa.array(np.repeat(np.arange(len(fp)), len(masks)))
            node, space = batch.column("node").take(row), batch.column("space").take(row)
            values = (fp.astype(np.uint64)[:, None] ^ masks).ravel().astype(np.int64)
            yield pa.RecordBatch.from_arrays([node, space, pa.array(values), pa.array(np.tile(near, len(fp)))], names=["node", "space", "v", "inside"])

    arrow_rows(fps.sparkSession)
    return fps.mapInArrow(run, f"node {fps.schema['node'].dataType.simpleString()}, space int, v long, inside boolean")


def _linked_around(crowd: DataFrame, bits: int, hubs: bool = False) -> DataFrame:
    """Edges (a, b) that connect what differs in at most ``bits`` bits, through the values between.

    Two fingerprints differ in at most that many bits exactly if a value lies within half of them, rounded up, of the
    one and rounded down of the other; all that lie around such a value with an inner one are one component. They are
    linked to the smallest of them or, with ``hubs``, to the one that most others lie around as well.
    """
    # at most 2081 distinct fingerprints lie within two bits of a value, and as many values of a fingerprint: no window is larger
    value, own = Window.partitionBy("space", "v"), Window.partitionBy("node", "space")
    about = _around(crowd, -(-bits // 2), bits // 2).withColumns({"n": F.count(F.lit(1)).over(value), "some": F.max("inside").over(value)})
    about = scratch.save(about.where("n > 1 and some").select("node", "space", "v", "n"), "around")  # few values lie around more than one
    if hubs:
        about = about.withColumn("met", F.sum("n").over(own))
        head = F.first("node").over(value.orderBy(F.desc("met"), F.desc("node")))
    else:
        head = F.min("node").over(value)
    return about.withColumn("head", head).where("node <> head").select(F.col("node").alias("a"), F.col("head").alias("b")).distinct()


def links(fps: DataFrame, bits: int = 4, dense: int = DENSE, hubs: bool = False) -> DataFrame:
    """Edges (a, b) of nodes whose components are those of "fingerprints differ in at most ``bits`` bits", for bits up to 4.

    ``fps`` has columns node, of any type with an order, and fp, distinct; with a column space only fingerprints of one
    space are compared, and are distinct in it. Keys that hold over ``dense``
    fingerprints, and over 16 times what chance would put there, are not joined; the fingerprints in
    them go on to variants of the whole fingerprint, so that a dense group costs rows in
    proportion to its size and no link is lost.
    """
    if not 0 <= bits <= 4:
        raise ValueError("three segments hold for up to four bits")
    fps = fps.select("node", "fp", (F.col("space") if "space" in fps.columns else F.lit(0)).cast("int").alias("space"))
    most = max(dense, 16 * fps.count() >> 20)
    variants = fps.select("fp", F.explode(_keys("fp", "space")).alias("key"))
    crowded = scratch.save(_crowded(fps, most), "crowded")
    some = not crowded.isEmpty()
    few = variants.join(crowded, "key", "left_anti") if some else variants
    # both sides are renamed alike, so that they read one shuffle
    one, other = (few.select(F.col("fp").alias(f), F.col("key").alias(k)) for f, k in (("fp1", "key"), ("fp2", "key2")))
    differs = F.col("fp1").bitwiseXOR(F.col("fp2"))
    near = (F.bit_count(differs) <= bits) & _first_key(differs)
    pairs = one.join(other.hint("shuffle_merge"), (F.col("key") == F.col("key2")) & (F.col("fp1") < F.col("fp2")) & near)
    pairs = pairs.select(F.col("fp1").alias("fp"), "fp2", F.shiftright("key", 40).cast("int").alias("space"))
    pairs = scratch.save(pairs, "pairs")
    named = lambda fp, node: fps.select("space", F.col("fp").alias(fp), F.col("node").alias(node))
    edges = pairs.join(named("fp", "a"), ["space", "fp"]).join(named("fp2", "b"), ["space", "fp2"]).select("a", "b")
    if not some:
        return edges
    crowd = variants.join(crowded, "key", "left_semi").select("fp", F.shiftright("key", 40).cast("int").alias("space")).distinct()
    return edges.union(_linked_around(scratch.save(fps.join(crowd, ["space", "fp"]).select("node", "space", "fp"), "crowd"), bits, hubs))


def _rooted(docs: DataFrame, bits: int, shingle: int, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """(doc_id, h, fp) of every row; and (fp, n, root) of every fingerprint with the smallest row of its component.

    A node is its fingerprint's smallest row (none, doc_id, h), rows without an id last, and the fingerprint itself;
    so the component's smallest node already names its row, and nothing meets at the component.
    """
    fp = scratch.save(fingerprints(docs, shingle, id_col, text_col), "simhash")
    row = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "h")
    own = fp.groupBy("fp").agg(F.min(row).alias("m"), F.count(F.lit(1)).alias("n"))
    own = scratch.save(own.select("fp", "n", F.struct("m.none", "m.doc_id", "m.h", "fp").alias("node")), "fps")
    roots = connected_components(links(own, bits)).select(F.col("node").alias("node_"), "root")
    named = own.join(roots, F.col("node") == F.col("node_"), "left").select("fp", "n", F.coalesce("root", "node").alias("root"))
    return fp, scratch.save(named, "rooted")


def groups(docs: DataFrame, bits: int = 4, shingle: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fingerprint, component_id): near-duplicate groups of whole documents.

    ``fingerprint`` is 16 lower-case hex digits, ``component_id`` the smallest doc_id that links
    reach. Null, empty and wordless texts share fingerprint 0 and are linked like any other.
    Repeated rows give a row each; a null doc_id is never a component_id unless its whole group has none.
    Other columns are left out.
    """
    fp, rooted = _rooted(docs, bits, shingle, id_col, text_col)
    named = join_hot(fp, rooted.select("fp", "n", F.col("root.doc_id").alias("component_id")), "fp", "n")
    return named.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


_BITS = ", ".join(f"count(case when (h >> {k}) & 1 = 1 then 1 end)" for k in reversed(range(64)))
_NIBBLE = "8 * bits[4 * i + 1] + 4 * bits[4 * i + 2] + 2 * bits[4 * i + 3] + bits[4 * i + 4] + 1"
#: The rows of :func:`groups` in DuckDB SQL, for documents whose ids are not null and differ: all pairs of fingerprints, and all that each reaches.
ORACLE = rf"""
with recursive w as materialized (select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w from documents),
s as materialized (select doc_id, array_to_string(w[i:i + 3], ' ') as g from w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) as u(i) where len(w) > 0),
dg as (select distinct g from s), {xxh64_sql("dg", "hh")},
v as (select doc_id, count(*) as n, [{_BITS}] as b from s join hh using (g) group by 1),
b as (select w.doc_id, list_transform(coalesce(b, list_transform(range(0, 64), lambda x: 0)), lambda x: case when 2 * x > coalesce(n, 0) then 1 else 0 end) as bits from w left join v using (doc_id)),
f as materialized (select doc_id, array_to_string(list_transform(range(0, 16), lambda i: substr('0123456789abcdef', {_NIBBLE}, 1)), '') as fingerprint from b),
d as materialized (select fingerprint, cast('0x' || fingerprint as ubigint) as fp, min(doc_id) as m from f group by 1, 2),
e as materialized (select p.fingerprint as i, q.fingerprint as j from d p join d q on p.fp <> q.fp and bit_count(cast(xor(p.fp, q.fp) as hugeint)) <= 4),
r(i, j) as (select fingerprint, fingerprint from d union select r.i, e.j from r join e on e.i = r.j),
c as (select r.i as fingerprint, min(m) as component_id from r join d on d.fingerprint = r.j group by 1)
select doc_id, fingerprint, component_id from f join c using (fingerprint)
"""


def dedup(docs: DataFrame, bits: int = 4, shingle: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each near-duplicate group, all columns kept: that of smallest id.

    Rows that share this id and their text count as one, of which any stays; of different texts under it, one
    stays by a fixed order of the texts' hashes. A row without an id stays only where its group has no id.
    """
    _, rooted = _rooted(docs, bits, shingle, id_col, text_col)
    return _kept(docs, rooted, id_col, text_col)


def _kept(docs: DataFrame, rooted: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The rows of ``docs`` that are roots, one of each."""
    keep = rooted.select(F.col("root.doc_id").alias("__id"), F.col("root.h").alias("__h")).distinct()
    own = docs.withColumns({"__i": F.col(id_col).cast("long"), "__t": F.xxhash64(F.col(text_col).cast("string"))})
    found = own.join(keep, own["__i"].eqNullSafe(keep["__id"]) & (own["__t"] == keep["__h"]), "left_semi")
    return found.dropDuplicates(["__i", "__t"]).drop("__i", "__t")


# Similar texts ---------------------------------------------------------------------------------

#: Fingerprints over a text's different words, of which one within four bits makes a candidate.
VIEWS = 2
#: Keys of more fingerprints than this link to hubs, and shingles of more texts are crowded: a group of g near copies has no g * g candidates.
CROWD = 64
#: Up to this many crowded shingles (48 MB) are broadcast to order the texts' shingles; more are joined.
LISTED = 4 << 20
#: Times that the crowded shingles are added to by those of whole sets; what crowds share after that is compared crowd by crowd.
TURNS = 3
#: Up to this many asked texts (24 bytes each) are broadcast to the texts; for more, texts are shuffled.
ASKED = 1 << 19


def _needed(n: int, similarity: float) -> int:
    """Of this many first shingles of a text of ``n``, in any order common to all, one is shared with each similar text."""
    return n - math.ceil(similarity * n - 1e-9) + 1 if n else 0


def _noted(n: int, similarity: float) -> int:
    """Of so many smallest hashes of a text of ``n`` most texts can leave the crowded ones out and still have the first that are needed."""
    first = _needed(n, similarity)
    return min(n, first + first // 4 + 16)


def _signatures(docs: DataFrame, similarity: float, shingle: int, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, h, sig, f0, f1, ..., n, low) of every row.

    ``h`` is a hash of the text, ``sig`` one of its set of ``n`` shingles, f0 ... its fingerprints over words, and ``low`` the
    smallest hashes of its shingles: those of which it shares one with each similar text, and some more.
    """
    arrow_rows(docs.sparkSession)
    names = ["sig", *(f"f{k}" for k in range(VIEWS))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [x or b"" for x in batch.column("text").cast(pa.binary()).to_pylist()]
            out, a, held = np.zeros((len(texts), 1 + VIEWS), np.uint64), 0, 0
            n, low = np.zeros(len(texts), np.int64), [np.empty(0, np.int64)] * len(texts)
            for i, t in enumerate(texts):
                held += len(t)
                if held >= SIGNED_BYTES or i == len(texts) - 1:
                    norm, begin, stop, doc = _words(texts[a : i + 1])
                    if len(stop):
                        owners, h, cuts = _shingles(norm, begin, stop, doc, shingle)
                        h, cuts = _distinct(h.view(np.int64), cuts)
                        out[a + owners, 0] = np.add.reduceat(_scatter(h.view(np.uint64), 0), cuts[:-1])
                        n[a + owners] = np.diff(cuts)
                        for k, first, last in zip((a + owners).tolist(), cuts[:-1].tolist(), cuts[1:].tolist()):
                            low[k] = h[first : first + _noted(last - first, similarity)]
                        words, cuts = _distinct(*_shingles(norm, begin, stop, doc, 1)[1:])
                        for k in range(VIEWS):
                            out[a + owners, 1 + k] = _votes(_scatter(words, k), cuts)
                    a, held = i + 1, 0
            made = [*(pa.array(out[:, k].astype(np.int64)) for k in range(1 + VIEWS)), pa.array(n), pa.array(low, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("h"), *made], names=["doc_id", "h", *names, "n", "low"])

    text = F.col(text_col).cast("string")
    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("h"), text.alias("text"))
    return own.mapInArrow(run, ", ".join(f"{c} long" for c in ("doc_id", "h", *names, "n")) + ", low array<long>")


def _shingle_sets(texts: DataFrame, shingle: int) -> DataFrame:
    """(sig, hashes) for texts (sig, text): the different shingles in order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = []
            for t in batch.column("text").cast(pa.binary()).to_pylist():
                norm, begin, stop, doc = _words([t or b""])
                sets.append(np.unique(_shingles(norm, begin, stop, doc, shingle)[1].view(np.int64)) if len(stop) else np.empty(0, np.int64))
            yield pa.RecordBatch.from_arrays([batch.column("sig"), pa.array(sets, pa.list_(pa.int64()))], names=["sig", "hashes"])

    return texts.mapInArrow(run, "sig long, hashes array<long>")


def _sets_of(asked: DataFrame, own: DataFrame, docs: DataFrame, repeated: bool, shingle: int, id_col: str, text_col: str) -> DataFrame:
    """(sig, hashes) of the asked texts, read from the smallest row of each; ``repeated`` if rows may share their id and text."""
    reps = scratch.save(own.join(asked, "sig", "left_semi").select("sig", F.col("m.doc_id").alias("i_"), F.col("m.h").alias("h_")), "asked")
    reps = F.broadcast(reps) if reps.count() <= ASKED else reps
    text = F.col(text_col).cast("string")
    texts = docs.select(F.col(id_col).cast("long").alias("i"), F.xxhash64(text).alias("t"), text.alias("text"))
    texts = texts.join(reps, F.col("i").eqNullSafe(F.col("i_")) & (F.col("t") == F.col("h_"))).select("sig", "text")
    texts = texts.dropDuplicates(["sig"]) if repeated else texts
    return scratch.save(_shingle_sets(texts, shingle), "sets")


def _crowds(shingles: DataFrame, crowd: int) -> DataFrame:
    """(token, c) of the shingles that over ``crowd`` of the rows (token) have."""
    return scratch.save(shingles.groupBy("token").agg(F.count(F.lit(1)).alias("c")).where(F.col("c") > crowd), "crowds")


def _by_rarity(sets: DataFrame, crowds: DataFrame, similarity: float, listed: int) -> DataFrame:
    """(sig, n, low, deep, whole): the first shingles of each set where crowded ones come last, by their counts; those not crowded, and those crowded.

    With a column n, ``hashes`` are but the smallest of a set of n; where they do not hold all of its first shingles, it is not ``whole``.
    """
    part = "n" in sets.columns
    if crowds.count() <= listed:
        found = crowds.orderBy("token").toPandas()  # at most ``listed`` rows
        hot = sets.sparkSession.sparkContext.broadcast((found["token"].to_numpy(), found["c"].to_numpy()))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            tokens, counts = hot.value
            for batch in batches:
                n, low, deep, whole = batch.column("n").to_pylist() if part else [], [], [], []
                for k, x in enumerate(batch.column("hashes")):
                    h = x.values.to_numpy()
                    c = np.zeros(len(h), np.int64)
                    if len(tokens):
                        at = np.minimum(np.searchsorted(tokens, h), len(tokens) - 1)
                        c = np.where(tokens[at] == h, counts[at], 0)
                    if not part:
                        n.append(len(h))
                    first = np.lexsort((h, c))[: _needed(n[k], similarity)]
                    low.append(h[first[c[first] == 0]])
                    deep.append(h[first[c[first] > 0]])
                    whole.append(len(h) == n[k] or not len(deep[k]))
                made = [pa.array(n, pa.int64()), *(pa.array(x, pa.list_(pa.int64())) for x in (low, deep)), pa.array(whole, pa.bool_())]
                yield pa.RecordBatch.from_arrays([batch.column("sig"), *made], names=["sig", "n", "low", "deep", "whole"])

        return sets.mapInArrow(run, "sig long, n long, low array<long>, deep array<long>, whole boolean")
    each = sets.select("sig", *["n"] * part, F.explode("hashes").alias("token")).join(crowds, "token", "left")
    ordered = each.groupBy("sig", *["n"] * part).agg(F.array_sort(F.collect_list(F.struct(F.coalesce("c", F.lit(0)).alias("c"), "token"))).alias("x"))
    n = F.col("n") if part else F.size("x").cast("long")
    first = F.slice("x", F.lit(1), (n - F.ceil(n * similarity - 1e-9) + 1).cast("int"))
    kind = lambda keep: F.transform(F.filter(first, keep), lambda y: y["token"])
    made = ordered.select("sig", n.alias("n"), kind(lambda y: y["c"] == 0).alias("low"), kind(lambda y: y["c"] > 0).alias("deep"), F.size("x").alias("held"))
    return made.withColumn("whole", (F.col("held") == F.col("n")) | (F.size("deep") == 0)).drop("held")


def _pairs_of_few(each: DataFrame, roots: DataFrame, similarity: float) -> DataFrame:
    """(a, b) of texts of different roots that have enough of their first shingles in common, from rows (token, sig, n, at, deep).

    All texts have their shingles in one order; ``at`` is a shingle's place in it and ``deep`` how many of a text's first shingles have no
    row. What two texts share lies among the first of both, or behind the first of one of them and behind the last that they share there.
    """
    each = each.join(roots, "sig", "left").withColumn("root", F.coalesce("root", "sig"))
    own = F.struct("sig", "root", *(F.col(c).cast("int").alias(c) for c in ("n", "at", "deep")))
    lists = each.groupBy("token").agg(F.min("root").alias("least"), F.max("root").alias("most"), F.collect_list(own).alias("x"))
    one = lists.where("least <> most").select(F.explode("x").alias("o"), "x")
    o = F.col("o")
    apart = lambda y: (y["sig"] > o["sig"]) & (y["root"] != o["root"]) & (F.least(y["n"], o["n"]) >= F.greatest(y["n"], o["n"]) * similarity - 1e-9)
    met = one.select(F.col("o.sig").alias("a"), F.col("o.n").alias("n"), F.col("o.at").alias("i"), F.col("o.deep").alias("deep"), F.explode(F.filter("x", apart)).alias("y"))
    met = met.select("a", F.col("y.sig").alias("b"), F.col("n").alias("na"), F.col("y.n").alias("nb"), "i", F.col("y.at").alias("j"), F.least("deep", "y.deep").alias("deep"))
    met = met.groupBy("a", "b", "na", "nb", "deep").agg(F.count(F.lit(1)).alias("k"), F.max("i").alias("i"), F.max("j").alias("j"))
    behind = lambda n: F.ceil(F.col(n) * similarity - 1e-9) - 1
    most = F.greatest(F.least(behind("na"), F.expr("nb - j - 1")), F.least(behind("nb"), F.expr("na - i - 1")))
    return met.where(F.col("k") + F.col("deep") + most >= (F.col("na") + F.col("nb")) * similarity / (1 + similarity) - 1e-9).select("a", "b")


def _ends(pairs: DataFrame) -> DataFrame:
    """(sig) of the texts in pairs (a, b)."""
    return pairs.select(F.col("a").alias("sig")).union(pairs.select("b")).distinct()


def _alike(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """The pairs (a, b) whose sets reach the similarity."""
    ends = scratch.save(_ends(pairs), "ends")
    sets = sets.join(ends, "sig", "left_semi")
    both = pairs.join(sets.select(F.col("sig").alias("a"), F.col("hashes").alias("x")), "a").join(sets.select(F.col("sig").alias("b"), F.col("hashes").alias("y")), "b")
    shared = F.size(F.array_intersect("x", "y"))
    return both.where(shared >= similarity * (F.size("x") + F.size("y") - shared)).select("a", "b")


def _links_in_crowds(deep: DataFrame, sets: DataFrame, linked: DataFrame, similarity: float) -> DataFrame:
    """``linked`` with the links (a, b) between different groups of texts (token, sig, n, shared) that meet in crowded shingles.

    Texts that are linked already are not compared. Round by round each crowd's text that shares its fingerprints with most
    is compared with those of other groups; when that links no more, what is left of other groups is compared with all of its crowds.
    """
    seen, last = None, False
    pair = (F.least("sig", "to").alias("a"), F.greatest("sig", "to").alias("b"))
    fits = F.least("n", "n_to") >= F.greatest("n", "n_to") * similarity - 1e-9
    while True:
        roots = connected_components(linked).select(F.col("node").alias("sig"), "root")
        at = scratch.save(deep.drop("root").join(roots, "sig", "left").withColumn("root", F.coalesce("root", "sig")), "crowd")
        head = F.max_by(F.struct(F.col("sig").alias("to"), F.col("n").alias("n_to"), F.col("root").alias("root_to")), F.struct("shared", "sig"))
        mixed = at.groupBy("token").agg(F.min("root").alias("least"), F.max("root").alias("most"), head.alias("head")).where("least <> most")
        mixed = scratch.save(mixed.select("token", "head.*"), "mixed")
        at = deep = scratch.save(at.join(mixed, "token", "left_semi"), "crowd")  # groups only grow: crowds of one stay so
        found = at.join(mixed, "token").where("root <> root_to")
        if last:
            others = at.select("token", F.col("sig").alias("to"), F.col("n").alias("n_to"), F.col("root").alias("root_to"))
            found = found.drop("to", "n_to", "root_to").join(others, "token").where("root <> root_to")
        new = found.where(fits).select(*pair).distinct()
        new = scratch.save(new if seen is None else new.join(seen, ["a", "b"], "left_anti"), "asked")
        more = scratch.save(_alike(new, sets, similarity), "linked")
        some = not more.isEmpty()
        linked = linked.union(more)
        if last:
            return linked
        seen = new if seen is None else seen.union(new)
        last = not some


def similar(
    docs: DataFrame, similarity: float = 0.8, shingle: int = 5, id_col: str = "doc_id", text_col: str = "text", crowd: int = CROWD, listed: int = LISTED
) -> tuple[DataFrame, DataFrame]:
    """Two tables: (doc_id, h, sig) of every row; and (sig, root) of the different texts, with the smallest row of their group.

    Texts are one group where a chain of links joins them; a link is a Jaccard similarity of the sets of ``shingle``
    words of at least ``similarity``, compared exactly, and none is lost. Candidates are texts that one of ``VIEWS`` fingerprints
    over their different words puts within four bits, found by deletion variants; words change less than shingles
    do, so few bits do. They join large groups of copies at little cost. What they miss shares one of the first shingles
    in any order common to all texts: by hash, but shingles of over ``crowd`` texts last, so that passages that many
    share make no candidates. Texts that have to share such a shingle are compared where they are of different groups.
    Texts without words are one group.
    """
    signed = scratch.save(_signatures(docs, similarity, shingle, id_col, text_col), "signatures")
    rows = scratch.save(signed.select("doc_id", "h", "sig"), "rows")
    row = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "h")
    own = signed.groupBy("sig").agg(F.min(row).alias("m"), *(F.min(f"f{k}").alias(f"f{k}") for k in range(VIEWS)), F.min("n").alias("n"))
    own = scratch.save(own, "texts")
    first = scratch.save(signed.select("sig", "n", F.col("low").alias("hashes")).dropDuplicates(["sig"]), "first")  # a set's rows have the same
    scratch.drop(signed)
    # what a large group of near copies was copied from shares its fingerprints with the most of them: it speaks for them
    views = F.explode(F.array(*(F.struct(F.lit(k).alias("space"), F.col(f"f{k}").alias("fp")) for k in range(VIEWS))))
    each = own.select("sig", views.alias("x")).select("sig", "x.space", "x.fp")
    counts = each.groupBy("space", "fp").agg(F.count(F.lit(1)).alias("n"))
    weight = each.join(counts, ["space", "fp"]).groupBy("sig").agg(F.sum("n").alias("shared"))
    each = scratch.save(each.join(weight, "sig"), "views")
    fps = scratch.save(each.groupBy("space", "fp").agg(F.max_by("sig", F.struct("shared", "sig")).alias("node")), "fps")
    same = each.select(F.col("sig").alias("b"), "space", "fp").join(fps, ["space", "fp"]).where("node <> b").select(F.col("node").alias("a"), "b")
    found = links(fps, 4, crowd, hubs=True).union(same)
    pairs = scratch.save(found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "candidates")
    repeated = not rows.groupBy("doc_id", "h").agg(F.count(F.lit(1)).alias("c")).where("c > 1").isEmpty()
    sets_of = lambda asked: _sets_of(asked, own, docs, repeated, shingle, id_col, text_col)
    held = _ends(pairs)
    sets = sets_of(held)
    linked = scratch.save(_alike(pairs, sets, similarity), "linked")
    roots = connected_components(linked).select(F.col("node").alias("sig"), "root")
    # the first shingles of each text where those that crowds have come last; they are found among the smallest hashes of all texts
    met = _crowds(first.select(F.explode("hashes").alias("token")), 1)
    hot = scratch.save(met.where(F.col("c") > crowd), "crowds")
    spare = None
    for turn in range(TURNS):
        ordered = scratch.save(_by_rarity(first, hot, similarity, listed), "ordered")
        asked = ordered.where(~F.col("whole")).select("sig")
        asked = scratch.save(asked if spare is None else asked.join(spare, "sig", "left_anti"), "asked")
        if spare is not None and asked.isEmpty():
            break
        more = sets_of(asked)
        spare = more if spare is None else spare.union(more)
        # any set of crowded shingles makes an order that all texts have in common: this one adds what these whole sets have in common
        theirs = spare.select(F.explode("hashes").alias("token")).groupBy("token").agg(F.count(F.lit(1)).alias("c")).join(met.withColumnRenamed("c", "c_"), "token", "left")
        new = theirs.select("token", (F.col("c") + F.coalesce("c_", F.lit(0))).alias("c")).where(F.col("c") > crowd).join(hot, "token", "left_anti")
        new = scratch.save(new, "crowds")
        if turn == TURNS - 1 or new.isEmpty():
            break
        hot = scratch.save(hot.union(new), "crowds")
        scratch.drop(ordered)
    scratch.drop(first)
    rest = spare.join(ordered.where(~F.col("whole")), "sig", "left_semi")
    rest = scratch.save(_by_rarity(rest, hot, similarity, listed), "ordered")
    shared = met.select("token").union(rest.select(F.explode("low"))).distinct()
    ordered = ordered.where("whole").unionByName(rest)
    few = ordered.select("sig", "n", F.size("deep").alias("deep"), F.posexplode("low").alias("at", "token")).join(shared, "token", "left_semi")
    few = scratch.save(few, "few")
    # where whole sets were read, shingles can be crowded that are not among the smallest hashes of as many texts
    over = _crowds(few, crowd)
    more = few.join(over, "token", "left_semi").groupBy("sig").agg(F.count(F.lit(1)).alias("more"))
    deep = ordered.where(F.size("deep") > 0).select(F.explode("deep").alias("token"), "sig", "n")
    deep = scratch.save(deep.union(few.join(over, "token", "left_semi").select("token", "sig", "n")).join(weight, "sig"), "deep")
    few = few.join(over, "token", "left_anti").join(more, "sig", "left").withColumn("deep", F.col("deep") + F.coalesce("more", F.lit(0)))
    pairs = scratch.save(_pairs_of_few(few, roots, similarity), "candidates")
    asked = scratch.save(_ends(pairs).union(deep.select("sig")).distinct().join(held, "sig", "left_anti"), "asked")
    sets = sets.union(sets_of(asked))
    linked = linked.union(scratch.save(_alike(pairs, sets, similarity), "linked"))
    if not deep.isEmpty():
        linked = _links_in_crowds(deep, sets, linked, similarity)
    node = F.struct("m.none", "m.doc_id", "m.h", "sig")
    named = own.select("sig", node.alias("node"))
    edges = linked.join(named.select(F.col("sig").alias("a"), F.col("node").alias("x")), "a").join(named.select(F.col("sig").alias("b"), F.col("node").alias("y")), "b").select("x", "y")
    roots = connected_components(edges, "x", "y").select(F.col("node").alias("node_"), "root")
    return rows, named.join(roots, F.col("node") == F.col("node_"), "left").select("sig", F.coalesce("root", "node").alias("root"))


def dedup_similar(docs: DataFrame, similarity: float = 0.8, shingle: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each group of :func:`similar` texts, all columns kept; which one is as in :func:`dedup`."""
    _, rooted = similar(docs, similarity, shingle, id_col, text_col)
    return _kept(docs, rooted, id_col, text_col)
