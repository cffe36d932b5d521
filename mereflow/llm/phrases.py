"""Phrases of words that occur together, mined by partitions (SON) and counted exactly.

The documents are dealt to shards. A phrase with a support of s in all of a language's words has at least the shard's part of
s in some shard, so each shard is mined completely at its proportionally lowered support, size by size: a phrase can only be
frequent in a shard if the phrases without its last and without its first word are. What is mined are hashes of phrases, and
the union of the shards' frequent ones, less those whose shards do not add up to the support, becomes a bitmap: phrases that
share a hash or a bit are only counted in vain. The last reading counts all candidates by their words, exactly, over all documents.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from mereflow import scratch
from mereflow.llm.common import LOWER, UPPER, arrow_rows

#: Bytes that end a piece of text.
BREAKS = b".,;:!?\n\x0b\x0c\r"
_TABLE = bytes.maketrans(UPPER.encode() + BREAKS + b"\t", LOWER.encode() + b"," * len(BREAKS) + b" ")
#: Shards, however many documents there are: their supports stay over one, and tasks share the mining of each.
SHARDS = 4
#: Words that a task holds between two emissions, and bytes that it takes at once.
BLOCK_WORDS, PART_BYTES = 1_500_000, 1 << 20
#: Bits of the bitmap for each candidate, and the most it may have: 32 MB, whatever the input.
BITS_EACH, MOST_BITS = 16, 1 << 28
#: Steps of the sketch of a language's scores.
SKETCH = 10_000
_MULT, _SHIFT = np.uint64(0x9E3779B97F4A7C15), np.uint64(29)
#: Bases of two independent hashes of words: sums of bytes times powers, modulo 2^64.
_BASES = (0xD6E8FEB86659FD93, 0xA0761D6478BD642F)
_powers: dict[tuple[int, bool], np.ndarray] = {}


def _power(base: int, n: int, inverse: bool = False) -> np.ndarray:
    """The first n powers of a base, or of its inverse, modulo 2^64."""
    held = _powers.get((base, inverse))
    if held is None or len(held) < n:
        step = np.full(max(n, PART_BYTES + 4096), pow(base, -1, 1 << 64) if inverse else base, np.uint64)
        step[0] = 1
        held = _powers[(base, inverse)] = np.cumprod(step)
    return held[:n]


def _fold(words: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all phrases of ``size`` words that follow one another, from the words' hashes."""
    m = max(0, len(words) - size + 1)
    out = np.full(m, size, np.uint64)
    for k in range(size):
        out = (out ^ words[k : k + m]) * _MULT
        out ^= out >> _SHIFT
    return out


class _Block:
    """Words of one language's texts: where they lie, their hashes and pieces, and whether a phrase that ends there counts."""

    def __init__(self, lang: str, hashes: int) -> None:
        import xxhash

        self.seed = np.uint64(xxhash.xxh64_intdigest(lang.encode("utf-8", "surrogatepass")))
        self.parts: list[bytes] = []
        self.rows: list[tuple[np.ndarray, ...]] = []
        self.hashes, self.words, self.bytes, self.pieces = hashes, 0, 0, 0

    def add(self, part: bytes, fresh_at: int) -> np.ndarray:
        """Take a part of a text; words that begin before ``fresh_at`` only lead in. Returns where its words begin."""
        buf = np.frombuffer(part, np.uint8)
        comma = buf == 44
        inside = np.zeros(len(buf) + 2, np.int8)
        inside[1:-1] = ~(comma | (buf == 32))
        turn = np.diff(inside)
        starts, ends = np.flatnonzero(turn == 1), np.flatnonzero(turn == -1)
        breaks = np.cumsum(comma, dtype=np.int64)
        value, out = buf.astype(np.uint64) + np.uint64(1), []
        for base in _BASES[: self.hashes]:
            total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(value * _power(base, len(buf), True))])
            h = (total[ends] - total[starts]) * _power(base, len(buf))[starts]
            h ^= h >> np.uint64(32)
            out.append((h ^ self.seed) * _MULT)
        pieces = breaks[starts] + self.pieces
        self.rows.append((starts + self.bytes, ends + self.bytes, pieces, starts >= fresh_at, *out))
        self.parts.append(part)
        self.pieces += int(breaks[-1]) + 1 if len(buf) else 1
        self.bytes += len(buf)
        self.words += len(starts)
        return starts

    def columns(self) -> list[np.ndarray]:
        return [np.concatenate(x) for x in zip(*self.rows)]


def _blocks(batches: Iterator[pa.RecordBatch], longest: int, hashes: int) -> Iterator[dict[str, _Block]]:
    """Blocks by language. Texts of a batch are taken together, part by part; the words before a part lead in, so each phrase ends in one part."""
    blocks: dict[str, _Block] = {}
    for batch in batches:
        texts: dict[str, list[bytes]] = {}
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
            if text:
                texts.setdefault(lang, []).append(text)
        for lang, own in texts.items():
            low, at, lead = b",".join(own).translate(_TABLE), 0, 0
            while at < len(low):
                if sum(b.words for b in blocks.values()) >= BLOCK_WORDS:
                    yield blocks
                    blocks = {}
                z = low.find(b" ", at + PART_BYTES)
                z = len(low) if z < 0 else z
                starts = blocks.setdefault(lang, _Block(lang, hashes)).add(low[lead:z], at - lead)
                before = starts[-(longest - 1) :] if longest > 1 else starts[:0]
                at, lead = z, lead + int(before[0]) if len(before) else z
    yield blocks


def _seen(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    at = hashes & np.uint64(len(bits) * 8 - 1)
    return bits[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8) & 1 == 1


def _valid(pieces: np.ndarray, fresh: np.ndarray, size: int) -> np.ndarray:
    m = max(0, len(pieces) - size + 1)
    return (pieces[:m] == pieces[size - 1 : size - 1 + m]) & fresh[size - 1 : size - 1 + m]


def _rows(lang: str, **columns: pa.Array) -> pa.RecordBatch:
    same = pa.array([lang]).take(pa.array(np.zeros(len(columns["n"]), np.int64)))
    return pa.RecordBatch.from_arrays([same, *columns.values()], names=["lang", *columns])


def _mine(size: int, shards: int, known):
    """Hashes of a size's phrases with their counts, by shard; ``known`` has the bits of the next smaller size's."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = TaskContext.get().partitionId() % shards
        bits = np.frombuffer(known.value, np.uint8) if known else None
        for blocks in _blocks(batches, size, 1):
            for lang, block in blocks.items():
                _, _, pieces, fresh, h = block.columns()
                good = _valid(pieces, fresh, size)
                if bits is not None and len(good):
                    less = _seen(bits, _fold(h, size - 1))
                    good &= less[:-1] & less[1:]
                key, n = np.unique(_fold(h, size)[good], return_counts=True)
                if len(n):
                    yield _rows(lang, shard=pa.array(np.full(len(n), shard, np.int32)), h=pa.array(key.view(np.int64)), n=pa.array(n))

    return run


def _count(longest: int, known):
    """Phrases of all sizes whose bits are set, with their counts: one row for occurrences that agree in two hashes of 64 bits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.frombuffer(known.value, np.uint8)
        for blocks in _blocks(batches, longest, 2):
            for lang, block in blocks.items():
                starts, ends, pieces, fresh, h, other = block.columns()
                text = b"".join(block.parts)
                for size in range(1, longest + 1):
                    key = _fold(h, size)
                    at = np.flatnonzero(_valid(pieces, fresh, size) & _seen(bits, key))
                    if not len(at):
                        continue
                    one, two = key[at], _fold(other, size)[at]
                    order = np.argsort(one, kind="stable")
                    one, two, at = one[order], two[order], at[order]
                    new = np.flatnonzero(np.concatenate([[True], (one[1:] != one[:-1]) | (two[1:] != two[:-1])]))
                    first, n = at[new], np.diff(np.append(new, len(at)))
                    words = [pa.array([text[a:z] for a, z in zip(starts[first + k].tolist(), ends[first + k].tolist())], pa.binary()) for k in range(size)]
                    phrase = pc.binary_join_element_wise(*words, pa.scalar(b" ")) if size > 1 else words[0]
                    yield _rows(lang, phrase=phrase, size=pa.array(np.full(len(n), size, np.int32)), n=pa.array(n))

    return run


def _bitmap(spark: SparkSession, hashes: DataFrame):
    """A bitmap of at most 32 MB with the bit of each hash set, as a broadcast value."""
    bits = min(MOST_BITS, max(1 << 16, 1 << (BITS_EACH * hashes.count()).bit_length()))
    at = F.pmod("h", F.lit(bits)) + 1
    rows = hashes.select(at.alias("at")).groupBy(F.bitmap_bucket_number("at").alias("k")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("at")).alias("m"))
    out = bytearray(bits // 8)
    for k, m in rows.collect():  # at most 8,192 rows of 4 KB
        out[(k - 1) * 4096 : k * 4096] = m
    return spark.sparkContext.broadcast(bytes(out))


def frequent(docs: DataFrame, support: int = 10, longest: int = 3, shards: int = SHARDS, lang_col: str = "lang", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, size, f) of all phrases of up to ``longest`` words (2 or 3) that occur ``support`` times, and (lang, n), n all words.

    A-Z are lower-cased, null texts are empty, a null language is ``und``. Words are what spaces and tabs part, pieces what
    ``.,;:!?`` and line ends part, and a phrase lies in one piece.
    """
    if longest not in (2, 3) or support < 1 or shards < 1:
        raise ValueError("phrases of 2 or 3 words, a support and shards of 1 or more")
    spark = docs.sparkSession
    arrow_rows(spark)
    texts = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), F.col(text_col).cast("binary").alias("text"))
    found, bits, shares = [], None, None
    for size in range(1, longest + 1):
        # dealt by the hash before anything is added up, for nearly all of a task's rows differ
        mined = texts.mapInArrow(_mine(size, shards, bits), "lang string, shard int, h long, n long").repartition("lang", "h").groupBy("lang", "shard", "h").agg(F.sum("n").alias("n"))
        if shares is None:  # a shard's words, of all words of the language
            mined = scratch.save(mined, "mined")
            per = mined.groupBy("lang", "shard").agg(F.sum("n").alias("own"))
            total = scratch.save(per.groupBy("lang").agg(F.sum("own").alias("n")), "words")
            least = F.expr(f"(own * {support} + n - 1) div n")
            shares = scratch.save(per.join(total, "lang").select("lang", "shard", least.alias("least")), "shares")
        # frequent in some shard, and in all shards together too, up to hashes that are shared
        either = mined.join(shares, ["lang", "shard"]).groupBy("lang", "h").agg(F.max(F.col("n") >= F.col("least")).alias("some"), F.sum("n").alias("f"))
        local = scratch.save(either.where(F.col("some") & (F.col("f") >= support)).select("h"), "local")
        found.append(local)
        bits = _bitmap(spark, local)
    every = found[0]
    for more in found[1:]:
        every = every.unionByName(more)
    counted = texts.mapInArrow(_count(longest, _bitmap(spark, every)), "lang string, phrase binary, size int, n long")
    counts = counted.groupBy("lang", "phrase", "size").agg(F.sum("n").alias("f")).where(F.col("f") >= support)
    return scratch.save(counts.withColumn("phrase", F.col("phrase").cast("string")), "phrases"), total


def scored(counts: DataFrame, share: int = 50) -> DataFrame:
    """(lang, phrase, size, a, l, r, score) of phrases of two words or more, from the counts of :func:`frequent`.

    Each is cut after its first k words; l and r are the parts' counts, and of the cuts the one of the lowest floor(10^6 a^2 / (l r))
    counts, of equal ones the first. Phrases inside a longer one that has ``share`` percent of their count or more are left out.
    """
    word = F.split("phrase", " ")
    own = counts.where("size > 1").select("lang", "phrase", "size", F.col("f").alias("a"), word.alias("w"))
    cut = own.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("size") - 1)))
    part = lambda a, n: F.array_join(F.slice("w", a, n), " ")
    cut = cut.select("lang", "phrase", "size", "a", "k", part(F.lit(1), F.col("k")).alias("first"), part(F.col("k") + 1, F.col("size") - F.col("k")).alias("rest"))
    for side, name in (("first", "l"), ("rest", "r")):
        cut = cut.join(counts.select("lang", F.col("phrase").alias(side), F.col("f").alias(name)), ["lang", side])
    big = lambda c: f"cast({c} as decimal(19, 0))"
    value = F.expr(f"cast(cast({big('a')} * {big('a')} as decimal(31, 0)) * cast(1000000 as decimal(7, 0)) as decimal(38, 0)) div cast({big('l')} * {big('r')} as decimal(38, 0))")
    best = cut.withColumn("score", value).groupBy("lang", "phrase", "size", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("c"))
    longer = own.where("size > 2").withColumn("k", F.explode(F.flatten(F.transform(F.sequence(F.lit(2), F.col("size") - 1), lambda n: F.transform(F.sequence(F.lit(1), F.col("size") - n + 1), lambda s: F.struct(s.alias("s"), n.alias("n")))))))
    inside = longer.select("lang", part(F.col("k.s"), F.col("k.n")).alias("phrase"), "a").groupBy("lang", "phrase").agg(F.max("a").alias("most"))
    left = best.join(inside, ["lang", "phrase"], "left").where(F.col("most").isNull() | (F.col("most") * 100 < F.col("a") * share))
    return left.select("lang", "phrase", "size", "a", F.col("c.l").alias("l"), F.col("c.r").alias("r"), F.col("c.score").alias("score"))


def collocations(docs: DataFrame, support: int = 10, longest: int = 3, most: int = 2000, share: int = 50, shards: int = SHARDS) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's ``most`` best phrases by score, then count, then phrase.

    A sketch of each language's scores gives one below which none of them can lie; of those above it, some twice as many as are
    wanted and what ties with them, lots are ranked first, so that no task gets more than ``most`` a lot.
    """
    counts, total = frequent(docs, support, longest, shards)
    best = scratch.save(scored(counts, share), "scored")
    high = F.col("score") * (1 << 32) + F.least("a", F.lit((1 << 32) - 1))
    steps = [1 - 0.5**j for j in range(1, 12)]
    cuts = best.groupBy("lang").agg(F.count(F.lit(1)).alias("of"), F.percentile_approx(high, steps, SKETCH).alias("at"))
    # the sketch errs by a part of 1 / SKETCH of all; a step is taken if enough lie above it even so
    above = F.filter(F.arrays_zip(F.array(*map(F.lit, steps)).alias("q"), F.col("at").alias("v")), lambda x: (1 - x["q"] - 2 / SKETCH) * F.col("of") > most)
    cuts = scratch.save(cuts.select("lang", F.coalesce(F.array_max(F.transform(above, lambda x: x["v"])), F.lit(-1)).alias("least")), "cuts")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    lots = max(2, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions", "200")))
    best = best.join(cuts, "lang").where(high >= F.col("least")).withColumn("lot", F.pmod(F.xxhash64("phrase"), F.lit(lots)))
    best = best.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "lot").orderBy(*order))).where(F.col("rank") <= most)
    best = best.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= most)
    return best.join(total, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


#: The same rows in DuckDB SQL.
ORACLE = rf"""
with d as (select coalesce(lang, 'und') as lang, translate(coalesce(text, ''), '{UPPER}', '{LOWER}') as t from documents),
p as (select lang, list_filter(regexp_split_to_array(x, '[ \t]+'), lambda v: v <> '') as w
      from (select lang, unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')) as x from d)),
g as (select lang, s as size, array_to_string(w[i:i+s-1], ' ') as phrase
      from (select lang, w, s, unnest(range(1, len(w)-s+2)) as i from p, range(1, 4) t(s) where len(w) >= s)),
f as (select lang, size, phrase, count(*) as f from g group by all),
n as (select lang, sum(f)::bigint as n from f where size = 1 group by 1),
c as (select lang, size, phrase, f as a, string_split(phrase, ' ') as w from f where size > 1 and f >= 10),
k as (select c.*, k, array_to_string(w[1:k], ' ') as p1, array_to_string(w[k+1:], ' ') as p2 from c, range(1, 3) t(k) where k < size),
s as (select k.lang, k.phrase, k.size, a, k, x.f as l, y.f as r, cast(1000000::hugeint*a*a//(x.f::hugeint*y.f) as bigint) as score
      from k join f x on x.lang=k.lang and x.phrase=p1 join f y on y.lang=k.lang and y.phrase=p2),
b as (select *, row_number() over (partition by lang, phrase order by score, k) as o from s),
u as (select lang, phrase, max(a) as most from (
        select lang, array_to_string(w[1:2], ' ') as phrase, a from c where size = 3 union all select lang, array_to_string(w[2:3], ' '), a from c where size = 3) group by 1, 2),
r as (select b.lang, row_number() over (partition by b.lang order by score desc, a desc, b.phrase) as rank, b.phrase, a, l, r, score
      from b left join u using (lang, phrase) where o = 1 and (most is null or 100*most < 50*a))
select lang, rank, phrase, a, l, r, n, score from r join n using (lang) where rank <= 2000
"""
