"""Exact duplicates by progressive refinement: length, then a hash of the beginning, then a hash of the whole.

One reading counts (length, hash of the beginning); both come from the same text. Pairs that more than one row has survive,
and a bitmap of them goes to the second reading, in which the whole text is hashed for rows whose bit is set. A bit that two
pairs share only means a hash that was not needed: groups are those of the whole hash. What is shuffled are rows of a few
dozen bytes, never texts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mereflow import scratch
from mereflow.llm.common import LOWER, UPPER, join_hot

#: Characters of the beginning that are hashed.
HEAD = 256
#: Bits of the survivors' bitmap for each survivor, and the most it may have: 32 MB, whatever the input.
BITS_EACH, MOST_BITS = 16, 1 << 28


def normalised(text: Column) -> Column:
    """A-Z lower-cased, null as empty. Texts of ASCII only take the faster function."""
    t = F.coalesce(text.cast("string"), F.lit(""))
    return F.when(F.octet_length(t) == F.char_length(t), F.lower(t)).otherwise(F.translate(t, UPPER, LOWER))


def _first_keys(text: Column) -> tuple[Column, Column]:
    t = normalised(text)
    return F.octet_length(t).cast("long"), F.xxhash64(F.substring(t, 1, HEAD))


def survivors(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """(n_bytes, head, n): the pairs of length and hashed beginning that more than one row has."""
    size, head = _first_keys(F.col(text_col))
    return docs.select(size.alias("n_bytes"), head.alias("head")).groupBy("n_bytes", "head").agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def _bitmap(keys: Column, alive: DataFrame, bits: int) -> DataFrame:
    """(bucket, map): a bit per survivor, 32,768 bits a row."""
    at = F.pmod(keys, F.lit(bits)) + 1
    return alive.select(at.alias("at")).groupBy(F.bitmap_bucket_number("at").alias("__bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("at")).alias("__map"))


def groups(docs: DataFrame, *keep: str, id_col: str = "doc_id", text_col: str = "text", digest: bool = False) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, keep): one row per row of ``docs``.

    Texts are equal if they are identical after lower-casing A-Z; null counts as empty. ``keep_id`` is the largest id of the group
    and ``kept`` marks the row that has it, one of them if a row is repeated; a null id is less than any other. ``keep`` names
    columns to carry along. ``digest`` adds ``text_sha256`` (binary), which is then made for rows without a possible copy too.
    """
    spark = docs.sparkSession
    alive = scratch.save(survivors(docs, text_col), "survivors")
    bits = min(MOST_BITS, max(1 << 16, 1 << (BITS_EACH * alive.count()).bit_length()))
    marks = scratch.save(_bitmap(F.xxhash64("n_bytes", "head"), alive, bits), "marks")
    size, head = _first_keys(F.col(text_col))
    at = F.pmod(F.xxhash64(size, head), F.lit(bits)) + 1
    carried = {f"__k{i}": F.col(c) for i, c in enumerate(keep)}
    rows = docs.select(F.col(id_col).alias("__id"), normalised(F.col(text_col)).alias("__t"), at.alias("__at"), *(c.alias(n) for n, c in carried.items()))
    rows = rows.withColumn("__bucket", F.bitmap_bucket_number("__at")).join(F.broadcast(marks), "__bucket", "left")
    place = F.bitmap_bit_position("__at")
    byte = F.conv(F.hex(F.substring("__map", (place / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    maybe = F.coalesce(F.getbit(byte, (place % 8).cast("int")) == 1, F.lit(False))
    whole = F.unhex(F.sha2("__t", 256))
    rows = rows.withColumn("__maybe", maybe).select("__id", F.monotonically_increasing_id().alias("__row"), "__maybe", (whole if digest else F.when(F.col("__maybe"), whole)).alias("__full"), *carried)
    rows = scratch.save(rows, "rows")
    found = rows.where("__maybe").groupBy("__full").agg(F.count(F.lit(1)).alias("__n"), F.max(F.struct("__id", "__row")).alias("__best"))
    found = scratch.save(found.withColumn("__size", F.col("__n")), "groups")
    shared = join_hot(rows.where("__maybe"), found, "__full", "__n")
    shared = shared.select("__id", F.col("__best.__id").alias("__keep"), "__size", (F.col("__row") == F.col("__best.__row")).alias("__kept"), "__full", *carried)
    alone = rows.where("not __maybe").select("__id", F.col("__id").alias("__keep"), F.lit(1).cast("long").alias("__size"), F.lit(True).alias("__kept"), "__full", *carried)
    out = shared.unionByName(alone)
    more = [F.col("__full").alias("text_sha256")] if digest else []
    return out.select(F.col("__id").alias(id_col), F.col("__keep").alias("keep_id"), F.col("__size").alias("group_size"), F.col("__kept").alias("kept"), *more, *(F.col(f"__k{i}").alias(c) for i, c in enumerate(keep)))


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each group of equal texts, that of the largest id."""
    own = groups(docs.select(F.struct(*docs.columns).alias("__doc"), F.col(id_col).alias("__i"), F.col(text_col).alias("__x")), "__doc", id_col="__i", text_col="__x")
    return own.where("kept").select("__doc.*")


def digests(docs: DataFrame) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256 in lowercase hex) of every document."""
    return groups(docs, digest=True).withColumn("text_sha256", F.lower(F.hex("text_sha256")))


#: The same rows in DuckDB SQL.
ORACLE = f"""
with t as (select doc_id, translate(coalesce(text, ''), '{UPPER}', '{LOWER}') as t from documents)
select doc_id, max(doc_id) over w as keep_id, count(*) over w as group_size, doc_id = max(doc_id) over w as kept, sha256(t) as text_sha256
from t window w as (partition by t)
"""
