"""Benchmark decontamination as a prefix-filtered set join, in DataFrame operations only.

An item's windows are its runs of ``window`` words. Documents and items are cut into shingles of three
words; shingles are ordered by how rare they are in the documents, and a window must be contained
whole, so its one rarest shingle is the necessary prefix. Documents that hold this shingle give
candidates: an item laid at an offset, bounded to where the window fits. A candidate counts if
every shingle of an item-sized window is found at its position, with the words themselves compared.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mereflow import scratch
from mereflow.llm.common import ascii_lower

#: Bytes between words, as a Java pattern; what is left are digits, a-z and everything beyond ASCII.
GAPS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
SHINGLE = 3
#: Benchmark shingles of up to so many bytes are broadcast; more are joined by a shuffle.
BROADCAST_BYTES = 64 << 20
#: Bytes of a shingle's row beside its words.
ROW_BYTES = 80
NO_ID = -(1 << 63)


def words(text: Column) -> Column:
    """Words of the lower-cased text; none for null."""
    return F.array_remove(F.split(ascii_lower(F.coalesce(text.cast("string"), F.lit(""))), GAPS, -1), "")


def _shingles(df: DataFrame, w: str, size: int, *keep: str) -> DataFrame:
    """(keep, pos, a, b, c) for every word of the array ``w``, a row of nulls for none; c, b are null where size or text ends."""
    n = F.size(w)
    z = F.arrays_zip(F.col(w).alias("a"), F.slice(w, 2, n).alias("b"), F.slice(w, 3, n).alias("c"))
    out = df.select(*keep, F.posexplode_outer(z).alias("pos", "z"))
    none = F.lit(None).cast("string")
    return out.select(*keep, "pos", F.col("z.a").alias("a"), F.col("z.b").alias("b") if size > 1 else none.alias("b"), F.col("z.c").alias("c") if size > 2 else none.alias("c"), F.col("z.b").isNull().alias("last"))


def _joinable(df: DataFrame, size: int) -> DataFrame:
    """Broadcast only if the measured bytes are few."""
    return F.broadcast(df) if size <= BROADCAST_BYTES else df


def hit_words(docs: DataFrame, items: DataFrame, window: int = 10, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text") -> tuple[DataFrame, DataFrame]:
    """Two tables: (doc_id, h, n_words) of every document, and (d, h, item, first, last) of the windows' places.

    ``h`` is a hash of the text, so that rows which share an id but not a text stay apart; ``d`` is
    the id or the least long for null. An item of fewer words than ``window`` is one window, an item
    without words none; an item without an id counts under the name ``null``.
    """
    doc = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(F.col(text_col).cast("string")).alias("h"), words(F.col(text_col)).alias("w"))
    own = items.select(F.coalesce(F.col(item_col).cast("string"), F.lit("null")).alias("item"), words(F.col(item_text)).alias("w")).where(F.size("w") > 0)
    own = own.withColumn("u", F.xxhash64("item", "w")).withColumn("n", F.size("w")).dropDuplicates(["u"])
    of_items = None
    for size in range(1, SHINGLE + 1):
        fits = F.col("n") >= SHINGLE if size == SHINGLE else F.col("n") == size
        part = _shingles(own.where(fits), "w", size, "u", "item", "n").where(F.col("pos") <= F.col("n") - size).withColumn("size", F.lit(size))
        of_items = part if of_items is None else of_items.union(part)
    of_items = scratch.save(of_items.select("u", "item", "n", "size", F.col("pos").alias("s"), "a", "b", "c", F.xxhash64("a", "b", "c").alias("tok")), "item-shingles")
    weight = sum((F.coalesce(F.octet_length(c), F.lit(0)) for c in ("a", "b", "c", "item")), F.lit(ROW_BYTES))
    weighed = of_items.agg(F.sum(weight)).first()[0] or 0
    sizes = {r["size"] for r in of_items.select("size").distinct().collect()}  # at most three numbers

    hits = None
    for size in sorted({SHINGLE, *sizes}, reverse=True):
        known = of_items.where(F.col("size") == size).select(F.col("a").alias("a2"), F.col("b").alias("b2"), F.col("c").alias("c2"), "tok").distinct()
        place = _shingles(doc, "w", size, "doc_id", "h")
        same = (F.xxhash64("a", "b", "c") == F.col("tok")) & F.col("a").eqNullSafe(F.col("a2")) & F.col("b").eqNullSafe(F.col("b2")) & F.col("c").eqNullSafe(F.col("c2"))
        end = (F.col("last") if size == SHINGLE else F.lit(False)).alias("last")  # a row for every document, with its number of words
        found = place.join(_joinable(known, weighed), same, "left").select("doc_id", "h", "pos", "tok", end).where("tok is not null or last")
        hits = found if hits is None else hits.union(found)
    hits = scratch.save(hits.withColumn("d", F.coalesce("doc_id", F.lit(NO_ID))), "shingle-hits")
    told = hits.where("last").select("doc_id", "d", "h", (F.coalesce("pos", F.lit(-1)) + 1).cast("long").alias("n_words"))
    found = hits.where("tok is not null").select("d", "h", "pos", "tok")

    count = found.groupBy("tok").agg(F.count(F.lit(1)).alias("docs"))
    ahead = Window.partitionBy("u").orderBy("s").rowsBetween(0, window - SHINGLE)
    rare = F.min(F.struct(F.coalesce("docs", F.lit(0)).alias("docs"), "tok", F.col("s").alias("at"))).over(ahead)
    ranked = of_items.join(count, "tok", "left").withColumn("rare", rare)
    length = F.least(F.col("n"), F.lit(window))
    prefix = ranked.where((F.col("s") <= F.col("n") - length) & (F.col("rare.docs") > 0))
    prefix = prefix.groupBy("u", "n", "size", "rare.tok", "rare.at").agg(F.min("s").alias("lo"), F.max("s").alias("hi"))
    prefix = scratch.save(prefix, "prefixes")

    base = F.col("pos") - F.col("at")
    near = found.join(_joinable(prefix, weighed), "tok").withColumn("base", base)
    near = near.where(F.col("base") + F.col("hi") >= 0)  # some window of it starts within the text
    steps = F.sequence(F.greatest("lo", -F.col("base")), F.col("hi") + F.least(F.col("n"), F.lit(window)) - F.col("size"))
    near = near.select("d", "h", "u", "base", F.explode(steps).alias("s")).distinct()
    near = near.join(_joinable(of_items.select("u", "s", "item", "n", "size", "tok"), weighed), ["u", "s"]).withColumn("pos", F.col("base") + F.col("s"))
    sure = near.join(found, ["d", "h", "pos", "tok"], "left_semi")
    run = F.col("s") - F.row_number().over(Window.partitionBy("d", "h", "u", "base").orderBy("s"))
    runs = sure.withColumn("run", run).groupBy("d", "h", "u", "item", "n", "size", "base", "run").agg(F.min("s").alias("s0"), F.max("s").alias("s1"))
    runs = runs.where(F.col("s1") - F.col("s0") + F.col("size") >= F.least(F.col("n"), F.lit(window)))
    return told, runs.select("d", "h", "item", (F.col("base") + F.col("s0")).alias("first"), (F.col("base") + F.col("s1") + F.col("size") - 1).alias("last"))


def contamination(docs: DataFrame, items: DataFrame, window: int = 10, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items_sha256, contaminated), a row per document row.

    Null and wordless texts have no words and no hits. An empty ``items`` hits nothing. Columns
    other than the named ones play no part, whatever they are called.
    """
    told, places = hit_words(docs, items, window, id_col, text_col, item_col, item_text)
    before = F.max("last").over(Window.partitionBy("d", "h").orderBy("first", "last").rowsBetween(Window.unboundedPreceding, -1))
    fresh = F.greatest(F.lit(0), F.col("last") - F.greatest(F.col("first"), F.coalesce(before + 1, F.lit(0))) + 1)
    by_doc = places.withColumn("fresh", fresh).groupBy("d", "h").agg(F.sum("fresh").alias("n_hit"), F.sort_array(F.collect_set("item")).alias("names"))
    names = F.coalesce("names", F.array().cast("array<string>"))
    return told.join(by_doc, ["d", "h"], "left").select(
        "doc_id",
        "n_words",
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.size(names).cast("long").alias("n_items"),
        F.sha2(F.array_join(names, ","), 256).alias("items_sha256"),
        (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"),
    )


def drop_contaminated(docs: DataFrame, items: DataFrame, window: int = 10, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the rows that hold a window of any item; all columns stay."""
    _, places = hit_words(docs, items, window, id_col, text_col)
    hit = places.select(F.col("d").alias("__d2"), F.col("h").alias("__h2")).distinct()
    keyed = docs.withColumns({"__d": F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)), "__h": F.xxhash64(F.col(text_col).cast("string"))})
    return keyed.join(hit, (F.col("__d") == F.col("__d2")) & (F.col("__h") == F.col("__h2")), "left_anti").drop("__d", "__h")


#: The same rows in DuckDB SQL.
ORACLE = r"""
with dw as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from documents),
iw as (
  select cast(item_id as varchar) as item, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from benchmark),
win as (
  select distinct item, least(len(w), 10) as l, array_to_string(w[s:s + least(len(w), 10) - 1], ' ') as g
  from iw, unnest(range(1, len(w) - least(len(w), 10) + 2)) as t(s) where len(w) > 0),
dg as (
  select doc_id, l, s, array_to_string(w[s:s + l - 1], ' ') as g
  from dw, (select distinct l from win) as ls, unnest(range(1, len(w) - l + 2)) as t(s) where len(w) >= l),
occ as (select doc_id, item, s, l from dg join win using (l, g)),
hit as (select doc_id, count(distinct p) as n_hit from occ, unnest(range(s, s + l)) as t(p) group by doc_id),
its as (select doc_id, count(*) as n_items, string_agg(item, ',' order by item) as names from (select distinct doc_id, item from occ) group by doc_id)
select doc_id, cast(len(w) as bigint) as n_words, cast(coalesce(n_hit, 0) as bigint) as n_hit,
  cast(coalesce(n_items, 0) as bigint) as n_items, sha256(coalesce(names, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from dw left join hit using (doc_id) left join its using (doc_id)
"""
