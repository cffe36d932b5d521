"""Connected water, labels across tiles, and splitting of labels by height."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mereflow import scratch
from mereflow.operators.components import connected_components

#: A pixel's place as one number: tile, azimuth and range in 20 bits each.
def pixel_id(tile: str = "tile_number") -> Column:
    return F.shiftleft(F.col(tile).cast("long"), 40).bitwiseOR(F.shiftleft(F.col("azimuth_index").cast("long"), 20)).bitwiseOR(F.col("range_index").cast("long"))


#: Pixels along a side of the blocks in which pixels are linked before the blocks are.
BLOCK = 128


def _linked_in_block(types: dict[str, str], tile: str, diagonal: bool, repeats: bool):
    """A block's pixels, at most ``BLOCK`` squared different ones, with ``run``: the smallest pixel id that they reach inside the block; once each but for ``repeats``."""
    import numpy as np
    import pandas as pd

    moves = ((1, 0), (0, 1), (1, 1), (1, -1)) if diagonal else ((1, 0), (0, 1))

    def link(block):
        ids, at, again = np.unique(block["id"].to_numpy(), return_index=True, return_inverse=True)
        a, r = block["azimuth_index"].to_numpy()[at], block["range_index"].to_numpy()[at]
        u, v = a - a.min() + 1, r - r.min() + 1
        place = np.full((u.max() + 2, v.max() + 2), -1)
        place[u, v] = np.arange(len(ids))
        beside = [(np.arange(len(ids)), place[u + da, v + dr]) for da, dr in moves]
        i, j = np.concatenate([n[m >= 0] for n, m in beside]), np.concatenate([m[m >= 0] for _, m in beside])
        root = np.arange(len(ids))
        while True:
            low, nxt = np.minimum(root[i], root[j]), root.copy()
            np.minimum.at(nxt, root[i], low)
            np.minimum.at(nxt, root[j], low)
            nxt = nxt[nxt]
            if (nxt == root).all():
                break
            root = nxt
        own = {tile: block[tile].to_numpy()[at], "azimuth_index": a, "range_index": r, "run": ids[root]}
        return pd.DataFrame({k: v[again] for k, v in own.items()} if repeats else own)

    return link, ", ".join([*(f"{c} {types[c]}" for c in (tile, "azimuth_index", "range_index")), "run bigint"])


def lake_labels(pixels: DataFrame, diagonal: bool = False, tile: str = "tile_number") -> DataFrame:
    """``pixels`` with ``label``: the smallest pixel id of its connected region in the tile.

    Pixels are dealt once, into blocks of a bounded size, and linked there; the graph has a node per region of a block
    that touches one of another block. Pixels of no other columns are not joined back. 4-connected, or 8-connected with ``diagonal``. Repeated pixels share a label.
    """
    place = [tile, "azimuth_index", "range_index"]
    block = [F.floor(F.col(c) / BLOCK).alias(f"__{c}") for c in place[1:]]
    cells = pixels.select(*place).where(" and ".join(f"{c} is not null" for c in place)).withColumn("id", pixel_id(tile))
    bare = set(pixels.columns) == set(place)
    link, schema = _linked_in_block(dict(pixels.dtypes), tile, diagonal, bare)
    runs = scratch.save(cells.groupBy(tile, *block).applyInPandas(link, schema), "runs")
    border = [F.pmod(F.col(c), F.lit(BLOCK)).isin(0, BLOCK - 1) for c in place[1:]]
    rim = runs.where(border[0] | border[1]).distinct()
    moves = ((1, 0), (0, 1), (1, 1), (1, -1)) if diagonal else ((1, 0), (0, 1))
    steps = F.explode(F.array(*(F.struct(F.lit(a).alias("a"), F.lit(r).alias("r")) for a, r in moves)))
    moved = rim.withColumn("m", steps).select(tile, (F.col("azimuth_index") + F.col("m.a")).alias("azimuth_index"), (F.col("range_index") + F.col("m.r")).alias("range_index"), F.col("run").alias("other"))
    touch = scratch.save(rim.join(moved.hint("merge"), place).where("run <> other").select(F.col("run").alias("a"), F.col("other").alias("b")).distinct(), "touching-runs")
    named = runs.withColumnRenamed("run", "label")
    if not touch.isEmpty():
        root = connected_components(touch)
        named = runs.join(root.hint("merge"), runs.run == root.node, "left").select(*place, F.coalesce("root", "run").alias("label"))
    return named if bare else pixels.join(named.hint("merge"), place)


def large_regions(labelled: DataFrame, min_area: float) -> DataFrame:
    """Pixels of the labels whose pixel areas add up to more than ``min_area``."""
    size = labelled.groupBy("label").agg(F.sum("pixel_area").alias("__a")).where(F.col("__a") > min_area)
    return labelled.join(size.select("label"), "label", "left_semi")


def border_flags(labelled: DataFrame, tile: str = "tile_number") -> DataFrame:
    """(tile, label, edge_loc): 0 only at the bottom row, 1 only at the top, 2 both, null inside.

    The bottom is azimuth 0, the top the last azimuth of the tile.
    """
    top = labelled.groupBy(tile).agg(F.max("azimuth_index").alias("__top"))
    flags = labelled.join(top, tile).groupBy(tile, "label").agg(F.max((F.col("azimuth_index") == 0).cast("int")).alias("b"), F.max((F.col("azimuth_index") == F.col("__top")).cast("int")).alias("t"))
    loc = F.when((F.col("b") == 1) & (F.col("t") == 1), 2).when(F.col("t") == 1, 1).when(F.col("b") == 1, 0)
    return flags.select(tile, "label", loc.alias("edge_loc"))


def edge_pixels(labelled: DataFrame, tile: str = "tile_number") -> DataFrame:
    """Pixels of labels that touch a tile's first or last row, with ``edge_loc``."""
    return labelled.join(border_flags(labelled, tile).where("edge_loc is not null"), [tile, "label"])


def missing_tiles(tiles: DataFrame, keys: list[str], tile: str = "tile_number") -> DataFrame:
    """(keys, tile) between the first and last tile of each group that are not there."""
    span = tiles.groupBy(*keys).agg(F.sequence(F.min(tile), F.max(tile)).alias("s")).select(*keys, F.explode("s").alias(tile))
    return span.join(tiles.select(*keys, tile).distinct(), [*keys, tile], "left_anti")


def tile_layout(meta: DataFrame, keys: list[str], tile: str = "tile_number") -> DataFrame:
    """(keys, tile, azimuth_offset, range_offset, starts, ends) of the tiles along a pass.

    ``meta`` has near_range, nominal_slant_range_spacing and interferogram_size_azimuth. Missing tiles take
    the group's largest azimuth size; the range offset adds up rint of the near-range differences. starts and ends
    mark tiles without a neighbour before or after.
    """
    order = Window.partitionBy(*keys).orderBy(tile)
    largest = F.max("interferogram_size_azimuth").over(Window.partitionBy(*keys))
    before = F.lag(tile).over(order)
    gap = F.coalesce(F.col(tile) - before - 1, F.lit(0))
    own = meta.withColumns({"size": largest, "gap": gap, "starts": before.isNull() | (gap > 0), "ends": F.coalesce(F.lead(tile).over(order) - F.col(tile) > 1, F.lit(True))})
    step = F.coalesce(F.lag("interferogram_size_azimuth").over(order), F.lit(0)) + F.col("gap") * F.col("size")
    shift = F.coalesce(F.rint((F.col("near_range") - F.lag("near_range").over(order)) / F.col("nominal_slant_range_spacing")), F.lit(0.0)).cast("long")
    own = own.withColumns({"step": step, "shift": shift})
    so_far = order.rowsBetween(Window.unboundedPreceding, 0)
    return own.select(*keys, tile, F.sum("step").over(so_far).alias("azimuth_offset"), F.sum("shift").over(so_far).alias("range_offset"), "starts", "ends")


def merge_tiles(labelled: DataFrame, layout: DataFrame, keys: list[str], tile: str = "tile_number") -> DataFrame:
    """(tile, label, merged): labels that touch across consecutive tiles of a pass become one.

    The last row of a tile is its largest azimuth present, the next tile's first row is azimuth 0; ranges are
    compared after the layout's shift. ``merged`` is the smallest label.
    """
    top = labelled.groupBy(*keys, tile).agg(F.max("azimuth_index").alias("__top"))
    placed = labelled.join(layout.select(*keys, tile, "range_offset"), [*keys, tile]).withColumn("r", F.col("range_index") + F.col("range_offset"))
    last = placed.join(top, [*keys, tile]).where(F.col("azimuth_index") == F.col("__top")).select(*keys, (F.col(tile) + 1).alias(tile), "r", F.col("label").alias("a"))
    first = placed.where("azimuth_index = 0").select(*keys, tile, "r", F.col("label").alias("b"))
    root = connected_components(last.join(first, [*keys, tile, "r"]).select("a", "b").distinct())
    names = labelled.select(tile, "label").distinct()
    return names.join(root, names.label == root.node, "left").select(tile, "label", F.coalesce("root", "label").alias("merged"))


def number_by_size(labelled: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, label, number): labels numbered from 1 by decreasing pixel count, smaller label first."""
    n = labelled.groupBy(*keys, "label").agg(F.count(F.lit(1)).alias("n"))
    return n.select(*keys, "label", F.dense_rank().over(Window.partitionBy(*keys).orderBy(F.desc("n"), "label")).alias("number"))


def height_gaps(labelled: DataFrame, keys: list[str], threshold: float = 1.5 / 2**0.5) -> DataFrame:
    """Single-linkage classes of height: ``cluster`` counts the gaps over the threshold below a pixel.

    Equal heights are one; the distinct heights of an object are few against its pixels.
    """
    order = Window.partitionBy(*keys).orderBy("height")
    levels = labelled.where(F.col("height").isNotNull() & ~F.isnan("height")).select(*keys, "height").distinct()
    gap = F.coalesce((F.col("height") - F.lag("height").over(order) > threshold).cast("int"), F.lit(0))
    classes = levels.withColumn("g", gap).withColumn("cluster", F.sum("g").over(order.rowsBetween(Window.unboundedPreceding, 0))).drop("g")
    return labelled.join(classes, [*keys, "height"])


def otsu_split(labelled: DataFrame, keys: list[str], min_size: float, bins: int = 256) -> DataFrame:
    """``labelled`` with ``part`` 0 or 1: the side of each object's Otsu threshold, 0 where it stays whole.

    An object is split if it has twice ``min_size``, five pixels or more and only finite heights, and if both parts have
    the size and more than five pixels and the threshold lies outside two deviations of either part's mean.
    """
    h = F.col("height")
    base = labelled.groupBy(*keys).agg(F.min("height").alias("h0"), F.max("height").alias("h1"), F.count(F.lit(1)).alias("k"), F.avg("pixel_area").alias("pa"), F.max((h.isNull() | F.isnan("height")).cast("int")).alias("odd"))
    base = base.where((F.col("odd") == 0) & (F.col("k") >= 5) & (F.col("k") * F.col("pa") >= 2 * min_size) & (F.col("h1") > F.col("h0"))).drop("odd", "k")
    step = (F.col("h1") - F.col("h0")) / bins
    own = labelled.join(base, keys).withColumn("bin", F.least(F.floor((h - F.col("h0")) / step), F.lit(bins - 1)))
    hist = own.groupBy(*keys, "bin").agg(F.count(F.lit(1)).alias("c"), F.max(F.col("h0") + (F.col("bin") + 0.5) * step).alias("x"))
    up = Window.partitionBy(*keys).orderBy("bin")
    so_far, whole = up.rowsBetween(Window.unboundedPreceding, 0), Window.partitionBy(*keys)
    cum = hist.withColumns({"w1": F.sum("c").over(so_far), "s1": F.sum(F.col("c") * F.col("x")).over(so_far), "w": F.sum("c").over(whole), "s": F.sum(F.col("c") * F.col("x")).over(whole)})
    w2 = F.col("w") - F.col("w1")
    between = F.round(F.col("w1") * w2 * (F.col("s1") / F.col("w1") - (F.col("s") - F.col("s1")) / w2) ** 2, 6)
    best = cum.where(w2 > 0).withColumn("v", between).groupBy(*keys).agg(F.max_by("x", F.struct("v", -F.col("bin"))).alias("threshold"))
    sided = labelled.join(best, keys).withColumn("side", (h > F.col("threshold")).cast("int"))
    parts = sided.join(base.select(*keys, "pa"), keys).groupBy(*keys, "side").agg(F.count(F.lit(1)).alias("n"), F.avg("height").alias("m"), F.stddev_pop("height").alias("sd"), F.max("threshold").alias("t"), F.max("pa").alias("pa"))
    good = (F.col("n") * F.col("pa") >= min_size) & (F.col("n") > 5) & (F.abs(F.col("t") - F.col("m")) > 2 * F.col("sd"))
    split = parts.groupBy(*keys).agg(F.min(good.cast("int")).alias("ok"), F.count(F.lit(1)).alias("sides")).where("ok = 1 and sides = 2").select(*keys)
    cut = split.join(best, keys)
    return labelled.join(cut, keys, "left").withColumn("part", F.coalesce((h > F.col("threshold")).cast("int"), F.lit(0))).drop("threshold")


def absorb_small(labelled: DataFrame, keys: list[str], least: int) -> DataFrame:
    """``labelled`` with ``label`` of small regions replaced by their 4-neighbours' most frequent large label.

    A group without a region of ``least`` pixels becomes one label; small regions that touch no large one keep theirs.
    """
    size = labelled.groupBy(*keys, "label").agg(F.count(F.lit(1)).alias("n"))
    large = size.where(F.col("n") >= least).select(*keys, "label")
    none = size.groupBy(*keys).agg(F.max("n").alias("n"), F.min("label").alias("one")).where(F.col("n") < least).select(*keys, "one")
    small = labelled.join(large, [*keys, "label"], "left_anti").select(*keys, "label", "azimuth_index", "range_index")
    moves = F.array(*(F.struct(F.lit(a).alias("a"), F.lit(r).alias("r")) for a, r in ((0, 1), (0, -1), (1, 0), (-1, 0))))
    around = small.withColumn("d", F.explode(moves)).select(*keys, "label", (F.col("azimuth_index") + F.col("d.a")).alias("azimuth_index"), (F.col("range_index") + F.col("d.r")).alias("range_index"))
    other = labelled.join(large, [*keys, "label"], "left_semi").select(*keys, "azimuth_index", "range_index", F.col("label").alias("near"))
    votes = around.join(other, [*keys, "azimuth_index", "range_index"]).groupBy(*keys, "label", "near").agg(F.count(F.lit(1)).alias("n"))
    choice = votes.groupBy(*keys, "label").agg(F.max_by("near", F.struct("n", -F.col("near"))).alias("near"))
    out = labelled.join(choice, [*keys, "label"], "left").join(none, keys, "left")
    return out.withColumn("label", F.coalesce("one", "near", "label")).drop("near", "one")


#: Distinct heights up to which an object's are fitted as one list.
LISTED = 4096


def _clusters(h, n, most: int, spread: float):
    """The cluster of each of an object's sorted heights ``h`` of counts ``n``, by the rules of :func:`height_kmeans`."""
    import numpy as np

    weight, upto = h * n, np.cumsum(n)
    for k in range(1, most + 1):
        place = (np.arange(k) + 0.5) / k * (upto[-1] - 1)
        low, high = (h[np.searchsorted(upto, f(place), side="right")] for f in (np.floor, np.ceil))
        centres, seen = low + (high - low) * (place - np.floor(place)), set()
        while True:
            first = np.searchsorted(h, (centres[1:] + centres[:-1]) / 2 + 1e-9, side="right")
            first = np.unique(np.concatenate([[0], first[first < len(h)]]))
            sizes = np.add.reduceat(n, first)
            if (name := tuple(sizes.tolist())) in seen:
                break
            seen.add(name)
            centres = np.add.reduceat(weight, first) / sizes
        cluster = np.repeat(np.arange(len(first)), np.diff([*first, len(h)]))
        mean = np.add.reduceat(weight, first) / sizes
        if np.sqrt(np.add.reduceat((h - mean[cluster]) ** 2 * n, first) / sizes).max() <= spread:
            break
    return cluster


def height_kmeans(labelled: DataFrame, keys: list[str], most: int = 11, spread: float = 1.0, listed: int = LISTED) -> DataFrame:
    """``labelled`` with ``cluster``: 1-D k-means of each object's heights, with the least k whose clusters all deviate by at most ``spread``.

    Centres start at even quantiles and move until no height changes its cluster; a height between two centres, to a billionth,
    goes to the lower one, and clusters that stand empty go. Objects that no k up to ``most``, the reference's bound, fits take ``most``.
    Objects of up to ``listed`` distinct heights are fitted each from the list of these and their counts; those of more take rounds in which no
    task holds an object's heights.
    """
    import numpy as np
    import pandas as pd

    own = labelled.where(F.col("height").isNotNull() & ~F.isnan("height")).withColumn("height", F.col("height").cast("double"))
    levels = scratch.save(own.groupBy(*keys, "height").agg(F.count(F.lit(1)).alias("n")), "levels")
    many = scratch.save(levels.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > listed).select(*keys), "many-levels")
    some = not many.isEmpty()
    few = levels.join(many.hint("merge"), keys, "left_anti") if some else levels

    def fit(heights, counts):
        return pd.Series([_clusters(np.asarray(h, float), np.asarray(n, np.int64), most, spread).tolist() for h, n in zip(heights, counts)])

    part = lambda c: F.transform("l", lambda x: x[c]).alias(c)
    lists = few.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("height", "n"))).alias("l")).select(*keys, part("height"), part("n"))
    fitted = lists.select(*keys, "height", F.pandas_udf(fit, "array<int>")("height", "n").alias("cluster"))
    named = fitted.select(*keys, F.explode(F.arrays_zip("height", "cluster")).alias("x")).select(*keys, F.col("x.height").alias("__h"), "x.cluster")
    out = labelled.withColumn("__h", F.col("height").cast("double")).join(scratch.save(named, "clusters").hint("merge"), [*keys, "__h"]).drop("__h")
    return out.unionByName(_kmeans_in_rounds(labelled.join(many.hint("merge"), keys, "left_semi"), keys, most, spread)) if some else out


def _kmeans_in_rounds(labelled: DataFrame, keys: list[str], most: int, spread: float) -> DataFrame:
    """:func:`height_kmeans` of objects of very many heights.

    All objects and all k take their rounds together: a round deals the distinct heights with their counts to the centres, a small list
    per object and k, and sums them up; the list is what is written. No task holds an object's heights.
    """
    from mereflow.operators.aggregates import percentiles

    own = labelled.where(F.col("height").isNotNull() & ~F.isnan("height")).withColumn("height", F.col("height").cast("double"))
    levels = scratch.save(own.groupBy(*keys, "height").agg(F.count(F.lit(1)).alias("n")), "levels")
    places = {f"q{k}_{i}": ("height", (i + 0.5) / k) for k in range(1, most + 1) for i in range(k)}
    starts = F.array(*(F.struct(F.lit(k).alias("k"), F.array(*(F.col(f"q{k}_{i}") for i in range(k))).alias("centres")) for k in range(1, most + 1)))
    state = percentiles(own, keys, places).select(*keys, F.explode(starts).alias("s")).select(*keys, "s.k", "s.centres", F.array().cast("array<string>").alias("seen"), F.lit(False).alias("done"))
    state = scratch.save(state, "centres")
    middle = F.transform(F.sequence(F.lit(0), F.size("centres") - 2), lambda i: (F.get("centres", i + 1) + F.get("centres", i)) / 2 + 1e-9)
    cuts = F.when(F.size("centres") > 1, middle).otherwise(F.array().cast("array<double>"))
    dealt = lambda of: levels.join(of.withColumn("cuts", cuts), keys).withColumn("cluster", F.size(F.filter("cuts", lambda c: c < F.col("height"))))
    while not state.where("not done").isEmpty():
        live = state.where("not done").select(*keys, "k", "centres")
        sums = dealt(live).groupBy(*keys, "k", "cluster").agg(F.sum("n").alias("n"), F.sum(F.col("height") * F.col("n")).alias("s"))
        lists = sums.groupBy(*keys, "k").agg(F.sort_array(F.collect_list(F.struct("cluster", "n", "s"))).alias("g"))
        moved = lists.select(*keys, "k", F.transform("g", lambda x: x["s"] / x["n"]).alias("now"), F.array_join(F.transform("g", lambda x: x["n"]), ",").alias("sizes"))
        # clusters are stretches of the sorted heights, so equal sizes are equal clusters
        still = F.col("done") | F.array_contains("seen", F.col("sizes"))
        nxt = state.join(moved, [*keys, "k"], "left").withColumn("still", still)
        nxt = nxt.select(*keys, "k", F.when(F.col("still"), F.col("centres")).otherwise(F.col("now")).alias("centres"), F.when(F.col("still"), F.col("seen")).otherwise(F.array_append("seen", F.col("sizes"))).alias("seen"), F.col("still").alias("done"))
        nxt = scratch.save(nxt, "centres")
        scratch.drop(state)
        state = nxt
    last = dealt(state.select(*keys, "k", "centres"))
    mean = last.groupBy(*keys, "k", "cluster").agg((F.sum(F.col("height") * F.col("n")) / F.sum("n")).alias("m"))
    off = last.join(mean, [*keys, "k", "cluster"]).groupBy(*keys, "k", "cluster").agg(F.sqrt(F.sum((F.col("height") - F.col("m")) ** 2 * F.col("n")) / F.sum("n")).alias("d"))
    fits = off.groupBy(*keys, "k").agg((F.max("d") <= spread).alias("fits"))
    chosen = fits.groupBy(*keys).agg(F.coalesce(F.min(F.when(F.col("fits"), F.col("k"))), F.lit(most)).alias("k"))
    state = state.join(chosen, [*keys, "k"])
    named = dealt(state.select(*keys, "centres")).select(*keys, "height", "cluster")
    order = Window.partitionBy(*keys).orderBy("cluster")
    packed = named.select(*keys, "cluster").distinct().withColumn("__p", (F.row_number().over(order) - 1).cast("int"))
    named = named.join(packed, [*keys, "cluster"]).select(*keys, F.col("height").alias("__h"), F.col("__p").alias("cluster"))
    return labelled.withColumn("__h", F.col("height").cast("double")).join(named, [*keys, "__h"]).drop("__h")
