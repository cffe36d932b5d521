"""Planar overlay of polygons' edges: crossings by a bucketed segment join, and slabs between all cuts.

An edge table has a row (keys, part, x1, y1, x2, y2) for each edge of a polygon ``part`` of the group ``keys``, from its lower to its
upper end; horizontal edges are left out. Rows of every step are in proportion to edges, crossings and the edges that cross a slab.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mereflow import scratch

_ENDS = ("x1", "y1", "x2", "y2")


def _at(y: Column) -> Column:
    """x of the row's edge at the height y."""
    return F.col("x1") + (y - F.col("y1")) / (F.col("y2") - F.col("y1")) * (F.col("x2") - F.col("x1"))


def crossings(e: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, y) where edges of different parts cross inside both.

    Edges are dealt to the cells that they run through, of a grid as wide as the group's mean edge is long, so that there are a few
    cells per edge and two edges are compared if they share one.
    """
    length = F.sqrt((F.col("x2") - F.col("x1")) ** 2 + (F.col("y2") - F.col("y1")) ** 2)
    size = e.groupBy(*keys).agg(F.greatest(F.avg(length), F.lit(1e-12)).alias("s"))
    own = scratch.save(e.withColumn("id", F.monotonically_increasing_id()).join(size.hint("merge"), keys), "crossing-edges")
    eps = F.col("s") * 1e-6
    rows = own.withColumn("by", F.explode(F.sequence(F.floor((F.col("y1") - eps) / F.col("s")), F.floor((F.col("y2") + eps) / F.col("s")))))
    lo, hi = F.greatest(F.col("y1"), F.col("by") * F.col("s") - eps), F.least(F.col("y2"), (F.col("by") + 1) * F.col("s") + eps)
    a, b = _at(F.least(lo, hi)), _at(F.greatest(lo, hi))
    cells = rows.withColumn("bx", F.explode(F.sequence(F.floor((F.least(a, b) - eps) / F.col("s")), F.floor((F.greatest(a, b) + eps) / F.col("s"))))).drop("s")
    other = cells.select(*keys, "bx", "by", *(F.col(c).alias(f"{c}_") for c in ("part", "id", *_ENDS)))
    sx, sy, tx, ty = F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1"), F.col("x2_") - F.col("x1_"), F.col("y2_") - F.col("y1_")
    det = sx * ty - sy * tx
    dx, dy = F.col("x1_") - F.col("x1"), F.col("y1_") - F.col("y1")
    t, u = F.try_divide(dx * ty - dy * tx, det), F.try_divide(dx * sy - dy * sx, det)
    pairs = cells.join(other.hint("merge"), [*keys, "bx", "by"]).where((F.col("part") < F.col("part_")) & (F.greatest("y1", "y1_") < F.least("y2", "y2_")) & (det != 0))
    met = pairs.withColumns({"t": t, "u": u}).where("t > 0 and t < 1 and u >= -1e-9 and u <= 1 + 1e-9")
    return met.groupBy(*keys, "id", "id_").agg(F.first(F.col("y1") + F.col("t") * sy).alias("y")).select(*keys, "y")


def slabs(e: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, part, slab, lo, hi, xl, xh): every edge's stretch in each slab between two cuts, from (xl, lo) to (xh, hi).

    Cuts are all ends and crossings, so inside a slab edges of different parts keep their order. An edge's slabs are those
    between the numbers of its ends' cuts: no edge meets a slab that it does not run through.
    """
    cuts = e.select(*keys, F.col("y1").alias("y")).union(e.select(*keys, F.col("y2").alias("y"))).union(crossings(e, keys)).distinct()
    order = Window.partitionBy(*keys).orderBy("y")
    cuts = scratch.save(cuts.select(*keys, F.row_number().over(order).alias("slab"), F.col("y").alias("lo"), F.lead("y").over(order).alias("hi")), "cuts")
    # cuts compress to little, and are as many as the edges
    number = lambda end, name: cuts.select(*keys, F.col("lo").alias(end), F.col("slab").alias(name)).hint("merge")
    own = e.join(number("y1", "first"), [*keys, "y1"]).join(number("y2", "last"), [*keys, "y2"])
    own = own.withColumn("slab", F.explode(F.sequence("first", F.col("last") - 1))).drop("first", "last").join(cuts.hint("merge"), [*keys, "slab"])
    xl = F.when(F.col("lo") == F.col("y1"), F.col("x1")).otherwise(_at(F.col("lo")))
    xh = F.when(F.col("hi") == F.col("y2"), F.col("x2")).otherwise(_at(F.col("hi")))
    return own.select(*keys, "part", "slab", "lo", "hi", xl.alias("xl"), xh.alias("xh"))


def covered_area(spans: DataFrame, keys: list[str], least: int) -> DataFrame:
    """(keys, area) of what at least ``least`` of a group's parts cover: trapezoids between neighbouring edges of a slab."""
    middle = (F.col("xl") + F.col("xh")) / 2
    number = F.row_number().over(Window.partitionBy(*keys, "slab", "part").orderBy("x"))
    order = Window.partitionBy(*keys, "slab").orderBy("x", "part")
    turned = spans.withColumn("x", middle).withColumn("turn", F.when(number % 2 == 1, 1).otherwise(-1))
    inside = F.sum("turn").over(order.rowsBetween(Window.unboundedPreceding, 0)) >= least
    width = F.when(inside, (F.lead("x").over(order) - F.col("x")) * (F.col("hi") - F.col("lo"))).otherwise(0.0)
    return turned.withColumn("w", width).groupBy(*keys).agg(F.sum("w").alias("area"))


def outline(spans: DataFrame, keys: list[str], least: int = 1) -> DataFrame:
    """(keys, x1, y1, x2, y2): the directed pieces around what at least ``least`` parts cover, covered on their left.

    In a slab a piece is an edge's stretch that has the covered side on one hand only; stretches that lie on one another count
    together. Between two slabs it is where one is covered and the other is not, so that pieces always close to rings.
    """
    number = F.row_number().over(Window.partitionBy(*keys, "slab", "part").orderBy(F.col("xl") + F.col("xh")))
    turned = spans.withColumn("turn", F.when(number % 2 == 1, 1).otherwise(-1))
    turned = turned.groupBy(*keys, "slab", "lo", "hi", "xl", "xh").agg(F.sum("turn").alias("turn"))
    order = Window.partitionBy(*keys, "slab").orderBy(F.col("xl") + F.col("xh"), "xl").rowsBetween(Window.unboundedPreceding, 0)
    after = F.sum("turn").over(order)
    rim = turned.withColumn("after", after).withColumn("step", (F.col("after") >= least).cast("int") - (F.col("after") - F.col("turn") >= least).cast("int")).where("step <> 0")
    rim = scratch.save(rim.select(*keys, "lo", "hi", "xl", "xh", "step"), "rim-stretches")
    opens = F.col("step") == 1
    pick = lambda a, b: F.when(opens, F.col(a)).otherwise(F.col(b))
    steep = rim.select(*keys, pick("xh", "xl").alias("x1"), pick("hi", "lo").alias("y1"), pick("xl", "xh").alias("x2"), pick("lo", "hi").alias("y2"))
    below = rim.select(*keys, F.col("hi").alias("y"), F.col("xh").alias("x"), F.col("step").alias("b"), F.lit(0).alias("a"))
    above = rim.select(*keys, F.col("lo").alias("y"), F.col("xl").alias("x"), F.lit(0).alias("b"), F.col("step").alias("a"))
    met = below.unionByName(above).groupBy(*keys, "y", "x").agg(F.sum("b").alias("b"), F.sum("a").alias("a"))
    along = Window.partitionBy(*keys, "y").orderBy("x")
    so_far = along.rowsBetween(Window.unboundedPreceding, 0)
    level = met.select(*keys, "y", "x", F.lead("x").over(along).alias("to"), (F.sum("b").over(so_far) - F.sum("a").over(so_far)).alias("f")).where("f <> 0")
    # where rounding turns two ends around, a stretch may be gone over twice
    level = level.withColumn("times", F.explode(F.sequence(F.lit(1), F.abs("f").cast("int"))))
    west = lambda a, b: F.when(F.col("f") > 0, F.col(a)).otherwise(F.col(b))
    flat = level.select(*keys, west("to", "x").alias("x1"), F.col("y").alias("y1"), west("x", "to").alias("x2"), F.col("y").alias("y2"))
    return steep.unionByName(flat)
