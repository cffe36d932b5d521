"""Spatially clustered tables: rows in Z-order with box columns, so that a box reaches the scan as a filter on statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mereflow.operators.geometry import boxes

#: Box columns of a clustered table.
BOX = ("box_x0", "box_x1", "box_y0", "box_y1")


def z_order(x: Column, y: Column, extent: tuple[float, float, float, float], bits: int = 20) -> Column:
    """Interleaved bits of a place's column and row in the extent (x0, x1, y0, y1); places outside count as its border."""
    x0, x1, y0, y1 = extent

    def spread(v: Column, a: float, b: float) -> Column:
        n = F.greatest(F.lit(0), F.least(F.lit((1 << bits) - 1), F.floor((v - a) / max(b - a, 1e-300) * (1 << bits)))).cast("long")
        for shift, mask in ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F), (2, 0x3333333333333333), (1, 0x5555555555555555)):
            n = n.bitwiseOR(F.shiftleft(n, shift)).bitwiseAND(F.lit(mask))
        return n

    return spread(x, x0, x1).bitwiseOR(F.shiftleft(spread(y, y0, y1), 1))


def write_clustered(polygons: DataFrame, path: str, key: str, extent: tuple[float, float, float, float] = (-180.0, 180.0, -90.0, 90.0), files: int | None = None, group_bytes: int = 32 << 20, rows_a_page: int = 2_000) -> None:
    """``polygons`` (key, rings, ...) as Parquet in the Z-order of their boxes' centres, with a box column each for the statistics.

    Range-partitioned and sorted, so a file, a row group and a page each hold what lies together. Rows without rings come first
    and match no area.
    """
    own = polygons.join(boxes(polygons, key).withColumnsRenamed(dict(zip(("x0", "x1", "y0", "y1"), BOX))), key)
    z = z_order((F.col(BOX[0]) + F.col(BOX[1])) / 2, (F.col(BOX[2]) + F.col(BOX[3])) / 2, extent)
    own = own.withColumn("__z", z)
    dealt = own.repartitionByRange(files, "__z", key) if files else own.repartitionByRange("__z", key)
    options = {"parquet.block.size": str(group_bytes), "parquet.page.row.count.limit": str(rows_a_page), "parquet.block.size.row.check.min": "10", "parquet.page.size.row.check.min": "10"}
    dealt.sortWithinPartitions("__z", key).drop("__z").write.options(**options).parquet(path)


def _cross(ax: Column, ay: Column, bx: Column, by: Column, px: Column, py: Column) -> Column:
    return (bx - ax) * (py - ay) - (by - ay) * (px - ax)


def _within(rings: Column, x: Column, y: Column) -> Column:
    """Whether a place lies inside rings, holes left out, by the parity of the edges to its right."""

    def crossed(ring: Column) -> Column:
        at = F.sequence(F.lit(0), F.size(ring) - 2)

        def hit(i: Column) -> Column:
            p, q = F.get(ring, i), F.get(ring, i + 1)
            spans = (p["y"] > y) != (q["y"] > y)
            return spans & (x < F.try_divide((q["x"] - p["x"]) * (y - p["y"]), q["y"] - p["y"]) + p["x"])

        return F.when(F.size(ring) > 1, F.size(F.filter(at, hit))).otherwise(0)

    return F.aggregate(F.transform(rings, crossed), F.lit(0), lambda a, n: a + n) % 2 == 1


def meets(rings: Column, area: list[tuple[float, float]]) -> Column:
    """Whether a polygon has a point in common with an area, a ring of few corners, borders included: edges that cross, or one inside the other."""
    corners = [*area, area[0]] if area[0] != area[-1] else area
    sides = F.array(*(F.struct(F.lit(float(a)).alias("ax"), F.lit(float(b)).alias("ay"), F.lit(float(c)).alias("bx"), F.lit(float(d)).alias("by")) for (a, b), (c, d) in zip(corners, corners[1:])))

    def touches(p: Column, q: Column, s: Column) -> Column:
        one = _cross(p["x"], p["y"], q["x"], q["y"], s["ax"], s["ay"]) * _cross(p["x"], p["y"], q["x"], q["y"], s["bx"], s["by"]) <= 0
        two = _cross(s["ax"], s["ay"], s["bx"], s["by"], p["x"], p["y"]) * _cross(s["ax"], s["ay"], s["bx"], s["by"], q["x"], q["y"]) <= 0
        span = lambda a, b, c, d: (F.greatest(a, b) >= F.least(c, d)) & (F.greatest(c, d) >= F.least(a, b))
        return one & two & span(p["x"], q["x"], s["ax"], s["bx"]) & span(p["y"], q["y"], s["ay"], s["by"])

    edge = lambda r: F.exists(F.sequence(F.lit(0), F.size(r) - 2), lambda i: F.exists(sides, lambda s: touches(F.get(r, i), F.get(r, i + 1), s)))
    crossing = F.exists(rings, lambda r: F.when(F.size(r) > 1, edge(r)).otherwise(F.lit(False)))
    whole = F.array(F.array(*(F.struct(F.lit(float(a)).alias("x"), F.lit(float(b)).alias("y")) for a, b in corners)))
    first = F.get(F.get(rings, F.lit(0)), F.lit(0))
    return crossing | _within(whole, first["x"], first["y"]) | _within(rings, F.lit(float(corners[0][0])), F.lit(float(corners[0][1])))


def scan_area(spark: SparkSession, path: str, area: list[tuple[float, float]], columns: list[str] | None = None, prefix: tuple[str, str] | None = None) -> DataFrame:
    """Rows of a clustered table whose polygon meets the area, a ring of few corners.

    The area's box becomes filters on the box columns, which skip files, row groups and pages by their statistics; what is left
    is tested exactly. ``prefix`` adds (column, beginning) to the filters.
    """
    xs, ys = [float(p[0]) for p in area], [float(p[1]) for p in area]
    own = spark.read.parquet(path)
    x0, x1, y0, y1 = (F.col(c) for c in BOX)
    own = own.where((x0 <= max(xs)) & (x1 >= min(xs)) & (y0 <= max(ys)) & (y1 >= min(ys)))
    if prefix:
        own = own.where(F.col(prefix[0]).startswith(prefix[1]))
    own = own.where(meets(F.col("rings"), area)).drop(*BOX)
    return own.select(*columns) if columns else own
