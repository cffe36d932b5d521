"""Hand-made cases with known answers."""

import math

import pytest
from pyspark.sql import functions as F

from mereflow.functions import scalars as S
from mereflow.operators import aggregates as A
from mereflow.operators import cycle as C
from mereflow.operators import labels as L
from mereflow.operators import select as P
from mereflow.operators.components import connected_components


def pixels(spark, cells, tile=1):
    return spark.createDataFrame([(tile, a, r) for a, r in cells], "tile_number long, azimuth_index int, range_index int")


def test_components_of_chains(spark):
    e = spark.createDataFrame([(1, 10), (1, 11), (2, 11), (2, 12), (3, 13), (4, 13), (5, 5), (None, 7), (1, 10)], "a long, b long")
    got = {r.node: r.root for r in connected_components(e).collect()}
    assert got == {1: 1, 10: 1, 11: 1, 2: 1, 12: 1, 3: 3, 13: 3, 4: 3, 5: 5}
    assert connected_components(e.limit(0)).count() == 0
    path = spark.range(300).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    assert {r.root for r in connected_components(path).collect()} == {0}


def test_corner_touch(spark):
    cells = [(a, r) for a in (0, 1) for r in (0, 1)] + [(a, r) for a in (2, 3) for r in (2, 3)]
    p = pixels(spark, cells)
    assert L.lake_labels(p).select("label").distinct().count() == 2
    assert L.lake_labels(p, diagonal=True).select("label").distinct().count() == 1


def test_tile_cut(spark):
    whole = [(a, r) for a in range(6) for r in range(4)]
    one = pixels(spark, [(a, r + 5) for a, r in whole if a < 3], 1)
    two = pixels(spark, [(a - 3, r + 3) for a, r in whole if a >= 3], 2)
    own = L.lake_labels(one.union(two)).withColumn("pass_number", F.lit(1))
    meta = spark.createDataFrame([(1, 1, 100.0, 1.0, 3), (1, 2, 102.0, 1.0, 3)], "pass_number int, tile_number long, near_range double, nominal_slant_range_spacing double, interferogram_size_azimuth int")
    merged = L.merge_tiles(own, L.tile_layout(meta, ["pass_number"]), ["pass_number"])
    assert merged.select("merged").distinct().count() == 1 and merged.count() == 2


def test_two_levels_split(spark):
    rows = [(1, 0, i, (10.0 if i % 2 else 20.0) + (0.1 if (i // 2) % 10 == 0 else 0.0), 10.0) for i in range(100)]
    df = spark.createDataFrame(rows, "label int, azimuth_index int, range_index int, height double, pixel_area double")
    assert {r.part for r in L.otsu_split(df, ["label"], 100.0).select("part").distinct().collect()} == {0, 1}
    assert L.height_gaps(df, ["label"]).select("cluster").distinct().count() == 2
    flat = df.where("height < 15")
    assert {r.part for r in L.otsu_split(flat, ["label"], 100.0).select("part").distinct().collect()} == {0}


def test_storage(spark):
    cols = "lake_id string, wse double, wse_u double, area double, area_u double, ref_wse double, ref_wse_u double, ref_area double, ref_area_u double, ds_t0 double, partial_f int, overlap double"
    df = spark.createDataFrame([("a", 11.0, 0.1, 3.0, 0.1, 10.0, None, 3.0, None, None, 0, None), ("b", 10.0, 0.1, 3.0, 0.1, 10.0, None, 3.0, None, None, 0, None), ("c", 10.0, 0.1, 3.0, 0.1, None, None, 3.0, None, None, 0, None)], cols)
    got = {r.lake_id: r for r in C.storage_change(df, ["lake_id"]).collect()}
    assert set(got) == {"a", "b"}
    assert got["a"].ds_l == pytest.approx(0.003) and got["a"].ds_q == pytest.approx(0.003)
    assert got["b"].ds_l == 0 and got["b"].ds_q == 0


def test_cycle_extremes(spark):
    rows = [(1, "a", 1, 5.0), (1, "b", 1, 5.0), (1, "b", 2, 7.0), (1, "c", 1, 5.0), (1, "c", 2, 9.0), (1, "c", 3, 6.0)]
    df = spark.createDataFrame(rows, "cycle_number int, lake_id string, pass_number int, wse double")
    got = {r.lake_id: (r.wse_hmin, r.wse_hmed, r.wse_hmax) for r in C.extreme_rows(df, ["wse"]).collect()}
    assert got == {"a": (None, 5.0, None), "b": (5.0, None, 7.0), "c": (5.0, 6.0, 9.0)}


def test_fusion_bits_and_nan(spark):
    df = spark.createDataFrame([("a", 1.0, 10.0), ("a", 3.0, 20.0)], "lake_id string, area_total double, wse double")
    r = A.fuse_duplicates(df, ["lake_id"], ["wse"], [], [], {}).first()
    assert (r.area_total, r.wse) == (4.0, 17.5)
    q = spark.createDataFrame([(1, 64), (2, 1 << 23), (3, 64 | 1 << 23), (4, 0)], "id int, geolocation_qual long")
    assert [x.q for x in q.groupBy("id").agg(A.crossover_quality().alias("q")).orderBy("id").collect()] == [1, 2, 2, 0]
    h = spark.createDataFrame([(1.0, 1.0), (float("nan"), 1.0), (3.0, 1.0)], "h double, s double")
    assert h.agg(A.weighted(F.col("h"), F.col("s")).alias("m")).first().m == 2.0


def test_scalars(spark):
    one = spark.range(1)
    assert [one.select(S.lon_180(F.lit(x))).first()[0] for x in (179.9, 180.1)] == [179.9, pytest.approx(-179.9)]
    e, n = one.select(*S.to_utm(F.lit(3.0), F.lit(0.0), F.lit(31), F.lit(True))).first()
    assert (e, n) == (pytest.approx(500000.0, abs=1e-6), pytest.approx(0.0, abs=1e-6))
    lon, lat, h = one.select(*S.from_ecef(*S.to_ecef(F.lit(12.0), F.lit(-33.0), F.lit(250.0)))).first()
    assert (lon, lat, h) == (pytest.approx(12), pytest.approx(-33), pytest.approx(250, abs=1e-6))
    assert one.select(S.angle_between(*map(F.lit, (1.0, 0.0, 0.0, 0.0, 2.0, 0.0)))).first()[0] == pytest.approx(math.pi / 2)


def test_empty_and_missing(spark):
    empty = spark.createDataFrame([], "tile_number long, azimuth_index int, range_index int, cross_track double")
    assert L.lake_labels(empty).count() == 0 and P.remove_borders(empty, 1.0).count() == 0


def test_nearest_of_outliers_and_few_points(spark):
    """A dense cluster, points far out on either side of it, ties, nulls, and fewer points than asked for."""
    import math
    import random

    from mereflow.operators import neighbours as N

    rng = random.Random(5)
    right = [(i, rng.uniform(0, 3), rng.uniform(0, 3)) for i in range(150)] + [(200, 900.0, -700.0), (201, 900.0, -700.0), (202, -5000.25, 12.0), (203, None, 1.0)]
    left = [(1, 1.0, 1.0), (2, 50.0, 50.0), (3, -4000.0, 3000.0), (4, 910.0, -690.0), (5, 1e6, -1e6), (6, None, 2.0), (7, 2.9, 0.1)]
    l, r = spark.createDataFrame(left, "c int, x double, y double"), spark.createDataFrame(right, "id int, x double, y double")
    for k in (1, 3, 7):
        want = {(a, b) for a, x, y in left if x is not None for b in [p[0] for p in sorted((p for p in right if p[1] is not None), key=lambda p: (math.dist((x, y), p[1:]), p[0]))[:k]]}
        assert {(n.c, n.id_r) for n in N.nearest(l, r, k, "c", "id", 0.5).collect()} == want
    few = N.nearest(l, r.where("id in (0, 200)"), 5, "c", "id", 0.5).collect()
    assert {(n.c, n.id_r) for n in few} == {(a, b) for a, x, _ in left if x is not None for b in (0, 200)} and {n["rank"] for n in few} == {1, 2}
    assert N.nearest(l, r.limit(0), 5, "c", "id", 0.5).count() == 0
    assert N.grid(r.limit(0), 1.0).count() == 0


def test_components_of_paths_and_stars(spark):
    """Long paths, stars and struct nodes; every node's root is the smallest of its component."""
    from pyspark.sql import functions as F

    from mereflow.operators.components import connected_components

    edges = [(i, i + 1) for i in range(0, 60)] + [(500, i) for i in range(100, 140)] + [(900, 901), (903, 902), (902, 901), (700, 700), (None, 3), (5, None)]
    df = spark.createDataFrame(edges, "a int, b int")
    got = {r.node: r.root for r in connected_components(df).collect()}
    assert got == {i: 0 for i in range(61)} | {i: 100 for i in (*range(100, 140), 500)} | {i: 900 for i in range(900, 904)} | {700: 700}
    pairs = df.where("a is not null and b is not null").select(*(F.struct((-F.col(c)).alias("n"), F.col(c).alias("i")).alias(c) for c in "ab"))
    got = {r.node.i: r.root.i for r in connected_components(pairs).collect()}
    assert got == {i: 60 for i in range(61)} | {i: 500 for i in (*range(100, 140), 500)} | {i: 903 for i in range(900, 904)} | {700: 700}


def test_scratch_folder(spark, tmp_path):
    """The cluster's setting first, then the context's checkpoint folder; tables are deleted on request."""
    import os

    from mereflow import scratch

    named = spark.conf.get("spark.checkpoint.dir")
    assert scratch.folder(spark) == named.rstrip("/")
    kept = scratch.save(spark.range(3), "three")
    path = kept._scratch_path.removeprefix("file://")
    assert kept.count() == 3 and os.path.isdir(path)
    scratch.drop(kept)
    assert not os.path.exists(path)


def test_union_and_extent_of_regions(spark):
    """Areas of overlapping boxes, a triangle among them; and cells between the widest and the smallest regions."""
    from mereflow.operators import geometry as G

    ring = lambda *p: [[{"x": float(x), "y": float(y)} for x, y in (*p, p[0])]]
    rows = [("a", 1, ring((0, 0), (4, 0), (4, 4), (0, 4))), ("a", 2, ring((2, 2), (6, 2), (6, 6), (2, 6))), ("a", 3, ring((0, 0), (4, 0), (4, 4), (0, 4))), ("b", 1, ring((0, 0), (4, 0), (0, 4))), ("b", 2, ring((0, 0), (4, 0), (4, 4)))]
    shapes = spark.createDataFrame(rows, "g string, part int, rings array<array<struct<x: double, y: double>>>")
    got = {r.g: round(r.area, 9) for r in G.union_areas(shapes, ["g"], "part").collect()}
    assert got == {"a": 28.0, "b": 12.0}
    cells = spark.createDataFrame([("small", i, j) for i in range(3) for j in range(3)] + [("large", i, j) for i in range(6) for j in range(6)], "id string, ix long, iy long")
    between = {(r.ix, r.iy) for r in G.extent_between(cells, 1).collect()}
    assert between == {(i, j) for i in range(-1, 7) for j in range(-1, 7)} - {(i, j) for i in range(3) for j in range(3)}
    wide = G.expand_water(cells.where("id = 'small'").selectExpr("id", "1.5D as height", "ix", "iy"), [(0, 1.0), (2, -0.5)]).collect()
    assert sorted((r.step, r.height) for r in wide) == [(0, 2.5)] * 9 + [(1, 1.0)] * 49
