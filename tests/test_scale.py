"""Operators that must not hold a group in one task, and writers that must not compute twice: against plain Python, and by their plans."""

import math
import random
import statistics

import numpy as np
import pytest
from conftest import SF_DIR
from pyspark.sql import functions as F

from mereflow import scratch
from mereflow.operators import aggregates as A
from mereflow.operators import geoloc as O
from mereflow.operators import geometry as G
from mereflow.operators import neighbours as N
from mereflow.operators import products as R
from mereflow.operators import spatial as Z
from mereflow.plans import product_queries


def test_percentiles(spark):
    """Small groups, ties, infinities, nulls, NaN, and groups of many distinct values, of which little is collected."""
    rng = random.Random(1)
    groups = {i: [rng.gauss(0, 10) for _ in range(rng.randrange(1, 40))] for i in range(60)}
    groups |= {100: [5.0] * 70_000, 101: [float(i * 7919 % 200_003) for i in range(200_003)], 102: [1.0] * 60_000 + [2.0] * 60_000, 103: [float(i % 3) for i in range(90_000)], 104: [1.0, 2.0], 105: [-math.inf, 1.0, math.inf]}
    wanted = {f"p{int(q * 1000)}": ("v", q) for q in (0.0, 0.05, 0.5, 0.9, 0.9995, 1.0)}
    rows = [(g, v) for g, values in groups.items() for v in values] + [(104, None), (104, float("nan")), (106, None)]
    import pandas as pd

    df = spark.createDataFrame(pd.DataFrame(rows, columns=["g", "v"]).astype({"v": "float64"})).withColumn("v", F.when(~F.isnan("v"), F.col("v"))).repartition(5)
    got = {r.g: r.asDict() for r in A.percentiles(df, ["g"], wanted).collect()}
    assert set(got) == {*groups, 106} and all(got[106][k] is None for k in wanted)
    for g, values in groups.items():
        own = np.sort(values)
        for k, (_, q) in wanted.items():
            place = (len(own) - 1) * q
            low, high, part = own[math.floor(place)], own[math.ceil(place)], place - math.floor(place)
            want = low if part == 0 else (1 - part) * low + part * high
            assert got[g][k] == want or got[g][k] == pytest.approx(want, rel=1e-12), (g, k)
    assert got[101]["p500"] == statistics.median(groups[101])
    assert A.percentiles(df.limit(0), ["g"], wanted).count() == 0


def test_median_of_ten_million_values(spark):
    """A task keeps a few thousandths of the group."""
    n = 10_000_001
    df = spark.range(n).select(F.lit(1).alias("g"), (F.col("id") * 7_919_777 % n).cast("double").alias("v"))
    assert A.percentiles(df, ["g"], {"m": ("v", 0.5)}).first().m == (n - 1) / 2


def test_modes(spark):
    df = spark.createDataFrame([(1, "b", 2), (1, "b", 1), (1, "a", 2), (1, "a", 1), (2, None, None), (3, "x", None)], "g int, a string, b int")
    assert sorted(tuple(r) for r in A.modes(df, ["g"], ["a", "b"]).collect()) == [(1, "a", 1), (2, None, None), (3, "x", None)]


def test_height_models(spark):
    """A deviation of zero has no weight, an unknown lake has null, and each model is that of its lakes."""
    rows = [(1, i, j, float(i), float(j), 5.0 + (i + j) % 2, 0.5 if i else 0.0, 10.0) for i in range(6) for j in range(6)] + [(2, 0, 0, 0.0, 0.0, 3.0, 0.0, 1.0), (2, 1, 0, 1.0, 0.0, 4.0, 2.0, 1.0), (3, 0, 0, 0.0, 0.0, float("nan"), 1.0, 1.0), (4, 0, 0, 0.0, 0.0, 7.0, None, None)]
    df = spark.createDataFrame(rows, "lake int, range_index int, azimuth_index int, x double, y double, height double, height_std double, pixel_area double")
    for model in ("mean", "polynomial", "grid"):
        got = O.height_model(df, ["lake"], big=100.0, model=model, spacing=2.0, resolution=2.0).collect()
        assert len(got) == len(rows)
        small = {r.lake: r.height_target for r in got if r.lake > 1}
        assert small == {2: 4.0, 3: None, 4: None}
        if model == "mean":
            assert {r.height_target for r in got if r.lake == 1} == {5.5}
    # each pixel takes the height of the grid point that is nearest by its mean indices
    nodes = {}
    for a in range(-1, 2):
        for b in range(-1, 2):
            near = [r for r in rows if r[0] == 1 and max(abs(r[3] - 2.5 - 2 * a), abs(r[4] - 2.5 - 2 * b)) < 1]
            nodes[(sum(r[1] for r in near) / len(near), sum(r[2] for r in near) / len(near))] = sum(r[5] for r in near) / len(near)
    for r in got:
        if r.lake == 1:
            d = {n: (r.range_index - n[0]) ** 2 + (r.azimuth_index - n[1]) ** 2 for n in nodes}
            assert r.height_target == min((d[n], h) for n, h in nodes.items())[1]
    with pytest.raises(ValueError):
        O.height_model(df, ["lake"], model="other")


def test_isolated_components(spark):
    """A small component stays if another one is near, whatever that one's size."""
    at = {1: (0, 0), 2: (1, 0), 3: (2, 0), 10: (6, 0), 20: (50, 0), 21: (51, 0), 30: (80, 0), 31: (84, 0)}
    df = spark.createDataFrame([(i, float(x), float(y), 0.0) for i, (x, y) in at.items()], "id int, x double, y double, z double")
    kept = lambda **k: {r.id for r in N.small_components(df, 1.0, 3, **k).collect()}
    assert kept() == {1, 2, 3}
    assert kept(alone=4.0) == {1, 2, 3, 10, 30, 31} and kept(alone=3.9) == {1, 2, 3}


def test_placed_rings(spark):
    """A ring through the shore's pixels with an island's ring inside; thin objects have none."""
    drawn = ["AAAAA.B", "AAAAA.B", "AA.AA.B", "AAAAA.B", "AAAAA.B", ".......", "CC.DD..", "CC..DD."]
    cells = [(c, i, j, 100.0 + i + 0.1 * j, 40.0 + j if (c, i) != ("C", 0) or j != 6 else None) for j, row in enumerate(drawn) for i, c in enumerate(row) if c != "."]
    df = spark.createDataFrame(cells, "lake string, range_index int, azimuth_index int, longitude double, latitude double").repartition(3)
    points = G.placed_rings(df, ["lake"]).collect()
    rings = {}
    for r in sorted(points, key=lambda r: (r.lake, r.ring, r.position)):
        rings.setdefault((r.lake, r.ring), []).append((round(r.x - 100 - 0.1 * (r.y - 40)), round(r.y - 40)))
    by = {}
    for (lake, _), line in rings.items():
        by.setdefault(lake, []).append(line)
    assert set(by) == {"A", "C"} and [len(x) for x in by["C"]] == [3]
    outer, hole = sorted(by["A"], key=len, reverse=True)
    assert set(outer) == {(i, j) for i in range(5) for j in range(5) if i in (0, 4) or j in (0, 4)} and len(outer) == 16
    assert set(hole) == {(1, 2), (3, 2), (2, 1), (2, 3)}
    assert all(max(abs(a - c), abs(b - d)) == 1 for line in (outer, hole) for (a, b), (c, d) in zip(line, line[1:] + line[:1]))
    got = G.collect_rings(G.placed_rings(df, ["lake"]), ["lake"]).collect()
    assert {r.lake: [len(x) for x in r.rings] for r in got} == {"A": [17, 5], "C": [4]}


def test_clustered_table_skips_row_groups(spark):
    """The area's box is pushed to the scan, and most rows are skipped by the statistics of files and row groups."""
    n = 40_000
    at = spark.range(n).select(F.col("id").cast("string").alias("lake_id"), (F.col("id") * 7919 % 1000).cast("double").alias("x"), (F.col("id") * 104_729 % 997).cast("double").alias("y"))
    corner = lambda dx, dy: F.struct((F.col("x") + dx).alias("x"), (F.col("y") + dy).alias("y"))
    lakes = at.withColumn("rings", F.array(F.array(corner(0, 0), corner(1, 0), corner(1, 1), corner(0, 0))))
    path = scratch.new_path(spark, "clustered")
    Z.write_clustered(lakes, path, "lake_id", (0.0, 1001.0, 0.0, 998.0), files=4, group_bytes=64 << 10, rows_a_page=200)
    area = [(100.0, 100.0), (160.0, 100.0), (160.0, 150.0), (100.0, 150.0)]
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    got = Z.scan_area(spark, path, area, ["lake_id"])
    plan = got._jdf.queryExecution().toString()
    assert all(f"{op}({c}," in plan for op, c in (("LessThanOrEqual", "box_x0"), ("GreaterThanOrEqual", "box_x1"), ("LessThanOrEqual", "box_y0"), ("GreaterThanOrEqual", "box_y1")))
    rows = at.collect()
    want = {r.lake_id for r in rows if r.x <= 160 and r.x + 1 >= 100 and r.y <= 150 and r.y + 1 >= 100}
    # the triangle's upper left corner is empty
    want -= {r.lake_id for r in rows if r.lake_id in want and (min(160, r.x + 1) - r.x) < (max(100, r.y) - r.y)}
    assert {r.lake_id for r in got.collect()} == want and len(want) > 50
    import pyarrow.parquet as pq

    read = total = 0
    for file in spark.read.parquet(path).inputFiles():
        meta = pq.ParquetFile(file.removeprefix("file://")).metadata
        for g in range(meta.num_row_groups):
            s = {meta.row_group(g).column(c).path_in_schema: meta.row_group(g).column(c).statistics for c in range(meta.num_columns)}
            total += 1
            read += s["box_x0"].min <= 160 and s["box_x1"].max >= 100 and s["box_y0"].min <= 150 and s["box_y1"].max >= 100
    assert total >= 16 and read <= total / 4
    prefixed = {r.lake_id for r in Z.scan_area(spark, path, area, ["lake_id"], ("lake_id", "1")).collect()}
    assert prefixed == {i for i in want if i.startswith("1")}


def test_areas_that_meet(spark):
    """Crossing, touching, one inside the other, in a hole, and no rings at all."""
    ring = lambda a, b, c, d: [(a, b), (c, b), (c, d), (a, d), (a, b)]
    shapes = {"cross": [ring(-1, 1, 5, 2)], "touch": [ring(4, 4, 5, 5)], "inside": [ring(1, 1, 2, 2)], "around": [ring(-9, -9, 9, 9)], "in hole": [ring(-9, -9, 9, 9), ring(-5, -5, 8, 8)], "away": [ring(5, 5, 6, 6)], "empty": [], "null": None, "point": [[(1, 1)]]}
    df = spark.createDataFrame([(k, None if v is None else [[{"x": float(x), "y": float(y)} for x, y in r] for r in v]) for k, v in shapes.items()], "k string, rings array<array<struct<x: double, y: double>>>")
    got = {r.k for r in df.where(Z.meets(F.col("rings"), [(0, 0), (4, 0), (4, 4), (0, 4)])).collect()}
    assert {"cross", "touch", "inside", "around"} <= got and not got & {"in hole", "away", "null"}


def test_z_order(spark):
    got = spark.createDataFrame([(0.0, 0.0), (1.0, 0.0), (0.0, 1.0), (1.0, 1.0), (2.0, 0.0), (-5.0, 99.0)], "x double, y double").select(Z.z_order(F.col("x"), F.col("y"), (0.0, 4.0, 0.0, 4.0), 2)).collect()
    assert [r[0] for r in got] == [0, 1, 2, 3, 4, 10]


def test_sinks_observe_what_they_write(spark):
    df = spark.createDataFrame([(1, 5.0, "a"), (2, float("nan"), "b"), (2, 9.0, None)], "tile_number int, t double, s string")
    path = scratch.new_path(spark, "observed")
    row = R.write_observed(df, path, {"time": "t"}, by=["tile_number"])
    assert row == {"n_rows": 3, "time_min": 5.0, "time_max": 9.0} == R.read_sidecar(spark, path).first().asDict()
    assert R.read(spark, path).count() == 3
    empty = scratch.new_path(spark, "observed")
    assert R.write_observed(df.limit(0), empty, {"time": "t"}) == {"n_rows": 0, "time_min": None, "time_max": None}


def test_bucketed_products_join_without_exchange(spark):
    held = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = product_queries.QUERIES["s13_j3_bucketed_complement"](spark, SF_DIR)
        assert "Exchange" not in df._jdf.queryExecution().executedPlan().toString()
        assert df.count() > 1000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", held)
