"""The whole jobs on odd and empty clouds, the pass job's layers and complement, and the chains' smaller pieces."""

import math

import pytest
from conftest import SF_DIR
from pyspark.sql import functions as F

from mereflow.operators import aggregates as A
from mereflow.operators import geoloc as O
from mereflow.operators import jobs as J
from mereflow.operators import link as K
from mereflow.operators import select as P
from mereflow.plans import product_queries as Q


def test_pass_job_appends_layers_and_updates_the_complement(spark):
    """Two copies of the tile, one above the other: what their border cuts is merged, numbered on, and put into the complement."""
    one = Q._sensed(spark, SF_DIR)
    two = one.unionByName(one.withColumns({"tile_number": F.col("tile_number") + 1, "latitude": F.col("latitude") + 0.0096}))
    prior = Q._references(spark, SF_DIR)
    tiles = J.tile_job(two, two.where("river = 1").select("tile_number", "range_index", "azimuth_index", "reach_id"), prior, min_size_km2=0.0001, size_range=96)
    edge = tiles["edge"].withColumn("pass_number", F.lit(1))
    meta = spark.createDataFrame([(1, 1, 8e5, 0.75, 96), (1, 2, 8e5, 0.75, 96)], "pass_number int, tile_number long, near_range double, nominal_slant_range_spacing double, interferogram_size_azimuth int")
    base = two.select("tile_number", "range_index", "azimuth_index", F.lit(None).cast("string").alias("obs_id"), F.lit(None).cast("string").alias("lake_id"), *(F.col(a).alias(b) for a, b in (("longitude", "lon_imp"), ("latitude", "lat_imp"), ("height", "height_imp"))))
    out = J.pass_job(edge, meta, ["pass_number"], prior, tiles, K.update_complement(base, tiles["vec"], ["tile_number", "range_index", "azimuth_index"], ["obs_id", "lake_id", "lon_imp", "lat_imp", "height_imp"]), 0.0001)
    own = J.pass_job(edge, meta, ["pass_number"], prior, min_size_km2=0.0001)
    ids = [r.obs_id for layer in ("obs", "unassigned") for r in out[layer].select("obs_id").collect()]
    tile_ids = [r.obs_id for layer in ("obs", "unassigned") for r in tiles[layer].select("obs_id").collect()]
    merged = own["obs"].count() + own["unassigned"].count()
    assert len(ids) == len(set(ids)) == len(tile_ids) + merged and set(tile_ids) < set(ids) and merged > 0
    vec = out["vec"].cache()
    assert vec.count() == two.count()
    assert {r.obs_id for r in vec.where("obs_id is not null").select("obs_id").distinct().collect()} == set(ids)
    tall = own["vec"].groupBy("obs_id").agg(F.count_distinct("tile_number").alias("n")).where("n = 2").count()
    assert tall > 0 and own["vec"].agg(F.max("azimuth_index")).first()[0] <= 95


def test_jobs_without_pixels_or_prior_lakes(spark):
    p, prior = Q._sensed(spark, SF_DIR), Q._references(spark, SF_DIR)
    river = p.where("river = 1").select("tile_number", "range_index", "azimuth_index", "reach_id")
    empty = J.tile_job(p.limit(0), river.limit(0), prior)
    assert {k: v.count() for k, v in empty.items() if k != "unobserved"} == {"obs": 0, "unassigned": 0, "prior": 0, "vec": 0, "edge": 0} and empty["unobserved"].count() == prior.count()
    alone = J.tile_job(p, river, prior.limit(0).select("lake_id", "rings"), min_size_km2=0.0005)
    assert alone["obs"].count() == alone["prior"].count() == 0 and alone["unassigned"].count() > 0
    row = alone["unassigned"].where("contour").first()
    assert row.rings[0][0] == row.rings[0][-1] and len(row.obs_id) == 13 and row.lake_ids is None


def test_river_chain(spark):
    """A reach of one good node leaves its pixels where they are; a fitted one moves them to the line."""
    nodes = [("r", n, 100.0 * n, 10.0 + 2 * n, 1.0, 0.5, 0.25, 0.125) for n in range(1, 5)] + [("r", 5, 500.0, None, 1.0, 0.5, 0.25, 0.125), ("s", 1, 100.0, 7.0, 1.0, 0.5, 0.25, 0.125)]
    nodes = spark.createDataFrame(nodes, "reach_id string, node_id long, s double, h_n_ave double, geoid_hght double, load_tidef double, solid_tide double, pole_tide double")
    px = spark.createDataFrame([("r", 2, 200.0, 3.0), ("r", 2, 225.0, 3.0), ("r", 5, 500.0, 3.0), ("s", 1, 100.0, 3.0), ("t", 1, 0.0, 3.0)], "reach_id string, node_id long, along_reach double, height double")
    from mereflow.functions.scalars import to_ecef

    px = px.withColumns({"longitude": F.lit(5.0), "latitude": F.lit(45.0)})
    sx, sy, sz = to_ecef(F.lit(5.4), F.lit(45.001), F.lit(891000.0))
    px = px.withColumns({"sx": sx, "sy": sy, "sz": sz, "vx": F.lit(-5000.0), "vy": F.lit(1000.0), "vz": F.lit(5200.0)})
    got = {(r.reach_id, r.node_id, r.along_reach): r.height_imp for r in O.river_geolocation(px, nodes).collect()}
    want = {("r", 2, 200.0): 15.875, ("r", 2, 225.0): 16.375, ("r", 5, 500.0): 21.875, ("s", 1, 100.0): 3.0, ("t", 1, 0.0): 3.0}
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(v, abs=1e-3) for k, v in want.items())


def test_uncertainty_from_moments_is_that_of_pixels(spark):
    """The bias of a scope, added up pixel by pixel."""
    import random

    rng = random.Random(4)
    rows = [(t, o, rng.choice([1, 2, 3, 4, 5, 6, 7]), 50 + rng.random(), rng.random(), rng.random() / 10, rng.random() / 10, rng.random() / 10, 0.02) for t in (1, 2) for o in (1, 2, 3) for _ in range(20)]
    df = spark.createDataFrame(rows, "tile_number int, obj int, classification int, pixel_area double, water_frac double, water_frac_uncert double, missed_detection_rate double, false_detection_rate double, darea_dheight double")
    got = {(r.tile_number, r.obj): r.area_u for r in A.area_uncertainty(df, F.col("classification"), ["tile_number", "obj"]).collect()}
    for t in (1, 2):
        own = [r for r in rows if r[0] == t]
        edge, inside = [r for r in own if r[2] in (2, 3)], [r for r in own if r[2] in (4, 6, 7)]
        pde = min(1.0, len(edge) / (len(edge) + len(inside)))
        pfa = pma = 1 - 0.9
        bf = pfa * 0.5 - pma * 0.5

        def parts(r):
            a, al, u, md, fd, da = r[3:]
            pdw, vdw = (1 - md) * 0.5 + fd * 0.5, fd * 0.5 + md * 0.5
            vdwf = 0.5 * vdw + 0.5 * 0.1 - 2 * md * 0.5 * pfa * 0.5
            bdwf = (fd * 0.5 - md * 0.5) * 0.5 + 0.5 * bf
            sa = da * 10.0 * a
            return [a * a / 12 * 0.5, sa * sa * pdw * 0.5, a * a * vdwf, a * a * (u * u * 0.5 + al * al * 0.1), sa * sa * (u * u + al * al) * 0.5], a * ((1 - pde) * bdwf + pde * al * bf)

        bias = [parts(r)[1] for r in edge + inside]
        b = sum(bias) ** 2 - sum(x * x for x in bias)
        for o in (1, 2, 3):
            v = [sum(parts(r)[0][k] for r in edge + inside if r[1] == o and (k > 0 or r in edge)) for k in range(5)]
            total = 0.1 * v[0] + pde * v[3] + (1 - pde) * v[2] + pde * v[4] + (1 - pde) * v[1] + b
            assert got[(t, o)] == pytest.approx(math.sqrt(max(total, 0.0)), rel=1e-9)


def test_windows_of_objects(spark):
    """An object cut by the window is partial, one outside it goes; an object with one bad position has validity 1."""
    df = spark.createDataFrame([(1, 10.0, 1.0), (1, 99.0, 2.0), (2, 20.0, None), (2, 21.0, 3.0), (3, 99.0, 1.0), (4, 5.0, float("nan"))], "o int, cross_track double, v double")
    got = sorted((r.o, r.partial_f) for r in P.cross_track_window(df, ["o"], None, 50.0).collect())
    assert got == [(1, 1), (2, 0), (2, 0), (4, 0)]
    valid = sorted((r.o, r.validity) for r in P.valid_geolocation(df, ["o"], ["v"]).collect())
    assert valid == [(1, 2), (1, 2), (2, 1), (3, 2)]
