"""Queries over whole tables: on sf0.01, which has 16 tiles, where sf0.001 has one."""

import math

import pytest
from conftest import SF_DIR, same

from mereflow import fixtures
from mereflow.operators import labels
from mereflow.plans import cycle_queries, geometry_queries, grid_queries, product_queries

MORE = "/root/testdata/sf0.01"
TILES = ["j6_points_in_polygons", "j7_j8_pixel_lakes", "j13_exempt_objects", "g1_g2_g11_mask_rings", "g14_boundary_cells", "g8_g9_dilate", "a25_j20_ring_elevation", "a32_coverage", "g7_r7_clip_cells", "g13_g1_ordered_rings", "u7_combined_cloud"]


@pytest.fixture(scope="module")
def more():
    import duckdb

    c = duckdb.connect()
    for t in ("lineitem", "orders", "supplier", "customer"):
        c.execute(f"create view {t} as select * from '{MORE}/{t}.parquet'")
    return c


def tile_of(row):
    if "tile_number" in row:
        return row["tile_number"]
    if "source" in row:
        return row["source"] + 1
    if "label" in row:
        return row["label"] >> 40
    return row["obj"] // 100 if "obj" in row else row["cell" if "cell" in row else "pixel"] // 10000


@pytest.mark.parametrize("name", TILES)
def test_every_tile(spark, more, name):
    known, sql = geometry_queries.QUERIES | product_queries.QUERIES, geometry_queries.ORACLE | product_queries.ORACLE
    got = known[f"{name}"](spark, MORE).cache()
    same(got, more, sql[f"{name}"])
    assert {tile_of(r) for r in got.collect()} == set(range(1, 17))
    got.unpersist()


POINTS = ["r1_grid", "j18_t4_nearest", "j19_within_radius", "c7_small_components", "c8_outliers_removed", "c9_isolated_points", "r2_idw_grid", "r3_limited_idw", "r4_gaussian_grid", "r5_mask_grid"]


def test_every_point(spark):
    """All orders are points and neighbours, by brute force."""
    q = grid_queries.QUERIES
    rows = spark.read.parquet(f"{SF_DIR}/orders.parquet").select("o_orderkey", "o_custkey").collect()
    at = {r[0]: (r[0] * 7919 % 1000 + r[1] % 7 / 10, r[0] * 104729 % 1000 + r[1] % 11 / 20) for r in rows}
    near = {(a, b) for a, p in at.items() for b, o in at.items() if math.dist(p, o) <= 12}
    assert {(r["id"], r["other"]) for r in q["j19_within_radius"](spark, SF_DIR).collect()} == near
    assert sum(r["n_in_cell"] for r in q["r4_gaussian_grid"](spark, SF_DIR).collect()) > len(rows) * 0.9
    assert all("orders where" not in grid_queries.ORACLE[f"{name}"] for name in POINTS)


def plain_kmeans(values, most=11):
    values = sorted(values)
    for k in range(1, most + 1):
        places = [(i + 0.5) / k * (len(values) - 1) for i in range(k)]
        centres = [values[int(p)] + (values[math.ceil(p)] - values[int(p)]) * (p - int(p)) for p in places]
        old = None
        while True:
            of = [next(j for j, c in enumerate(centres) if abs(v - c) <= min(abs(v - x) for x in centres) + 2e-9) for v in values]
            groups = [[v for v, c in zip(values, of) if c == j] for j in sorted(set(of))]
            if groups == old:
                break
            old, centres = groups, [sum(g) / len(g) for g in groups]
        if all(math.sqrt(sum((v - sum(g) / len(g)) ** 2 for v in g) / len(g)) <= 1 for g in groups):
            break
    return {v: j for j, g in enumerate(groups) for v in g}


def test_kmeans_grows_and_settles(spark):
    rows = [(1, float(10 * i + j)) for i in range(7) for j in (0, 1)] + [(2, 3.0)] * 3 + [(3, float("nan")), (3, 5.0)]
    got = labels.height_kmeans(spark.createDataFrame(rows, "label int, height double"), ["label"]).collect()
    assert {(r.height, r.cluster) for r in got if r.label == 1} == {(h, int(h // 10)) for k, h in rows if k == 1}
    assert [(r.height, r.cluster) for r in got if r.label != 1].count((3.0, 0)) == 3 and len(got) == 14 + 3 + 1
    own = [r for r in fixtures.pixc(spark, SF_DIR).select("tile_number", "lake", "range_index", "azimuth_index", "height").collect() if r.height == r.height]
    want = {}
    for lake in {r.lake for r in own}:
        of = plain_kmeans([float(r.height) for r in own if r.lake == lake])
        want |= {(r.tile_number, r.range_index, r.azimuth_index): of[float(r.height)] for r in own if r.lake == lake}
    found = product_queries.QUERIES["c4_height_kmeans"](spark, SF_DIR).collect()
    assert {(r.tile_number, r.range_index, r.azimuth_index): r.cluster for r in found} == want
    assert max(want.values()) > 3


@pytest.mark.parametrize("module,name", [(product_queries, "s3_edge_scan"), (cycle_queries, "x7_great_circle"), (cycle_queries, "j21_nearest_date")])
def test_no_row_left_out(spark, more, module, name):
    got = module.QUERIES[f"{name}"](spark, MORE)
    same(got, more, module.ORACLE[f"{name}"])
    if name == "s3_edge_scan":
        assert got.select("tile_number").distinct().count() == 16
    elif name == "x7_great_circle":
        assert got.count() == more.execute("select count(*) from customer").fetchone()[0] and got.where("d = 0").count() > 0
    else:
        assert got.where("day(nearest) <> 15").count() > 0
