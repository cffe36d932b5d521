"""Steps whose work must not grow faster than their input: what is compared, and what is broadcast."""

import itertools
import math

import pytest
from pyspark.sql import functions as F

from mereflow.operators import neighbours as N


@pytest.fixture
def counted(monkeypatch):
    """Numbers of pairs that ``within`` looked at, by call."""
    rows, plain = [], N.within

    def within(left, right, radius, *a, **k):
        out = plain(left, right, radius, *a, **k)
        rows.append(out.count())
        return out

    monkeypatch.setattr(N, "within", within)
    return rows


def _crowds(spark, n):
    """Crowds of n points in few places each, and a few points apart."""
    rows = [(c * n + i, c * 40.0 + i % 7 / 10, c * 30.0 + i % 5 / 20, float(i % 50)) for c in range(4) for i in range(n)]
    rows += [(10**6 + i, 500.0 + i * i * 3, 500.0, 0.0) for i in range(8)]
    return spark.createDataFrame(rows, "id long, x double, y double, z double"), rows


def _components(rows, radius):
    root = {r[0]: r[0] for r in rows}

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    for p, q in itertools.combinations(rows, 2):
        if math.dist(p[1:], q[1:]) <= radius:
            a, b = sorted((find(p[0]), find(q[0])))
            root[b] = a
    return {k: find(k) for k in root}


def test_exploded_rows_are_not_broadcast(spark):
    points, _ = _crowds(spark, 20)
    plan = N.within(points, points, 5.0)._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" not in plan


def test_points_of_a_crowd_are_not_compared(spark, counted):
    points, rows = _crowds(spark, 400)
    got = {r[0] for r in N.isolated_points(points, 15.0, 3).select("id").collect()}
    assert got == {p[0] for p in rows if sum(math.dist(p[1:3], q[1:3]) <= 15.0 for q in rows) > 3}
    assert sum(counted) < 10 * len(rows)


def test_neighbours_of_places_instead_of_points(spark, counted):
    points, rows = _crowds(spark, 400)
    near = N.nearest(points.select("id", "x", "y"), points.select("id", "x", "y"), 3, "id", "id", 15.0)
    got = {(r["id"], r["rank"]): r["id_r"] for r in near.collect()}
    assert len(got) == 3 * len(rows) and sum(counted) < 30 * len(rows)
    for p in rows[::97] + rows[-8:]:
        want = sorted(rows, key=lambda q: (math.dist(p[1:3], q[1:3]), q[0]))[:3]
        assert [got[p[0], i] for i in (1, 2, 3)] == [q[0] for q in want]


def test_crowded_places_go_down_a_tree_of_smaller_buckets(spark, monkeypatch):
    monkeypatch.setattr(N, "CROWD", 2)
    points, rows = _crowds(spark, 60)
    got = {(r["id"], r["rank"]): r["id_r"] for r in N.nearest(points.select("id", "x", "y"), points.select("id", "x", "y"), 4, "id", "id", 15.0).collect()}
    for p in rows[::7]:
        want = sorted(rows, key=lambda q: (math.dist(p[1:3], q[1:3]), q[0]))[:4]
        assert [got[p[0], i] for i in range(1, 5)] == [q[0] for q in want]


@pytest.mark.parametrize("radius", [0.3, 2.0, 6.0, 9.0])
def test_components_of_cells_are_those_of_points(spark, counted, radius):
    rows = [(i, (i * 7919 % 83) / 3, (i * 104729 % 79) / 3, float(i * 31 % 17)) for i in range(700)]
    points = spark.createDataFrame(rows, "id long, x double, y double, z double")
    out = {r["id"]: (r["__root"], r["__n"]) for r in N.point_components(points, radius).collect()}
    want = _components(rows, radius)
    sizes = {k: sum(v == k for v in want.values()) for k in set(want.values())}
    assert out == {k: (v, sizes[v]) for k, v in want.items()} and not counted


def test_small_components_near_others_stay(spark):
    rows = [(i, float(i), 0.0, 0.0) for i in range(5)] + [(10, 10.0, 0.0, 0.0), (20, 60.0, 0.0, 0.0), (30, float("nan"), 0.0, 0.0)]
    points = spark.createDataFrame(rows, "id long, x double, y double, z double")
    got = {(r["id"], r["n"]) for r in N.small_components(points, 2.0, 3, alone=7.0, size="n").collect()}
    assert got == {(i, 5) for i in range(5)} | {(10, 1)}
    assert {r["id"] for r in N.small_components(points, 2.0, 3).select("id").collect()} == set(range(5))


def _boxes(spark, key, at):
    ring = lambda x, y: [[(x, y), (x + 3.0, y), (x + 3.0, y + 2.0), (x, y + 2.0), (x, y)]]
    return spark.createDataFrame([(f"{key}{i}", ring(*at(i))) for i in range(60)], f"{key} string, rings array<array<struct<x: double, y: double>>>")


def test_equal_polygons_are_overlaid_once(spark, monkeypatch):
    from mereflow.operators import geometry as G

    asked, plain = [], G.overlay_area

    def overlay_area(pairs, *a, **k):
        asked.append(pairs.count())
        return plain(pairs, *a, **k)

    monkeypatch.setattr(G, "overlay_area", overlay_area)
    left, right = _boxes(spark, "a", lambda i: (float(i % 3), 0.0)), _boxes(spark, "b", lambda i: (i % 2 + 0.5, 1.0))
    cut = lambda i, j: max(0.0, min(i % 3, j % 2 + 0.5) + 3 - max(i % 3, j % 2 + 0.5))
    want = {(f"a{i}", f"b{j}"): round(cut(i, j), 9) for i in range(60) for j in range(60)}
    got = {(r["a"], r["b"]): round(r["area"], 9) for r in G.overlaps(left, right, "a", "b", 4.0).collect()}
    assert got == {k: v for k, v in want.items() if v > 0} and asked == [6]
    got = {(r["a"], r["b"]): round(r["area"], 9) for r in G.touching_areas(left, right, "a", "b", 4.0).collect()}
    assert got == want


def test_edges_of_a_mask_are_not_broadcast(spark):
    from mereflow.operators import geometry as G

    cells = spark.createDataFrame([(1, x, y) for x in range(6) for y in range(6) if x != 3], "g int, range_index int, azimuth_index int")
    assert "Broadcast" not in G.mask_boundary(cells, ["g"])._jdf.queryExecution().executedPlan().toString()


def _stacked(spark):
    """Points of 6 tiles in the same 25 places, and 40 lakes of 4 different boxes."""
    points = [(t * 100 + i, t, f"o{t}", i % 5 + 0.5, i // 5 + 0.5) for t in range(6) for i in range(25)]
    lakes = [(f"l{k:02d}", k % 4 * 1.0, k % 4 + 2.0, 0.0, 3.0) for k in range(40)]
    corner = "array(array(struct(a as x, c as y), struct(b as x, c as y), struct(b as x, d as y), struct(a as x, d as y), struct(a as x, c as y)))"
    polygons = spark.createDataFrame(lakes, "lake_id string, a double, b double, c double, d double").selectExpr("lake_id", f"{corner} as rings")
    return spark.createDataFrame(points, "id int, tile int, obs_id string, x double, y double"), points, polygons, lakes


def test_places_instead_of_points_meet_shapes_instead_of_polygons(spark):
    from mereflow.operators import geometry as G
    from mereflow.operators import link as K
    from mereflow.operators import products as R

    points, rows, polygons, lakes = _stacked(spark)
    held, members = G.places_in_polygons(points, polygons, "lake_id", 2.0)
    inside = lambda p, k: k[1] <= p[3] < k[2] and k[3] <= p[4] < k[4]
    assert held.count() == sum(inside(p, k) for p in rows[:25] for k in lakes[:4]) and members.count() == 40
    want = {(p[0], k[0]) for p in rows for k in lakes if inside(p, k)}
    got = [tuple(r) for r in G.points_in_polygons(points, polygons, "id", "lake_id", 2.0).collect()]
    assert len(got) == len(want) and set(got) == want
    ratio = {(r["tile"], r["area_id"]): r["ratio"] for r in G.coverage(polygons.withColumnRenamed("lake_id", "area_id"), points, 1.0, 2.0, "tile").collect()}
    assert ratio == {(t, k[0]): sum(inside(p, k) for p in rows[:25]) / 6 for t in range(6) for k in lakes}
    links = R.linked_cells(points, polygons, "obs_id", 2.0)
    assert {(r["obs_id"], r["lake_id"]): r["area"] for r in links.collect()} == {(f"o{t}", k[0]): 6.0 for t in range(6) for k in lakes}
    lake = {r["id"]: r["lake_id"] for r in K.pixel_lakes(points, links, polygons, 2.0, "id").collect()}
    assert all(lake[p[0]] == min(k[0] for k in lakes if inside(p, k)) for p in rows if p[4] < 3)
    corners = lambda k: [(x, y) for x in k[1:3] for y in k[3:5]]
    nearest = lambda p: min((min((p[3] - x) ** 2 + (p[4] - y) ** 2 for x, y in corners(k)), k[0]) for k in lakes)[1]
    assert all(lake[p[0]] == nearest(p) for p in rows if p[4] > 3)


def test_coverage_of_many_places_is_shuffled(spark, monkeypatch):
    from mereflow.operators import geometry as G

    points, _, polygons, _ = _stacked(spark)
    areas = polygons.withColumnRenamed("lake_id", "area_id")
    few = {tuple(r) for r in G.coverage(areas, points, 1.0, 2.0, "tile").collect()}
    monkeypatch.setattr(G, "MAX_HELD", 0)
    assert {tuple(r) for r in G.coverage(areas, points, 1.0, 2.0, "tile").collect()} == few


def test_places_beyond_the_pole_come_back_as_the_sql_names_them(spark, duck):
    from mereflow.functions import scalars as S

    rows = [(lon, lat) for lon in (45.01, 78.25, 96.5) for lat in (45.5, 89.9999, 90.01, 141.3)]
    df = spark.createDataFrame(rows, "a double, b double")
    back = S.from_ecef(*S.to_ecef(F.col("a"), F.col("b"), F.lit(30.0)))
    got = [tuple(round(v, 8) for v in r[:2]) for r in df.orderBy("a", "b").select(*back).collect()]
    sql = "select round(degrees(atan2(cos(f)*sin(l),cos(f)*cos(l))),8), round(degrees(atan2(sin(f),abs(cos(f)))),8) from (select radians(?::double) as l, radians(?::double) as f)"
    assert got == [duck.execute(sql, list(r)).fetchone() for r in sorted(rows)]
    import __spark_entry__

    assert sql[7:90] in __spark_entry__.oracle_sql()["x5_ecef"].replace(" as lon", "").replace(" as lat", "")


def test_ties_of_a_mask_do_not_depend_on_the_order_of_points(spark):
    # the same 400 weights for both masks, in other orders
    places = [(i * 37 % 400 / 20.0, i * 91 % 400 / 23.0) for i in range(400)]
    rows = [(x, y, 1) for x, y in places] + [(20.0 - x, y, 2) for x, y in places[::-1]]
    cells = spark.createDataFrame([(0, 0, 10.0, 10.0)], "ix int, iy int, x double, y double")
    got = N.mask_raster(cells, spark.createDataFrame(rows * 500, "x double, y double, mask int"), 20.0, 1.0, 15.0).collect()
    assert [r["mask"] for r in got] == [None]


@pytest.mark.parametrize("diagonal", [False, True])
def test_labels_of_blocks_are_those_of_the_tile(spark, monkeypatch, diagonal):
    from mereflow.operators import labels as L

    cells = [(t, a, r) for t in (1, 2) for a in range(23) for r in range(19) if (a * 7 + r * 5 + a * r * t) % 11 < 6]
    df = spark.createDataFrame(cells + cells[:9], "tile_number int, azimuth_index int, range_index int")
    moves = [(a, r) for a in (-1, 0, 1) for r in (-1, 0, 1) if (a or r) and (diagonal or not a * r)]
    want, there = {}, set(cells)
    for c in sorted(cells):
        todo = [c]
        while todo:
            t, a, r = todo.pop()
            if (t, a, r) in want or (t, a, r) not in there:
                continue
            want[t, a, r] = (c[0] << 40) | (c[1] << 20) | c[2]
            todo += [(t, a + i, r + j) for i, j in moves]
    nodes, plain = [], L.connected_components

    def connected_components(edges, *a):
        nodes.append(edges.count())
        return plain(edges, *a)

    monkeypatch.setattr(L, "connected_components", connected_components)
    for side, asked in ((128, 0), (5, 1)):
        monkeypatch.setattr(L, "BLOCK", side)
        nodes.clear()
        got = L.lake_labels(df, diagonal).collect()
        assert len(got) == len(cells) + 9 and {(r["tile_number"], r["azimuth_index"], r["range_index"]): r["label"] for r in got} == want
        assert len(nodes) == asked and sum(nodes) < len(cells)


def test_regions_of_equal_cells_meet_once(spark, monkeypatch):
    from mereflow.operators import geometry as G

    boxes = [(f"r{k:02d}", k % 3 * 2, k % 3 * 2 + 3) for k in range(30)]
    cells = spark.createDataFrame([(k, x, y) for k, a, b in boxes for x in range(a, b) for y in range(4)], "id string, ix long, iy long")
    asked, plain = [], G.disjoint_smallest

    def disjoint_smallest(regions, meets, *a):
        asked.append((regions.count(), meets.count()))
        return plain(regions, meets, *a)

    monkeypatch.setattr(G, "disjoint_smallest", disjoint_smallest)
    got = {tuple(r) for r in G.extent_between(cells, 1).collect()}
    # r00 and r02 are taken, r01 meets both; closed they leave the rim of the widened ones
    wide = {(x, y) for x in range(-1, 8) for y in range(-1, 5)}
    assert got == wide - {(x, y) for x in range(7) for y in range(4)} and asked == [(3, 2)]


def test_pairs_within_a_radius_are_compared_by_place(spark, counted, monkeypatch):
    monkeypatch.setattr(N, "MEMBERS", 8)
    points, rows = _crowds(spark, 140)
    got = sorted((r.id, r.id_r, r.d) for r in N.within_by_place(points, points, 5.0, "id", "id", 6).collect())
    want = sorted((p[0], q[0], round(math.dist(p[1:3], q[1:3]), 6)) for p in rows for q in rows if math.dist(p[1:3], q[1:3]) <= 5.0)
    assert [g[:2] for g in got] == [w[:2] for w in want] and all(abs(g[2] - w[2]) < 2e-6 for g, w in zip(got, want))
    assert sum(counted) < len(want) / 10


def test_pixels_of_the_height_models_are_made_once(spark):
    from mereflow.plans.product_queries import QUERIES

    assert not [f for f in QUERIES["d2_a29_height_models"](spark, "/root/testdata/sf0.001").inputFiles() if "lineitem" in f]


def test_equal_boxes_are_one_of_the_disjoint_ones(spark, monkeypatch, tmp_path):
    """Suppliers' boxes repeat after 6,160 keys."""
    import duckdb
    from conftest import same

    from mereflow.operators import geometry as G
    from mereflow.plans import product_queries as Q

    keys = [i + 6160 * j for i in range(40) for j in range(4)]
    spark.createDataFrame([(k,) for k in keys], "s_suppkey long").write.parquet(f"{tmp_path}/supplier.parquet")
    asked, plain = [], G.disjoint_smallest

    def disjoint_smallest(regions, meets, *a):
        asked.append((regions.count(), meets.where("a <> b").count()))
        return plain(regions, meets, *a)

    monkeypatch.setattr(G, "disjoint_smallest", disjoint_smallest)
    c = duckdb.connect()
    c.execute(f"create view supplier as select * from '{tmp_path}/supplier.parquet/*.parquet'")
    same(Q.QUERIES["t5_disjoint_smallest"](spark, str(tmp_path)), c, Q.ORACLE["t5_disjoint_smallest"])
    box = lambda k: (k * 17 % 80, k * 17 % 80 + 4 + k % 11, k * 29 % 80, k * 29 % 80 + 4 + k % 7)
    meet = lambda p, q: p[0] <= q[1] and q[0] <= p[1] and p[2] <= q[3] and q[2] <= p[3]
    assert asked == [(40, sum(meet(box(i), box(j)) for i in range(40) for j in range(40) if i != j))]


def test_few_places_are_sent_to_the_points(spark, monkeypatch):
    from mereflow.operators import geometry as G

    points, rows, polygons, lakes = _stacked(spark)
    met = G.points_in_polygons(points, polygons, "id", "lake_id", 2.0)
    cut = G.clip_cells(points, polygons, "id", 2.0)
    for df in (met, cut):
        assert "SortMergeJoin" not in df._jdf.queryExecution().executedPlan().toString()
    few, few_cut = sorted(map(tuple, met.collect())), sorted(map(tuple, cut.collect()))
    monkeypatch.setattr(G, "MAX_HELD", 0)
    assert sorted(map(tuple, G.points_in_polygons(points, polygons, "id", "lake_id", 2.0).collect())) == few
    assert sorted(map(tuple, G.clip_cells(points, polygons, "id", 2.0).collect())) == few_cut
    assert few == sorted((p[0], k[0]) for p in rows for k in lakes if k[1] <= p[3] < k[2] and k[3] <= p[4] < k[4])


def test_coverage_makes_rows_from_lists(spark, monkeypatch):
    """Cells without a place or outside all areas, and an area without extent."""
    from mereflow.operators import geometry as G

    points, _, polygons, _ = _stacked(spark)
    points = points.unionByName(spark.createDataFrame([(900, 7, "o7", 50.0, 50.0), (901, 8, "o8", None, 1.0)], points.schema))
    flat = spark.createDataFrame([("flat", [[(1.0, 1.0), (2.0, 1.0), (1.0, 1.0)]])], "lake_id string, rings array<array<struct<x: double, y: double>>>")
    areas = polygons.unionByName(flat).withColumnRenamed("lake_id", "area_id")
    got = G.coverage(areas, points, 0.7, 2.0, "tile", digits=3)
    assert "SortMergeJoin" not in got._jdf.queryExecution().executedPlan().toString()
    few = sorted(map(tuple, got.collect()), key=repr)
    assert len(few) == 8 * 41 and {r for r in few if r[0] > 6} == {(t, k, 0.0) for t in (7, 8) for k in [r[0] for r in polygons.select("lake_id").collect()]} | {(t, "flat", None) for t in (7, 8)}
    monkeypatch.setattr(G, "MAX_HELD", 0)
    assert sorted(map(tuple, G.coverage(areas, points, 0.7, 2.0, "tile", digits=3).collect()), key=repr) == few


def test_links_of_shapes_are_lists_of_objects(spark, monkeypatch):
    """Objects in parts of several boxes, one of them outside all and without a place, by lists and shuffled."""
    from mereflow.operators import geometry as G
    from mereflow.operators import link as K

    points, rows, polygons, lakes = _stacked(spark)
    more = [(600 + i, 6, "o6", 0.5 + i % 2 * 4, 0.5) for i in range(3)] + [(610, 7, "o7", 50.0, 50.0), (611, 7, "o7", None, 1.0)]
    points = points.unionByName(spark.createDataFrame(more, points.schema))
    prior = polygons.select("lake_id", F.when(~F.col("lake_id").endswith("3"), F.concat(F.lit("n"), F.reverse("lake_id"))).alias("names"), (F.substring("lake_id", -1, 1).cast("int") % 3).alias("ice_clim_flag"), F.lit(1).alias("ice_dyn_flag"), (F.substring("lake_id", -2, 2).cast("int") % 5).alias("res_id"))
    found = []
    for most in (G.MAX_HELD, 0):
        monkeypatch.setattr(G, "MAX_HELD", most)
        links = K.ShapeLinks(points, polygons, 2.0)
        assert (links.lists is None) == (most == 0)
        # a row per object and shape, not per object and lake
        assert links.met.count() == 6 * 4 + 2 and links.members.count() == 40
        each = G.expanded(links.met, "lake_id", links.members)
        plain = K.linked_lists(each)
        sides = [(links.per_object(), plain[0]), (G.expanded(links.per_lake(), "lake_id", links.members).select("lake_id", "obs_ids"), plain[1]), (links.objects(), each.select("obs_id").distinct()), (links.lakes(), each.select("lake_id").distinct()), (K.copy_prior_of_shapes(links, prior), K.copy_prior(each, prior)), (K.pixel_lakes(points, links, polygons, 2.0, "id"), K.pixel_lakes(points, each, polygons, 2.0, "id"))]
        for a, b in sides:
            got, want = ({repr(r.asDict()) for r in df.select(*sorted(df.columns)).collect()} for df in (a, b))
            assert got == want and got
        found.append(sorted(map(tuple, each.select("obs_id", "lake_id", "area", "overlap").collect())))
    assert found[0] == found[1]


def test_hulls_of_many_groups_are_made_in_batches(spark):
    from mereflow.operators import geometry as G

    rows = [(g, r, float((g * 7 + r * r * 3 + k * 5) % 11), float(r)) for g in range(50) for r in range(4) for k in range(3)]
    got = G.convex_hulls(spark.createDataFrame(rows, "g int, azimuth_index int, x double, y double"), ["g"])
    assert "FlatMapGroupsInPandas" not in got._jdf.queryExecution().executedPlan().toString()
    for r in got.collect():
        pts, ring = {p[2:] for p in rows if p[0] == r.g}, [(p.x, p.y) for p in r.ring]
        assert ring[0] == ring[-1] and set(ring) <= pts
        turn = lambda a, b, p: (b[0] - a[0]) * (p[1] - a[1]) - (b[1] - a[1]) * (p[0] - a[0])
        assert all(turn(a, b, p) >= 0 for a, b in zip(ring, ring[1:]) for p in pts)


@pytest.mark.parametrize("listed", [4096, 3])
def test_unions_are_not_broadcast_and_followed_as_lists(spark, monkeypatch, listed):
    from mereflow import scratch
    from mereflow.operators import geometry as G

    saved, plain = [], scratch.save

    def save(df, name, **options):
        saved.append((name, df._jdf.queryExecution().executedPlan().toString()))
        return plain(df, name, **options)

    monkeypatch.setattr(scratch, "save", save)
    monkeypatch.setattr(G, "LISTED", listed)
    ring = lambda x, y, w: [[(x, y), (x + w, y), (x + w, y + w), (x, y + w), (x, y)]]
    rows = [(g, p, ring(float(p), p * 0.5, 2.0 + g % 3)) for g in range(20) for p in range(2)]
    shapes = spark.createDataFrame(rows, "g int, part int, rings array<array<struct<x: double, y: double>>>")
    got = {r.g: (r.a, r.n) for r in G.union_polygons(shapes, ["g"], "part").select("g", G.rings_area(F.col("rings")).alias("a"), F.size(F.col("rings")[0]).alias("n")).collect()}
    want = lambda w: 2 * w * w - (w - 1) * (w - 0.5)
    assert got.keys() == set(range(20)) and all(a == pytest.approx(want(2.0 + g % 3)) and n == 9 for g, (a, n) in got.items())
    assert not [n for n, plan in saved if "BroadcastHashJoin" in plan and n in ("crossing-edges", "cuts", "pieces", "rim")]
    assert ("ring-edges" in [n for n, _ in saved]) == (listed == 3)


def test_a_products_folder_gets_one_file(spark, tmp_path):
    import glob

    from mereflow.operators import products as R

    df = spark.range(0, 4000, 1, 8).selectExpr("id", "id % 10 as tile_number", "cast(id as double) as t")
    row = R.write_observed(df, f"{tmp_path}/p", {"t": "t"}, by=["tile_number"])
    assert row == {"n_rows": 4000, "t_min": 0.0, "t_max": 3999.0}
    assert len(glob.glob(f"{tmp_path}/p/tile_number=*/*.parquet")) == 10 and R.read(spark, f"{tmp_path}/p").count() == 4000
