"""Cells that are worked on in blocks: what crosses blocks, and plans that deal cells once."""

import random

from mereflow.operators import geometry as G
from mereflow.operators import labels as L

STEP = ((1, 0), (0, 1), (-1, 0), (0, -1))


def _rings(cells):
    """Rings of corners of one group's cells, from the smallest (corner, side) on, the sharper left turn first."""
    sides = {}
    for x, y in cells:
        for side, (dx, dy, ox, oy) in enumerate(((0, 0, 0, -1), (1, 0, 1, 0), (1, 1, 0, 1), (0, 1, -1, 0))):
            if (x + ox, y + oy) not in cells:
                sides.setdefault((x + dx, y + dy), set()).add(side)
    left, out = {(p, s) for p, ss in sides.items() for s in ss}, []
    while left:
        first = at = min(left)
        ring = []
        while not ring or at != first:
            ring.append(at[0])
            left.discard(at)
            p = (at[0][0] + STEP[at[1]][0], at[0][1] + STEP[at[1]][1])
            at = next((p, s) for s in ((at[1] + 1) % 4, at[1], (at[1] + 3) % 4) if s in sides.get(p, ()))
        out.append(ring)
    return sorted(out)


def _scenes():
    noise = random.Random(5)
    scattered = {(x, y) for x in range(-20, 300) for y in range(100, 150) if noise.random() < 0.6}
    frame = {(x, y) for x in range(-150, 270) for y in range(-5, 270) if min(x + 150, 269 - x, y + 5, 269 - y) < 3}
    comb = {(x, y) for x in range(120, 140) for y in range(0, 400) if y % 2 == 0 or x == (120 if y % 4 == 1 else 139)}
    return {"scattered": scattered, "frame": frame, "comb": comb, "one": {(127, 127), (128, 128)}}


def _frame(spark, scenes):
    rows = [(g, x, y) for g, c in scenes.items() for x, y in c]
    return spark.createDataFrame(rows + rows[:7] + [(None, 1, 1)], "g string, range_index int, azimuth_index int")


def test_rings_across_blocks(spark):
    scenes = _scenes()
    got = {}
    for r in G.ordered_rings(_frame(spark, scenes), ["g"]).collect():
        got.setdefault(r.g, {}).setdefault(r.ring, []).append((r.position, (r.x, r.y)))
    found = {}
    for g, rings in got.items():
        assert all(sorted(p for p, _ in v) == list(range(len(v))) for v in rings.values())
        found[g] = sorted([xy for _, xy in sorted(v)] for v in rings.values())
    assert found == {g: _rings(c) for g, c in scenes.items()}


def test_ring_areas_across_blocks(spark):
    scenes = _scenes()
    got = {}
    for r in G.mask_rings(_frame(spark, scenes), ["g"]).collect():
        got.setdefault(r.g, []).append((r.area, r.n_edges))
    area = lambda v: sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(v, v[1:] + v[:1])) / 2
    assert {g: sorted(v) for g, v in got.items()} == {g: sorted((area(v), len(v)) for v in _rings(c)) for g, c in scenes.items()}


def test_open_cells_keep_rows_and_columns(spark):
    scenes = _scenes()
    df = _frame(spark, scenes).selectExpr("*", "concat(g, '!') as note")
    got = sorted((r.g, r.range_index, r.azimuth_index, r.note) for r in G.boundary_cells(df, ["g"]).collect())
    bare = lambda c, x, y: any((x + a, y + b) not in c for a, b in STEP)
    assert got == sorted((r.g, r.range_index, r.azimuth_index, r.note) for r in df.collect() if r.g and bare(scenes[r.g], r.range_index, r.azimuth_index))


def test_widened_across_blocks(spark):
    cells = [("a", 127, 0), ("a", 128, 300), ("b", -1, 127), (None, 5, 5)]
    df = spark.createDataFrame(cells, "g string, ix int, iy int")
    for d in (1, 2, 5, 150):
        got = {(r.g, r.ix, r.iy) for r in G.dilate(df, d, "g").collect()}
        assert got == {(g, x + i, y + j) for g, x, y in cells for i in range(-d, d + 1) for j in range(-d, d + 1)}


def test_cells_are_dealt_once(spark):
    df = _frame(spark, {"one": {(1, 1), (1, 2)}}).selectExpr("g", "range_index as ix", "azimuth_index as iy", "1.5D as height")
    plans = [G.boundary_cells(df, ["g"], "ix", "iy"), G.dilate(df, 3, "g"), G.expand_water(df, [(1, 0.5), (3, 2.0)], "g")]
    for out in plans:
        plan = out._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("RepartitionByExpression") == 1 and "Join" not in plan and "Aggregate" not in plan


def test_labels_of_bare_pixels_are_not_joined_back(spark):
    df = spark.createDataFrame([(1, 0, 0), (1, 0, 1), (1, 0, 1), (1, 5, 5)], "tile_number long, azimuth_index int, range_index int")
    own = L.lake_labels(df)
    assert "Join" not in own._jdf.queryExecution().optimizedPlan().toString()
    assert len({r.label for r in own.collect()}) == 2 and own.count() == 4


def test_kmeans_by_lists_and_in_rounds(spark):
    noise = random.Random(3)
    rows = [(o, round(noise.gauss(o * 2 + 9 * noise.randrange(4), 1.5), 2)) for o in range(4) for _ in range(60)]
    df = spark.createDataFrame(rows, "label int, height double")
    lists, rounds = ({(r.label, r.height): r.cluster for r in L.height_kmeans(df, ["label"], listed=n).collect()} for n in (4096, 1))
    assert lists == rounds and len({c for c in lists.values()}) > 3


def test_kmeans_of_few_heights_takes_no_rounds(spark, monkeypatch):
    monkeypatch.setattr(L, "_kmeans_in_rounds", None)
    df = spark.createDataFrame([(1, float(v)) for v in (0, 1, 10, 11)], "label int, height double")
    assert sorted((r.height, r.cluster) for r in L.height_kmeans(df, ["label"]).collect()) == [(0.0, 0), (1.0, 0), (10.0, 1), (11.0, 1)]
