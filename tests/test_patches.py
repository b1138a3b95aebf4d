import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from veldcube.operators import patches
from veldcube.sources import dims


def frame(spark, cells):
    return spark.createDataFrame([("X", r, c, float(v)) for (r, c), v in cells.items()], "aoi string, row_idx int, col_idx int, v double")


def brute(cells, connectivity):
    steps = [(0, 1), (1, 0), (0, -1), (-1, 0)]
    if connectivity == 8:
        steps += [(1, 1), (1, -1), (-1, 1), (-1, -1)]
    label = {}
    for start in sorted(cells):
        if start in label:
            continue
        stack = [start]
        label[start] = start
        while stack:
            r, c = stack.pop()
            for dr, dc in steps:
                n = (r + dr, c + dc)
                if n in cells and n not in label and cells[n] == cells[(r, c)]:
                    label[n] = start
                    stack.append(n)
    return label


def labels(df):
    return {(r.row_idx, r.col_idx): divmod(r.component_id, patches.SHIFT) for r in df.collect()}


@pytest.mark.parametrize("connectivity", [4, 8])
def test_components_match_flood_fill_across_blocks(spark, connectivity):
    rng = random.Random(7)
    cells = {(r, c): rng.choice([1, 2]) for r in range(100, 200) for c in range(40, 150) if rng.random() < 0.7}
    got = labels(patches.connected_components(frame(spark, cells), ["aoi"], "v", connectivity, block=16))
    assert got == brute(cells, connectivity)


def test_snake_and_order_do_not_matter(spark):
    # A path that winds through many blocks is one patch, whatever the row order of the input.
    cells = {}
    for k, r in enumerate(range(0, 260, 2)):
        cells.update({(r, c): 1 for c in range(130)})
        cells[(r + 1, 129 if k % 2 == 0 else 0)] = 1
    df = frame(spark, cells)
    a = labels(patches.connected_components(df, ["aoi"], "v"))
    b = labels(patches.connected_components(df.orderBy(F.rand(3)), ["aoi"], "v", block=32))
    assert set(a.values()) == {(0, 0)} and a == b


def test_diagonal_pair(spark):
    df = frame(spark, {(0, 0): 1, (1, 1): 1})
    assert len(set(labels(patches.connected_components(df, ["aoi"], "v", 4)).values())) == 2
    assert len(set(labels(patches.connected_components(df, ["aoi"], "v", 8)).values())) == 1


def test_outline_of_ring_with_hole(spark):
    cells = {(r, c): 1 for r in range(3) for c in range(3) if (r, c) != (1, 1)}
    comp = patches.connected_components(frame(spark, cells), ["aoi"], "v")
    outline = patches.patch_outline(comp, ["aoi"])
    totals = sorted((r.area_cells, r.length, r.n_corners) for r in patches.ring_totals(outline, ["aoi"]).collect())
    assert totals == [(-1.0, 4, 4), (9.0, 12, 4)]
    ring = [(r.x, r.y) for r in outline.where("corner").orderBy("ring_id", "seq").collect()]
    assert ring[:4] == [(0, 0), (3, 0), (3, 3), (0, 3)]


def test_outline_pinched_at_a_corner(spark):
    # Two arms meet diagonally at (2, 2): a four-connected patch keeps separate turns there.
    cells = {(0, 0): 1, (0, 1): 1, (0, 2): 1, (1, 0): 1, (2, 0): 1, (2, 1): 1, (1, 2): 1}
    comp = patches.connected_components(frame(spark, cells), ["aoi"], "v")
    totals = patches.ring_totals(patches.patch_outline(comp, ["aoi"]), ["aoi"]).collect()
    assert sum(t.area_cells for t in totals) == 7.0
    assert len(totals) == 1


def test_random_outlines_follow_euler(spark):
    rng = random.Random(11)
    cells = {(r, c): 1 for r in range(40) for c in range(70) if rng.random() < 0.62}
    label = brute(cells, 4)
    comp = patches.connected_components(frame(spark, cells), ["aoi"], "v")
    totals = patches.ring_totals(patches.patch_outline(comp, ["aoi"]), ["aoi"]).collect()
    area, rings = {}, {}
    for t in totals:
        p = divmod(t.component_id, patches.SHIFT)
        area[p] = area.get(p, 0) + t.area_cells
        rings[p] = rings.get(p, 0) + 1
    for p in set(label.values()):
        own = {k for k, v in label.items() if v == p}
        pairs = sum(((r + 1, c) in own) + ((r, c + 1) in own) for r, c in own)
        quads = sum({(r + 1, c), (r, c + 1), (r + 1, c + 1)} <= own for r, c in own)
        assert area[p] == len(own)
        assert rings[p] == 2 - (len(own) - pairs + quads)


def test_simplify_drops_small_steps_and_keeps_triangle(spark):
    stairs = [(0.0, 0.0)] + [(float(i * 10), 4.0 if i % 2 else 0.0) for i in range(1, 100)] + [(1000.0, 500.0), (0.0, 500.0), (0.0, 0.0)]
    tiny = [(0.0, 0.0), (1.0, 0.0), (1.0, 1.0), (0.0, 1.0), (0.0, 0.0)]
    rows = [("a", i, x, y) for i, (x, y) in enumerate(stairs)] + [("b", i, x, y) for i, (x, y) in enumerate(tiny)]
    df = spark.createDataFrame(rows, "ring string, seq long, x double, y double")
    out = patches.simplify_rings(df, ["ring"], 50.0)
    rounds = patches.simplify_rings(df, ["ring"], 50.0, one_task=3)
    assert sorted(out.collect()) == sorted(rounds.select(*out.columns).collect())
    kept = {k: [] for k in "ab"}
    for r in out.orderBy("ring", "seq").collect():
        kept[r.ring].append((r.x, r.y))
    assert kept["a"][0] == kept["a"][-1] == (0.0, 0.0)
    assert (1000.0, 500.0) in kept["a"] and (0.0, 500.0) in kept["a"] and len(kept["a"]) <= 6
    assert len(kept["b"]) == 4
    # Every dropped vertex lies within the tolerance of the kept line.
    def gap(p, a, b):
        (px, py), (ax, ay), (bx, by) = p, a, b
        l2 = (bx - ax) ** 2 + (by - ay) ** 2
        t = max(0.0, min(1.0, ((px - ax) * (bx - ax) + (py - ay) * (by - ay)) / l2)) if l2 else 0.0
        return ((px - ax - t * (bx - ax)) ** 2 + (py - ay - t * (by - ay)) ** 2) ** 0.5
    assert all(min(gap(p, a, b) for a, b in zip(kept["a"], kept["a"][1:])) <= 50.0 for p in stairs)


def test_both_ways_to_simplify_agree_on_random_rings(spark):
    rng = random.Random(5)
    rows = []
    for ring in range(6):
        points = [(float(rng.randrange(400)), float(rng.randrange(400))) for _ in range(80)]
        rows += [(ring, i, x, y) for i, (x, y) in enumerate([*points, points[0]])]
    df = spark.createDataFrame(rows, "ring int, seq long, x double, y double")
    a = patches.simplify_rings(df, ["ring"], 120.0).collect()
    b = patches.simplify_rings(df, ["ring"], 120.0, one_task=1).select("ring", "seq", "x", "y").collect()
    assert sorted(a) == sorted(b) and len(a) < len(rows)


def test_vertex_area_does_not_depend_on_stretches(spark):
    ring = [(26.0, -14.0), (26.1, -14.0), (26.1, -14.05), (26.05, -14.07), (26.0, -14.1), (26.0, -14.0)]
    df = spark.createDataFrame([("X", 0, i * 10, x, y) for i, (x, y) in enumerate(ring)], "aoi string, ring_id int, seq long, lon double, lat double")
    whole = patches.vertex_area(df, ["aoi"]).first().area_km2
    assert whole > 80 and patches.vertex_area(df, ["aoi"], step=15).first().area_km2 == pytest.approx(whole, rel=1e-12)


def test_feature_lines(spark):
    import json
    cells = {(r, c): 1 for r in range(3) for c in range(3) if (r, c) != (1, 1)}
    comp = patches.connected_components(frame(spark, cells), ["aoi"], "v")
    outline = patches.patch_outline(comp, ["aoi"])
    grid = dims.grid_dim(spark, dims.BLOCK_GRID).limit(1).withColumn("aoi", F.lit("X"))
    vertices = patches.ring_vertices(outline, ["aoi"], grid)
    props = comp.groupBy("aoi", "component_id").agg(F.max("value").alias("frp_years"))
    f = json.loads(patches.patch_features(vertices, ["aoi"], props).collect()[0].feature)
    outer, hole = f["geometry"]["coordinates"]
    assert f["properties"]["frp_years"] == 1.0
    assert outer[0] == outer[-1] == [26.0, -14.0] and len(outer) == 5 and len(hole) == 5


def test_many_rings_in_lockstep_keep_what_each_keeps_alone():
    rng = np.random.default_rng(7)
    for closed in (True, False):
        rings = []
        for n in [2, 3, 4, 5, *rng.integers(2, 60, 200)]:
            points = rng.integers(0, 6, (n, 2)) * 30.0
            if closed:
                points[-1] = points[0]
            rings.append(points)
        starts = np.cumsum([0, *[len(r) for r in rings[:-1]]])
        whole = np.concatenate(rings)
        mask = patches._keep_masks(starts, whole[:, 0], whole[:, 1], 50.0, closed)
        alone = [patches._keep_masks(np.array([0]), r[:, 0], r[:, 1], 50.0, closed) for r in rings]
        assert (mask == np.concatenate(alone)).all()


def test_short_rings_share_tasks(spark):
    """Groups of Python work follow the vertices, not the number of rings."""
    rows = spark.range(400).selectExpr("id DIV 4 AS ring", "id % 4 AS seq", "CAST(id % 4 AS DOUBLE) * 100 AS x", "0D AS y")
    out = patches.simplify_rings(rows, ["ring"], 50.0, closed=False)
    assert sorted(out.collect()) == sorted(rows.where("seq IN (0, 3)").collect())
    assert "_bucket" in out._jdf.queryExecution().toString()
