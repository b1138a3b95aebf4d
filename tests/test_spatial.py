import random

import pytest
from pyspark.sql import functions as F

from veldcube.operators import spatial
from veldcube.sources import dims


def ring(spark, rings, layer="p", polygon=1):
    rows = [("X", layer, polygon, k, i, x, y) for k, r in enumerate(rings) for i, (x, y) in enumerate(r)]
    return spark.createDataFrame(rows, "aoi string, layer string, polygon_id int, ring_id int, seq int, lon double, lat double")


@pytest.fixture(scope="module")
def grid(spark):
    return spark.createDataFrame([("X", 500, 0.0, 20.0, 1.0, -1.0, 20, 30)],
                                 "aoi string, resolution int, west double, north double, dx double, dy double, n_rows int, n_cols int")


@pytest.fixture(scope="module")
def cells(spark):
    return spark.createDataFrame([("X", 500, r, c, 1.0) for r in range(20) for c in range(30)],
                                 "aoi string, resolution int, row_idx int, col_idx int, value double")


def at(df):
    return {(r.row_idx, r.col_idx) for r in df.collect()}


def parity(rings, x, y):
    n = 0
    for r in rings:
        for (x1, y1), (x2, y2) in zip(r, r[1:]):
            if (y1 <= y) != (y2 <= y) and x < x1 + (y - y1) / (y2 - y1) * (x2 - x1):
                n += 1
    return n % 2 == 1


def test_spans_equal_even_odd_on_random_polygons(spark, grid, cells):
    rng = random.Random(1)
    for _ in range(4):
        points = [(rng.uniform(-4, 34), rng.uniform(-3, 23)) for _ in range(9)]
        points.append(points[0])
        spans = spatial.polygon_spans(spatial.ring_edges(ring(spark, [points])), grid)
        want = {(r, c) for r in range(20) for c in range(30) if parity([points], c + 0.5, 20 - r - 0.5)}
        assert at(spatial.mask_polygon(cells, spans)) == want
        assert at(spatial.mask_polygon(cells, spans, keep_inside=False)) == {(r, c) for r in range(20) for c in range(30)} - want


def test_hole_and_vertex_on_centre_latitude(spark, grid, cells):
    outer = [(2.0, 18.5), (12.0, 18.5), (12.0, 8.5), (2.0, 8.5), (2.0, 18.5)]
    hole = [(4.1, 16.2), (8.1, 16.2), (8.1, 11.2), (4.1, 11.2), (4.1, 16.2)]
    spans = spatial.polygon_spans(spatial.ring_edges(ring(spark, [outer, hole])), grid)
    want = {(r, c) for r in range(20) for c in range(30) if parity([outer, hole], c + 0.5, 20 - r - 0.5)}
    assert at(spatial.mask_polygon(cells, spans)) == want and (6, 5) not in want and (2, 3) in want


def test_overlapping_polygons_keep_a_cell_once(spark, grid, cells):
    a = ring(spark, [[(1.2, 19.2), (9.2, 19.2), (9.2, 11.2), (1.2, 11.2), (1.2, 19.2)]], "Crops", 1)
    b = ring(spark, [[(5.2, 15.2), (15.2, 15.2), (15.2, 5.2), (5.2, 5.2), (5.2, 15.2)]], "Crops", 2)
    spans = spatial.polygon_spans(spatial.ring_edges(a.unionByName(b)), grid)
    inside = at(spatial.mask_polygon(cells, spans))
    assert spatial.mask_polygon(cells, spans).count() == len(inside)
    flagged = spatial.inside_flag(cells, spans)
    assert flagged.count() == 600 and at(flagged.where("inside")) == inside
    both = spatial.mask_two_level(cells, spans, spans)
    assert both.count() == len(inside) and {r.land_cover for r in both.collect()} == {"Crops"}


def test_cell_in_two_classes_appears_twice(spark, grid, cells):
    square = [[(1.2, 19.2), (9.2, 19.2), (9.2, 11.2), (1.2, 11.2), (1.2, 19.2)]]
    v = ring(spark, square, "Crops", 1).unionByName(ring(spark, square, "Trees", 2))
    spans = spatial.polygon_spans(spatial.ring_edges(v), grid)
    n = spatial.mask_polygon(cells, spans).count()
    assert spatial.mask_two_level(cells, spans, spans).count() == 2 * n > 0


def crosses(a, b, box):
    """Segment against box by clipping."""
    (x1, y1), (x2, y2) = a, b
    t0, t1 = 0.0, 1.0
    for p, d, lo, hi in ((x1, x2 - x1, box[0], box[1]), (y1, y2 - y1, box[2], box[3])):
        if d == 0:
            if not lo <= p <= hi:
                return False
            continue
        u, v = sorted(((lo - p) / d, (hi - p) / d))
        t0, t1 = max(t0, u), min(t1, v)
    return t0 <= t1


def test_all_touched(spark, grid, cells):
    rng = random.Random(4)
    points = [(rng.uniform(1, 29), rng.uniform(1, 19)) for _ in range(7)]
    points.append(points[0])
    edges = spatial.ring_edges(ring(spark, [points]))
    want = {
        (r, c) for r in range(20) for c in range(30)
        if parity([points], c + 0.5, 19.5 - r) or any(crosses(a, b, (c, c + 1, 19 - r, 20 - r)) for a, b in zip(points, points[1:]))
    }
    assert at(spatial.mask_polygon_all_touched(cells, edges, grid)) == want


def test_erode_equals_repeated_steps(spark):
    rng = random.Random(2)
    have = {(r, c) for r in range(25) for c in range(25) if rng.random() < 0.93}
    step = have
    for _ in range(2):
        step = {(r, c) for r, c in step if {(r + 1, c), (r - 1, c), (r, c + 1), (r, c - 1)} <= step}
    df = spark.createDataFrame([("X", r, c) for r, c in have], "aoi string, row_idx int, col_idx int")
    got = spatial.erode(df, ["aoi"], 2)
    assert got.count() == len(have) and at(got.where("interior")) == step


def test_grid_comparison_lists_parts(spark):
    a = dims.grid_dim(spark, dims.BLOCK_GRID)
    assert all(r.match and r.differs_in == "" for r in spatial.compare_grids(a, a).collect())
    b = a.withColumn("n_rows", F.lit(9)).withColumn("dx", F.col("dx") + 1e-6)
    assert {r.differs_in for r in spatial.compare_grids(a, b).collect()} == {"shape, transform, bbox"}
    c = a.withColumn("west", F.col("west") + 1e-10)
    assert all(r.match for r in spatial.compare_grids(a, c).collect())


def test_align_identity_and_off_grid(spark, grid, cells):
    same = spatial.align_nearest(cells, grid, grid)
    assert same.where("row_idx <> src_row OR col_idx <> src_col OR value IS NULL").count() == 0
    moved = grid.withColumn("west", F.col("west") + 28.2)
    got = spatial.align_nearest(cells, grid, moved)
    assert got.where("col_idx >= 2 AND value IS NOT NULL").count() == 0 and got.where("value IS NOT NULL").count() == 40


def test_polygon_with_hole_area(spark):
    outer = [(26.0, -14.0), (26.1, -14.0), (26.1, -14.1), (26.0, -14.1), (26.0, -14.0)]
    hole = [(26.02, -14.02), (26.02, -14.08), (26.08, -14.08), (26.08, -14.02), (26.02, -14.02)]
    whole = spatial.ring_area_geodesic(ring(spark, [outer])).first().area_km2
    inner = spatial.ring_area_geodesic(ring(spark, [hole])).first().area_km2
    assert spatial.ring_area_geodesic(ring(spark, [outer, hole])).first().area_km2 == pytest.approx(whole - inner)
