import math
import random

import numpy as np
import pytest

from veldcube.operators import distance


def frame(spark, cells, group="X"):
    return spark.createDataFrame([(group, r, c) for r, c in cells], "aoi string, row_idx int, col_idx int")


def compare(spark, cells, targets):
    got = distance.distance_to_nearest(frame(spark, cells), frame(spark, targets), ["aoi"]).collect()
    assert len(got) == len(set(cells))
    for r in got:
        assert r.distance == pytest.approx(min(math.dist((r.row_idx, r.col_idx), t) for t in targets), abs=1e-12)


def test_equals_brute_force_in_chunks(spark, monkeypatch):
    monkeypatch.setattr(distance, "CHUNK_POSITIONS", 700)
    rng = random.Random(6)
    block = [(r, c) for r in range(40, 52) for c in range(40, 52)]
    compare(spark, [(rng.randrange(400), rng.randrange(400)) for _ in range(120)] + [(45, 45), (0, 1), (0, 1)], [(0, 0), (3, 300), *block])


def test_dense_targets_far_from_dense_cells(spark):
    cells = [(r, c) for r in range(30) for c in range(30)]
    compare(spark, cells, [(r, c) for r in range(100, 130) for c in range(200, 230)] + [(-70, 4), (15, -60)])


def test_narrow_grids_are_turned(spark, monkeypatch):
    monkeypatch.setattr(distance, "CHUNK_ROWS", 8)
    rng = random.Random(7)
    tall = [(rng.randrange(5000), rng.randrange(4)) for _ in range(150)]
    compare(spark, [(r, c + 1) for r, c in tall[:60]], tall[60:])
    compare(spark, [(c, r) for r, c in tall[:60]], [(c, r) for r, c in tall[60:]])


def test_groups_with_and_without_targets(spark):
    cells = frame(spark, [(5, 5), (6, 9)], "none").unionByName(frame(spark, [(1, 1)], "X"))
    got = {(r.aoi, r.row_idx): r.distance for r in distance.distance_to_nearest(cells, frame(spark, [(1, 4), (9, 9)]), ["aoi"]).collect()}
    assert got == {("none", 5): None, ("none", 6): None, ("X", 1): 3.0}
    assert distance.distance_to_nearest(frame(spark, []), frame(spark, [(1, 1)]), ["aoi"]).count() == 0
    lonely = distance.distance_to_nearest(frame(spark, [(2, 2)]), frame(spark, []), ["aoi"]).collect()
    assert [r.distance for r in lonely] == [None]


def test_envelopes_in_lockstep():
    rng = np.random.default_rng(3)
    columns = np.sort(rng.choice(500, 60, replace=False))
    along = rng.integers(0, 40, (25, 60))
    x, row = rng.integers(-50, 550, 900), rng.integers(0, 25, 900)
    got = distance.row_distances(columns, along, row, x)
    want = np.sqrt(((x[:, None] - columns) ** 2 + along[row] ** 2).min(1))
    assert np.array_equal(got, want)


def test_rows_moved_do_not_follow_pairs(spark):
    """A quarter of a million cell-target pairs: no step makes more rows than cells, targets and positions by chunk."""
    cells, targets = [(r, c) for r in range(20) for c in range(25)], [(r + 300, c) for r in range(20) for c in range(25)]
    out = distance.distance_to_nearest(frame(spark, cells), frame(spark, targets), ["aoi"])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "FlatMapCoGroupsInArrow" in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan
    assert out.count() == 500
