"""Incremental refresh: what a load changes, and that nothing else is touched."""

import os
import random
import tempfile

import pytest
from pyspark.sql import functions as F

from veldcube.functions import fixed
from veldcube.operators import annual, monthly
from veldcube.sources import dims, products
from veldcube.streaming import refresh, state


@pytest.fixture
def folder():
    return tempfile.mkdtemp(prefix="spark-test-", dir="/tmp")


@pytest.fixture(scope="module")
def grid(spark):
    return dims.grid_dim(spark, {**dims.BLOCK_GRID, "n_rows": 2, "n_cols": 3})


@pytest.fixture(scope="module")
def layers(spark):
    rows = [(r, c, fixed.LAND_COVER[k]) for k, (r, c) in enumerate([(0, 0), (0, 1), (1, 0), (1, 1)])] + [(0, 0, fixed.LAND_COVER[1])]
    cells = spark.createDataFrame(rows, "row_idx int, col_idx int, land_cover string")
    return refresh.Layers(cells, dims.aoi_classes(spark), dims.phenology_profiles(spark))


def month(rng, aoi, year, m, burned=False, cells=((0, 0), (0, 1), (0, 2), (1, 0), (1, 1), (1, 2))):
    value = (lambda: rng.choice([0, 0, m * 28])) if burned else (lambda: None if rng.random() < 0.15 else round(rng.uniform(-0.2, 0.9), 3))
    return [(r, c, value(), aoi, "burned_area" if burned else "s2", 500, year, m) for r, c in cells]


def files(root):
    out = {}
    for where, _, names in os.walk(root):
        for n in names:
            if n.endswith(".parquet"):
                out[os.path.relpath(f"{where}/{n}", root)] = os.stat(f"{where}/{n}").st_mtime_ns
    return out


def same(a, b, keys):
    """Equal rows, doubles to nine digits."""
    key = lambda row: tuple(str(row[k]) for k in keys)
    left, right = {key(r): r.asDict() for r in a.collect()}, {key(r): r.asDict() for r in b.collect()}
    assert left.keys() == right.keys()
    for k, row in right.items():
        assert left[k].keys() == row.keys()
        for c, v in row.items():
            assert left[k][c] == (pytest.approx(v, abs=1e-9) if isinstance(v, float) else v), (k, c)


def test_vegetation_products_equal_a_full_recomputation(spark, folder, grid, layers):
    rng = random.Random(8)
    first = [x for y in (2000, 2001) for m in range(1, 13) for x in month(rng, "ASIA", y, m)]
    half = ((0, 1), (1, 0), (1, 2))
    again = month(rng, "ASIA", 2001, 7, cells=half) + [x for m in range(1, 13) for x in month(rng, "ASIA", 2002, m)] + month(rng, "AFRICA", 2002, 12)
    root = f"{folder}/out"
    for rows in (first, again):
        spark.createDataFrame(rows, refresh.CELLS).write.mode("append").parquet(f"{folder}/in")
        refresh.run_refresh(spark, f"{folder}/in", root, f"{folder}/marks", grid, 0, layers)
    merged = {(x[0], x[1], *x[3:]): x for x in [*first, *again]}
    cells = spark.createDataFrame(list(merged.values()), refresh.CELLS)
    by_class = monthly.ndvi_monthly_by_class(cells, layers.class_cells, layers.classes)
    baselines = monthly.class_baselines(by_class)
    table = monthly.ndvi_monthly(cells)
    years = monthly.ndvi_annual(table)
    series = ["aoi", "sensor", "resolution"]
    stored = lambda name, schema: products.scan_product(spark, root, name, schema)
    same(stored("ndvi_monthly", refresh.MONTHLY), table, [*series, "year", "month"])
    same(stored("ndvi_monthly_by_class", refresh.BY_CLASS), by_class, [*series, "year", "month", "land_cover"])
    same(stored("ndvi_monthly_baselines_by_class", refresh.CLASS_BASELINES), baselines, [*series, "month", "land_cover"])
    anomaly = monthly.ndvi_anomaly_monthly(by_class, baselines)
    same(stored("ndvi_anomaly_monthly", refresh.ANOMALY), anomaly, [*series, "year", "month", "land_cover"])
    same(stored("ndvi_anomaly_resilience", refresh.RESILIENCE), annual.anomaly_resilience(anomaly, baselines), [*series, "anomaly_year", "land_cover"])
    same(stored("ndvi_phenology", refresh.PHENOLOGY), annual.ndvi_phenology(by_class, layers.profiles), [*series, "year", "land_cover"])
    delta = annual.ndvi_annual_delta(annual.annual_cell_mean(cells, years), years, grid)
    same(stored("ndvi_annual_delta", refresh.DELTA), delta, [*series, "year_a", "year_b"])


def test_burned_products_equal_a_full_recomputation(spark, folder, grid):
    rng = random.Random(9)
    first = [x for y in (2000, 2001) for m in range(1, 13) for x in month(rng, "ASIA", y, m, burned=True)]
    # June of 2001 comes again without a fire, two cells of May with one.
    again = [(*x[:2], 0, *x[3:]) for x in month(rng, "ASIA", 2001, 6, burned=True)]
    again += [(0, 2, 140, "ASIA", "burned_area", 500, 2001, 5), (1, 2, 141, "ASIA", "burned_area", 500, 2001, 5)]
    again += [x for m in range(1, 13) for x in month(rng, "ASIA", 2002, m, burned=True)]
    root = f"{folder}/out"
    for rows in (first, again):
        spark.createDataFrame(rows, refresh.BURNS).write.mode("append").parquet(f"{folder}/in")
        refresh.run_burned_refresh(spark, f"{folder}/in", root, f"{folder}/marks", grid)
    merged = {(x[0], x[1], *x[3:]): x for x in [*first, *again]}
    burns = spark.createDataFrame(list(merged.values()), refresh.BURNS)
    same(products.scan_product(spark, root, "ba_monthly", refresh.BA_MONTHLY), monthly.ba_monthly(burns, grid), ["aoi", "resolution", "year", "month"])
    daily = lambda df: df.groupBy("aoi", "resolution", "year", "date").agg(F.sum("burned_km2").alias("burned_km2"))
    same(daily(refresh.ba_daily(spark, root)), daily(monthly.ba_daily(burns)), ["aoi", "year", "date"])
    frp = annual.fire_return_period(annual.burn_count(burns))
    same(products.scan_product(spark, root, "fire_return_period", refresh.FRP), frp, ["aoi", "row_idx", "col_idx"])


def test_only_touched_partitions_are_written(spark, folder, grid, layers):
    rng = random.Random(10)
    rows = [x for aoi in ("ASIA", "AFRICA") for y in (2000, 2001) for m in (1, 2) for x in month(rng, aoi, y, m)]
    root = f"{folder}/out"
    refresh.refresh_monthly(spark, root, spark.createDataFrame(rows, refresh.CELLS), grid, layers, "a")
    before = files(root)
    refresh.refresh_monthly(spark, root, spark.createDataFrame(month(rng, "ASIA", 2001, 2), refresh.CELLS), grid, layers, "b")
    after = files(root)
    changed = {os.path.dirname(f) for f in before.keys() ^ after.keys()} | {os.path.dirname(f) for f in before.keys() & after.keys() if before[f] != after[f]}
    assert changed and all("aoi=ASIA" in d for d in changed if "aoi=" in d)
    assert {d for d in changed if "aoi=" not in d} == {"annual_pending"}
    assert all("year=2001" in d for d in changed if "year=" in d)
    assert {d.split("/")[-1] for d in changed if d.startswith("cell_month")} == {"month=2"}
    assert {d.split("/")[0] for d in changed if "year=" in d} >= {"cell_month", "ndvi_monthly", "ndvi_monthly_by_class", "state_cell_year", "state_class_month", "state_month"}


def test_load_that_failed_half_way_is_applied_once(spark, folder, grid, layers, monkeypatch):
    rng = random.Random(11)
    root = f"{folder}/out"
    make = lambda rows: spark.createDataFrame(rows, refresh.CELLS)
    old, new = month(rng, "ASIA", 2000, 1) + month(rng, "ASIA", 2000, 2), month(rng, "ASIA", 2000, 2)
    refresh.refresh_monthly(spark, root, make(old), grid, layers, "a")
    write = state.Table.write

    def fail(self, rows, where):
        write(self, rows, where)
        if self.name == "state_cell_year":
            raise RuntimeError("lost")

    monkeypatch.setattr(state.Table, "write", fail)
    with pytest.raises(RuntimeError, match="lost"):
        refresh.refresh_monthly(spark, root, make(new), grid, layers, "b")
    monkeypatch.setattr(state.Table, "write", write)
    for _ in range(2):
        refresh.refresh_monthly(spark, root, make(new), grid, layers, "b")
    cells = make(old[:6] + new)
    same(products.scan_product(spark, root, "ndvi_monthly", refresh.MONTHLY), monthly.ndvi_monthly(cells), ["aoi", "year", "month"])
    got = {(r.row_idx, r.col_idx): (r.rows, r.n, r.total) for r in state.CELL_YEAR.scan(spark, root).collect()}
    want = {}
    for r, c, v, *_ in old[:6] + new:
        k, n, t = want.get((r, c), (0, 0, 0.0))
        want[(r, c)] = (k + 1, n + (v is not None), t + (v or 0.0))
    assert {k: (a, b, round(float(t), 9)) for k, (a, b, t) in got.items()} == {k: (a, b, round(t, 9)) for k, (a, b, t) in want.items()}


def test_bad_tiles_leave_the_state_alone(spark, folder, grid, layers):
    root = f"{folder}/out"
    rng = random.Random(12)
    refresh.refresh_monthly(spark, root, spark.createDataFrame(month(rng, "ASIA", 2000, 1), refresh.CELLS), grid, layers, "a")
    before = state.CLASS_MONTH.scan(spark, root).drop("applied").collect()
    bad = [(0, 0, 7.0, "ASIA", "s2", 500, 2000, 1), (0, 1, 0.5, "ASIA", "s2", 500, 2000, 1)]
    refresh.refresh_monthly(spark, root, spark.createDataFrame(bad, refresh.CELLS), grid, layers, "b")
    assert sorted(state.CLASS_MONTH.scan(spark, root).drop("applied").collect(), key=str) == sorted(before, key=str)


def test_later_file_wins_within_a_load(spark, folder, grid):
    rows = [(0, 0, 0.1, 1), (0, 0, 0.7, 2), (0, 1, 0.3, 1)]
    batch = spark.createDataFrame([(r, c, v, "ASIA", "s2", 500, 2000, 1, t) for r, c, v, t in rows], refresh.CELLS + ", arrived int")
    refresh.refresh_monthly(spark, f"{folder}/out", batch, grid, None, "a")
    cells = products.scan_product(spark, f"{folder}/out", "cell_month", refresh.CELLS)
    assert {(r.row_idx, r.col_idx): r.value for r in cells.collect()} == {(0, 0): 0.7, (0, 1): 0.3}
