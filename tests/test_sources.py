import datetime
import json
import tempfile

import pytest
from pyspark.sql import functions as F

from veldcube.operators import incremental, quality
from veldcube.sources import adapter, dims, geojson, products, tiles
from veldcube.streaming import refresh


@pytest.fixture
def folder():
    return tempfile.mkdtemp(prefix="spark-test-", dir="/tmp")


def test_geojson_collection_with_multipolygon(spark, folder):
    square = [[0.0, 0.0], [1.0, 0.0], [1.0, 1.0], [0.0, 0.0]]
    doc = {"type": "FeatureCollection", "features": [
        {"type": "Feature", "properties": {"n": 1}, "geometry": {"type": "Polygon", "coordinates": [square, square]}},
        {"type": "Feature", "properties": {}, "geometry": {"type": "MultiPolygon", "coordinates": [[square], [square]]}},
    ]}
    with open(f"{folder}/Area_One_Bare_ground_2023.geojson", "w") as f:
        json.dump(doc, f)
    v = geojson.read_geojson(spark, folder, r"Area_One_(.+)_\d{4}\.geojson$")
    assert v.count() == 16 and {r.layer for r in v.collect()} == {"Bare_ground"}
    assert {(r.polygon_id, r.part, r.ring_id) for r in v.collect()} == {(0, 0, 0), (0, 0, 1), (1, 0, 0), (1, 1, 0)}


def test_product_write_replaces_only_its_partitions(spark, folder):
    schema = "year int, v double, aoi string, sensor string, resolution int"
    make = lambda rows: spark.createDataFrame(rows, schema)
    assert products.write_product(make([(2000, 1.0, "A", "s", 1), (2000, 2.0, "B", "s", 1)]), folder, "t")
    assert products.write_product(make([(2001, 3.0, "B", "s", 1)]), folder, "t")
    assert not products.write_product(make([]), folder, "t")
    got = sorted((r.aoi, r.year, r.v) for r in products.scan_product(spark, folder, "t", schema).collect())
    assert got == [("A", 2000, 1.0), ("B", 2001, 3.0)]
    only = products.scan_product(spark, folder, "t", schema, aoi="A", columns=["v"])
    plan = only._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(aoi" in plan and only.columns == ["v"]
    assert products.scan_product(spark, folder, "missing", schema).count() == 0


def test_run_log_appends(spark, folder):
    row = lambda t, e: [(t, 1, True, False, 0, False, "success", e)]
    for t in (datetime.datetime(2026, 6, 1, 12), datetime.datetime(2026, 6, 2, 12)):
        products.append_run_log(spark.createDataFrame(row(t, None), products.RUN_LOG), f"{folder}/log")
    log = products.scan_run_log(spark, f"{folder}/log")
    assert log.count() == 2 and log.where("error_message IS NULL").count() == 2


def test_tile_names(spark):
    df = spark.createDataFrame([("/a/2024-03_NDVI_X.tif",), ("/a/2024-12_BurnedArea_X.tif",), ("/a/202403_NDVI_X.tif",), ("/2024-01_a/readme.txt",)], "path string")
    got = [(r.year, r.month, r.kind) for r in tiles.parse_tile_name(df).collect()]
    assert got == [(2024, 3, "NDVI"), (2024, 12, "BurnedArea")]


def test_scan_tiles_reads_month_from_the_file_name(spark, folder):
    import pyarrow as pa
    import pyarrow.parquet as pq
    pq.write_table(pa.table({"row0": [0], "col0": [0], "nodata": [-1.0], "values": [[[0.5, -1.0], [float("nan"), 2e7]]]}), f"{folder}/2024-03_NDVI_A.parquet")
    cells = tiles.explode_tiles(tiles.scan_tiles(spark, folder), ["year", "month", "kind"])
    got = {(r.row_idx, r.col_idx): r.value for r in cells.collect()}
    assert got == {(0, 0): 0.5, (0, 1): None, (1, 0): None, (1, 1): None} and cells.first().month == 3


def test_month_spine_and_missing(spark):
    d = datetime.date
    df = spark.createDataFrame([("a", d(1999, 11, 20), d(2000, 2, 1)), ("b", d(2000, 3, 1), d(2000, 2, 1))], "k string, start date, end date")
    assert [(r.k, r.year, r.month) for r in incremental.month_spine(df).collect()] == [("a", 1999, 11), ("a", 1999, 12), ("a", 2000, 1), ("a", 2000, 2)]
    have = spark.createDataFrame([("A", "s", 1, 2000, 12), ("A", "s", 1, 2000, 3)], "aoi string, sensor string, resolution int, year int, month int")
    latest = incremental.latest_month(have)
    assert (latest.first().year, latest.first().month) == (2000, 12)
    ends = spark.createDataFrame([("s", 2001, 2), ("t", 2001, 2)], "sensor string, end_year int, end_month int")
    assert [(r.year, r.month) for r in incremental.missing_months(latest, ends).collect()] == [(2001, 1), (2001, 2)]


def test_complete_year_needs_every_series(spark):
    cols = "aoi string, sensor string, resolution int, year int, month int"
    t = spark.createDataFrame([("A", "s", 1, 2000, 12), ("B", "s", 1, 2000, 12), ("A", "s", 1, 2001, 12), ("B", "s", 1, 2001, 11)], cols)
    combos = t.select("aoi", "sensor", "resolution").distinct()
    years = incremental.complete_years(t, combos)
    assert [r.year for r in years.collect()] == [2000]
    log = lambda y: spark.createDataFrame([(True, y), (False, 2050)], "pass_b_ran boolean, new_year_detected int")
    assert [r.year for r in incremental.new_complete_year(years, log(1999)).collect()] == [2000]
    assert incremental.new_complete_year(years, log(2000)).count() == 0


def test_schema_check(spark):
    df = spark.createDataFrame([("A", "s", 1, 2000, 1, "0.3")], "aoi string, sensor string, resolution int, year int, month int, mean_ndvi string")
    got = {(r.check, r.severity, r.detail) for r in quality.check_schema(spark, {"ndvi_monthly": df}).collect()}
    assert got == {("schema_columns", "fail", "n_valid_px"), ("schema_dtype", "warn", "mean_ndvi: string")}


def test_stream_refresh_is_incremental_and_repeatable(spark, folder):
    grid = dims.grid_dim(spark, {**dims.BLOCK_GRID, "n_rows": 1, "n_cols": 2})
    schema = refresh.CELLS

    def land(rows):
        spark.createDataFrame(rows, schema).write.mode("append").parquet(f"{folder}/in")

    def month(year, m, a, b=0.5):
        return [(0, 0, a, "ASIA", "s2", 500, year, m), (0, 1, b, "ASIA", "s2", 500, year, m)]

    def run(last=0):
        return refresh.run_refresh(spark, f"{folder}/in", f"{folder}/out", f"{folder}/marks", grid, last)

    def means():
        t = products.scan_product(spark, f"{folder}/out", "ndvi_monthly", refresh.MONTHLY)
        return {(r.year, r.month): round(r.mean_ndvi, 6) for r in t.collect()}

    land([r for m in range(1, 12) for r in month(2000, m, 0.1)])
    assert run() is None and len(means()) == 11
    # December completes the year; a tile out of range is left out; March is delivered again.
    land(month(2000, 12, 0.3) + month(2001, 1, 7.0) + month(2000, 3, 0.9))
    assert run() == 2000
    got = means()
    assert len(got) == 12 and got[(2000, 3)] == 0.7 and got[(2000, 12)] == 0.4 and got[(2000, 1)] == 0.3
    # Nothing new arrives: nothing changes.
    assert run(2000) is None and means() == got
    annual = products.scan_product(spark, f"{folder}/out", "ndvi_annual", "year int, mean_ndvi double, n_months int, is_complete boolean, aoi string, sensor string, resolution int")
    assert [(r.year, r.n_months, r.is_complete) for r in annual.collect()] == [(2000, 12, True)]


def test_month_that_arrives_in_two_runs_keeps_all_cells(spark, folder):
    grid = dims.grid_dim(spark, {**dims.BLOCK_GRID, "n_rows": 2, "n_cols": 2})
    for part in ([(0, 0, 0.1), (1, 1, 0.1)], [(0, 1, 0.5), (1, 0, 0.5), (1, 1, 0.3)]):
        rows = [(r, c, v, "ASIA", "s2", 500, 2000, 1) for r, c, v in part]
        spark.createDataFrame(rows, refresh.CELLS).write.mode("append").parquet(f"{folder}/in")
        refresh.run_refresh(spark, f"{folder}/in", f"{folder}/out", f"{folder}/marks", grid)
    cells = products.scan_product(spark, f"{folder}/out", "cell_month", refresh.CELLS)
    assert {(r.row_idx, r.col_idx): r.value for r in cells.collect()} == {(0, 0): 0.1, (0, 1): 0.5, (1, 0): 0.5, (1, 1): 0.3}
    monthly = products.scan_product(spark, f"{folder}/out", "ndvi_monthly", refresh.MONTHLY).collect()
    assert [(round(r.mean_ndvi, 6), r.n_valid_px) for r in monthly] == [(0.35, 4)]
    log = products.scan_run_log(spark, f"{folder}/out/run_log").orderBy("run_timestamp").collect()
    assert [(r.new_months_fetched, r.status) for r in log] == [(1, "success"), (0, "success")]


def test_strip_grid_follows_the_keys(spark):
    keys = spark.createDataFrame([(k,) for k in (0, 63, 64, 1_279_999, 1_280_000, 5_000_000)], "k long")
    row, col = adapter.strip_cell(keys.k, F.lit(7))
    cells = keys.select("k", row.alias("r"), col.alias("c")).collect()
    grid = adapter.strip_grid(dims.grid_dim(spark, dims.STRIP_GRID), keys, "k").first()
    assert all(0 <= x.c < grid.n_cols and 0 <= x.r < grid.n_rows for x in cells)
    # A strip ends in an empty column, so that its last column does not touch the next strip.
    assert {x.k: x.c for x in cells}[1_280_000] - {x.k: x.c for x in cells}[1_279_999] == 9
    few = adapter.strip_grid(dims.grid_dim(spark, dims.STRIP_GRID), keys.where("k < 100"), "k").first()
    assert few.n_cols == 8 and few.dx == 0.0005
    far = adapter.strip_grid(dims.grid_dim(spark, dims.STRIP_GRID), spark.range(1).selectExpr("10000000000000 k"), "k").first()
    assert far.n_cols * far.dx <= 6.0 + 1e-9


def test_queries_fold_strips_as_their_sql_does(spark, sf_dir, tmp_path):
    import duckdb

    import __spark_entry__ as entry
    db = duckdb.connect()
    for name in ("region", "nation", "customer", "orders", "lineitem"):
        key = {"orders": "o_orderkey", "lineitem": "l_orderkey"}.get(name)
        again = f" UNION ALL SELECT * REPLACE ({key} + 1280000 AS {key}) FROM '{sf_dir}/{name}.parquet'" if key else ""
        db.execute(f"COPY (SELECT * FROM '{sf_dir}/{name}.parquet'{again}) TO '{tmp_path}/{name}.parquet' (FORMAT parquet)")
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{tmp_path}/{name}.parquet'")
    for query in ("g9_ring_area_geodesic", "v19_sample_spaced"):
        got = entry.queries()[query](spark, str(tmp_path))
        want = db.execute(f"SELECT {', '.join(got.columns)} FROM ({entry.oracle_sql()[query]})").fetchall()
        assert len(want) > 0
        assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, want))
