"""Sources and sinks as named queries. Written data goes below the session's checkpoint folder, which
every executor can reach, and is read back from there."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from veldcube.functions.session import ensure_checkpoint_dir
from veldcube.operators import patches, quality
from veldcube.plans.registry import query
from veldcube.sources import adapter, collections, geojson, products, tiles
from veldcube.streaming import refresh

S = "aoi, sensor, resolution"
SY = f"{S}, year, month"
KEY = ["aoi", "sensor", "resolution"]
MONTH = [*KEY, "year", "month"]


def shared_folder(c, name: str) -> str:
    ensure_checkpoint_dir(c.spark)
    return f"{c.spark.sparkContext.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"


@query("s2_explode_tiles", f"""SELECT {SY}, d.row_idx, d.col_idx, value FROM (SELECT DISTINCT {SY} FROM cells)
CROSS JOIN (SELECT row_idx, col_idx FROM grid_cells) d LEFT JOIN cells USING ({SY}, row_idx, col_idx)""", "value")
def _(c):
    return tiles.explode_tiles(tiles.implode_tiles(c.cells, MONTH, c.grid), MONTH)


@query("s3_parse_tile_name", """SELECT o_orderkey, CAST(year(o_orderdate) AS INT) AS year, CAST(month(o_orderdate) AS INT) AS month,
CASE WHEN o_orderstatus = 'F' THEN 'BurnedArea' ELSE 'NDVI' END AS kind FROM orders WHERE o_custkey % 10 <> 0""")
def _(c):
    o = adapter.read_table(c.spark, c.sf_dir, "orders")
    kind = F.when(F.col("o_orderstatus") == "F", "BurnedArea").otherwise("NDVI")
    stamp = F.when(F.col("o_custkey") % 10 != 0, F.date_format("o_orderdate", "yyyy-MM")).otherwise(F.date_format("o_orderdate", "yyyyMM"))
    paths = o.select("o_orderkey", F.concat(F.lit("/tiles/a/500m/"), stamp, F.lit("_"), kind, F.lit("_AREA.tif")).alias("path"))
    return tiles.parse_tile_name(paths).drop("path")


#: Outer ring and hole of the rectangle of a row, as shares of its width and height.
RINGS = [[(0, 0), (1, 0), (1, 1), (0, 1), (0, 0)], [(0.25, 0.25), (0.25, 0.75), (0.75, 0.75), (0.75, 0.25), (0.25, 0.25)]]


@query("s4_read_geojson", "SELECT aoi, CASE WHEN polygon_id % 3 = 0 THEN 'Crops' ELSE 'Bare_ground' END AS land_cover, polygon_id // 2 AS pair, "
       "CASE WHEN polygon_id % 2 = 1 AND twice THEN 1 ELSE 0 END AS part, ring_id, seq, lon, lat FROM ("
       + " UNION ALL ".join(
           f"SELECT aoi, polygon_id, count(*) OVER (PARTITION BY aoi, polygon_id // 2, polygon_id % 3 = 0) = 2 AS twice, {k} AS ring_id, {i} AS seq, "
           f"x0 + {x} * (x1 - x0) AS lon, y0 + {y} * (y1 - y0) AS lat FROM row_extents"
           for k, ring in enumerate(RINGS) for i, (x, y) in enumerate(ring)) + ")", "lon lat")
def _(c):
    # Rows two by two are multipolygons with holes, in collections named after area and class; written and read back.
    folder = shared_folder(c, "collections")
    box = c.row_extents.groupBy("aoi", "polygon_id").agg(F.min("lon").alias("x0"), F.max("lon").alias("x1"), F.max("lat").alias("y0"), F.min("lat").alias("y1"))
    corners = F.array(*[
        F.struct(F.lit(k).alias("ring_id"), F.lit(i).alias("seq"), (F.col("x0") + x * (F.col("x1") - F.col("x0"))).alias("lon"),
                 (F.col("y0") + y * (F.col("y1") - F.col("y0"))).alias("lat"))
        for k, ring in enumerate(RINGS) for i, (x, y) in enumerate(ring)])
    named = F.when(F.col("polygon_id") % 3 == 0, "Crops").otherwise("Bare_ground").alias("land_cover")
    vertices = box.select("aoi", named, F.floor(F.col("polygon_id") / 2).alias("pair"), (F.col("polygon_id") % 2).alias("part"), F.explode(corners).alias("p"))
    shapes = collections.shape_features(vertices.select("aoi", "land_cover", "pair", "part", "p.*"), ["aoi", "land_cover", "pair"], ["aoi", "pair"])
    collections.write_collections(shapes, folder, F.concat_ws("_", "aoi", "land_cover", F.lit("2023.geojson")), parts=4)
    back = collections.read_collections(c.spark, folder)
    return back.select(F.col("properties")["aoi"].alias("aoi"), F.col("layer").alias("land_cover"), F.col("properties")["pair"].cast("long").alias("pair"),
                       "part", "ring_id", "seq", "lon", "lat")


@query("s5_write_product", "a1", "mean_ndvi")
def _(c):
    root = shared_folder(c, "product")
    products.write_product(c.monthly, root, "ndvi_monthly")
    return products.scan_product(c.spark, root, "ndvi_monthly", refresh.MONTHLY)


@query("s6_scan_product", "SELECT year, month, mean_ndvi FROM a1 WHERE aoi = 'ASIA' AND sensor = 'sentinel2'", "mean_ndvi")
def _(c):
    root = shared_folder(c, "product")
    products.write_product(c.monthly, root, "ndvi_monthly")
    return products.scan_product(
        c.spark, root, "ndvi_monthly", refresh.MONTHLY, aoi="ASIA", sensor="sentinel2", columns=["year", "month", "mean_ndvi"]
    )


@query("s7_write_features", """SELECT aoi, component_id, frp_years FROM frp_patches""", "frp_years")
def _(c):
    folder = shared_folder(c, "patches")
    vertices = patches.ring_vertices(c.frp_outline, ["aoi"], c.strip_grid)
    props = c.frp_components.groupBy("aoi", "component_id").agg(F.max("value").alias("frp_years"), F.max("component_id").alias("patch"))
    geojson.write_features(patches.patch_features(vertices, ["aoi"], props).select("feature"), folder)
    back = geojson.read_feature_lines(c.spark, folder, "patch")
    return back.where("ring_id = 0 AND seq = 0").select(
        F.col("properties")["aoi"].alias("aoi"), F.col("polygon_id").cast("long").alias("component_id"),
        F.col("properties")["frp_years"].cast("double").alias("frp_years"),
    )


@query("s8_run_log", """SELECT CAST(run_timestamp AS VARCHAR) AS run_timestamp, new_months_fetched, pass_a_ran, pass_b_ran, new_year_detected,
false AS deploy_ran, status, error_message FROM run_log""")
def _(c):
    folder = shared_folder(c, "log")
    log = adapter.run_log(c.spark, c.sf_dir)
    products.append_run_log(log.where("pass_a_ran"), folder)
    products.append_run_log(log.where("NOT pass_a_ran"), folder)
    return products.scan_run_log(c.spark, folder).withColumn("run_timestamp", F.col("run_timestamp").cast("string"))


@query("k1_check_schema", """SELECT table_name, 0 AS n_issues, n_rows FROM (
SELECT 'ndvi_monthly' AS table_name, count(*) AS n_rows FROM a1 UNION ALL SELECT 'ndvi_monthly_by_class', count(*) FROM a7
UNION ALL SELECT 'ba_monthly', count(*) FROM a9 UNION ALL SELECT 'ba_daily', count(*) FROM a10 UNION ALL SELECT 'ndvi_anomaly_monthly', count(*) FROM a11)""")
def _(c):
    made = c.products
    issues = quality.check_schema(c.spark, made).groupBy("table_name").agg(F.count(F.lit(1)).alias("n"))
    rows = None
    for name, df in made.items():
        one = df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("table_name", F.lit(name))
        rows = one if rows is None else rows.unionByName(one)
    return rows.join(issues, "table_name", "left").select("table_name", F.coalesce("n", F.lit(0)).cast("int").alias("n_issues"), "n_rows")
