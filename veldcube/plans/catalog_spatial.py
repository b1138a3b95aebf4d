"""Spatial operators and patches as named queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from veldcube.functions import columns, fixed
from veldcube.operators import distance, patches, spatial, topology, views
from veldcube.plans.oracle import STRIP_ROW_AREA, edge_term, rings_sql
from veldcube.plans.registry import query
from veldcube.sources import dims

S = "aoi, sensor, resolution"
SY = f"{S}, year, month"
CELL = "row_idx, col_idx"


@query("g1_cell_centres", f"""SELECT aoi, year, month, {CELL}, value, round(26.0 + (col_idx + 0.5::DOUBLE) * 0.005::DOUBLE, 6) AS lon,
round(-14.0 + (row_idx + 0.5::DOUBLE) * (-0.005::DOUBLE), 6) AS lat FROM cells""", "value lon lat")
def _(c):
    return spatial.cell_centres(c.cells, c.grid).select("aoi", "year", "month", "row_idx", "col_idx", "value", "lon", "lat")


@query("g2_mask_polygon", f"SELECT * FROM cells SEMI JOIN (SELECT {CELL} FROM inside WHERE layer = 'aoi') USING ({CELL})", "value")
def _(c):
    return spatial.mask_polygon(c.cells, c.aoi_spans)


@query("g2_mask_overlapping_polygons", f"SELECT * FROM cells SEMI JOIN (SELECT {CELL} FROM inside WHERE layer <> 'aoi') USING ({CELL})", "value")
def _(c):
    return spatial.mask_polygon(c.cells, c.class_spans)


@query("q10_monthly_grid", f"""SELECT * FROM cells SEMI JOIN (SELECT {CELL} FROM inside WHERE layer = 'aoi') USING ({CELL})
WHERE year = 1998 AND month = 7""", "value")
def _(c):
    return spatial.mask_polygon(views.monthly_grid(c.cells, 1998, 7), c.aoi_spans)


@query("g3_mask_polygon_all_touched", f"SELECT * FROM cells SEMI JOIN (SELECT {CELL} FROM touched WHERE layer = 'Rangeland') USING ({CELL})", "value")
def _(c):
    return spatial.mask_polygon_all_touched(c.cells, c.edges.where("layer = 'Rangeland'"), c.grid)


@query("g4_mask_two_level", f"""SELECT cells.*, layer AS land_cover FROM cells JOIN inside USING ({CELL})
SEMI JOIN (SELECT {CELL} FROM inside WHERE layer = 'aoi') USING ({CELL}) WHERE layer <> 'aoi'""", "value")
def _(c):
    return spatial.mask_two_level(c.cells, c.aoi_spans, c.class_spans)


@query("g5_outside_fill_float", f"""SELECT {SY}, {CELL}, CASE WHEN layer IS NOT NULL THEN value END AS value
FROM cells LEFT JOIN (SELECT * FROM inside WHERE layer = 'aoi') USING ({CELL})""", "value")
def _(c):
    return spatial.outside_fill(c.cells, c.aoi_spans, "value", integer=False)


@query("g5_outside_fill_integer", f"""SELECT {SY}, {CELL}, CASE WHEN layer IS NOT NULL THEN burn_date ELSE 0 END AS burn_date
FROM burns LEFT JOIN (SELECT * FROM inside WHERE layer = 'aoi') USING ({CELL})""")
def _(c):
    key = ["aoi", "sensor", "resolution", "year", "month", "row_idx", "col_idx"]
    return spatial.outside_fill(c.burns.select(*key, "burn_date"), c.aoi_spans, "burn_date", integer=True)


@query("g6_cell_area_geodesic", f"SELECT DISTINCT aoi, row_idx, 1000 * ({STRIP_ROW_AREA}) AS area_km2_e3 FROM strip_new", "area_km2_e3")
def _(c):
    rows = c.strip_new.select("aoi", "row_idx").distinct().join(c.strip_grid, "aoi")
    area = columns.row_area(F.col("row_idx"), F.col("north"), F.col("dx"), F.col("dy"))
    return rows.select("aoi", "row_idx", (area * 1000).alias("area_km2_e3"))


@query("g7_cell_area_nominal", """SELECT aoi, year, sum((resolution / 1000) * (resolution / 1000)) AS burned_km2 FROM burns
WHERE burn_date > 0 GROUP BY ALL""", "burned_km2")
def _(c):
    return c.burns.where("burn_date > 0").groupBy("aoi", "year").agg(
        F.sum(columns.cell_area_nominal(F.col("resolution"))).alias("burned_km2")
    )


@query("g8_cell_area_approx", """SELECT aoi, year, count(*) * (0.005 * 111.32 * cos(radians(-14.0 + (-0.005) * 4)) * 0.005 * 111.32) AS burned_km2
FROM burns WHERE burn_date > 0 GROUP BY ALL""", "burned_km2")
def _(c):
    area = columns.cell_area_approx(F.col("dx"), F.col("dy"), F.col("north"), F.col("n_rows"))
    burned = c.burns.where("burn_date > 0").groupBy("aoi", "year").agg(F.count(F.lit(1)).alias("n"))
    return burned.join(c.grid, "aoi").select("aoi", "year", (F.col("n") * area).alias("burned_km2"))


_RECT = " + ".join(edge_term(*e) for e in (("x0", "y0", "x1", "y0"), ("x1", "y0", "x1", "y1"), ("x1", "y1", "x0", "y1"), ("x0", "y1", "x0", "y0")))


@query("g9_ring_area_geodesic", f"SELECT aoi, 'rows' AS layer, polygon_id, abs({_RECT}) AS area_km2 FROM row_extents", "area_km2")
def _(c):
    return spatial.ring_area_geodesic(c.row_extents)


@query("q18_aoi_area", f"SELECT aoi, sum(a) AS area_km2, count(*) AS n_features FROM (SELECT aoi, abs({_RECT}) AS a FROM row_extents) GROUP BY ALL", "area_km2")
def _(c):
    return spatial.ring_area_geodesic(c.row_extents).groupBy("aoi").agg(
        F.sum("area_km2").alias("area_km2"), F.count(F.lit(1)).alias("n_features")
    )


def _utm_sql() -> str:
    """Forward series over row_vertices, written out for SQL."""
    import math
    c = repr(2 * math.sqrt(columns._N) / (1 + columns._N))
    scale = repr(fixed.UTM_K0 * columns._RECT)
    x = " + ".join(["eta", *[f"{a!r} * cos({2 * j} * xi) * sinh({2 * j} * eta)" for j, a in enumerate(columns._ALPHA, 1)]])
    y = " + ".join(["xi", *[f"{a!r} * sin({2 * j} * xi) * cosh({2 * j} * eta)" for j, a in enumerate(columns._ALPHA, 1)]])
    return f"""SELECT aoi, polygon_id, seq, floor((500000 + {scale} * ({x})) * 1000 + 0.5) / 1000 AS east,
floor((10000000 + {scale} * ({y})) * 1000 + 0.5) / 1000 AS north, 0.0::DOUBLE AS lon_error, 0.0::DOUBLE AS lat_error FROM (
SELECT *, atan2(tau, cos(dl)) AS xi, atanh(sin(dl) / sqrt(1 + tau * tau)) AS eta FROM (
SELECT *, sinh(atanh(s) - {c} * atanh({c} * s)) AS tau FROM (
SELECT *, sin(radians(lat)) AS s, radians(lon - 27) AS dl FROM row_vertices)))"""


@query("g10_utm35s_round_trip", _utm_sql())
def _(c):
    east, north = columns.lonlat_to_utm35s(F.col("lon"), F.col("lat"))
    there = c.row_extents.withColumn("east", east).withColumn("north", north)
    lon, lat = columns.utm35s_to_lonlat(F.col("east"), F.col("north"))
    mm = lambda v: F.floor(v * 1000 + 0.5) / 1000
    return there.select(
        "aoi", "polygon_id", "seq", mm(F.col("east")).alias("east"), mm(F.col("north")).alias("north"),
        F.abs(lon - F.col("lon")).alias("lon_error"), F.abs(lat - F.col("lat")).alias("lat_error"),
    )


def _simplified(c):
    return topology.simplify_outlines(c.frp_outline, ["aoi"], c.strip_grid, fixed.SIMPLIFY_METRES)


@query("g11_simplify_rings")
def _(c):
    return _simplified(c).select("aoi", "component_id", "ring_id", "seq", "lon", "lat")


@query("g11_simplified_topology", "SELECT aoi, CAST(sum(n_rings) AS BIGINT) AS n_rings, 0 AS n_open, 0 AS n_foreign, 0 AS n_far, 0 AS n_crossing FROM frp_patches GROUP BY aoi")
def _(c):
    rings = patches.cut_lineage(_simplified(c))
    return topology.check_simplified(c.frp_outline, rings, ["aoi"], c.strip_grid, fixed.SIMPLIFY_METRES)


@query("g12_align_nearest", """SELECT t.aoi, t.resolution, t.row_idx, t.col_idx, src_row, src_col, value FROM (
SELECT aoi, 500 AS resolution, CAST(r.range AS INT) AS row_idx, CAST(c.range AS INT) AS col_idx,
CAST(floor((-14.0009::DOUBLE + (r.range + 0.5::DOUBLE) * (-0.004::DOUBLE) - (-14.0::DOUBLE)) / (-0.005::DOUBLE)) AS INT) AS src_row,
CAST(floor((26.0007::DOUBLE + (c.range + 0.5::DOUBLE) * 0.004::DOUBLE - 26.0::DOUBLE) / 0.005::DOUBLE) AS INT) AS src_col
FROM aois CROSS JOIN range(10) r CROSS JOIN range(10) c) t
LEFT JOIN (SELECT aoi, row_idx, col_idx, avg(value) AS value FROM cells GROUP BY ALL) s
ON t.aoi = s.aoi AND t.src_row = s.row_idx AND t.src_col = s.col_idx""", "value")
def _(c):
    means = c.cells.groupBy("aoi", "resolution", "row_idx", "col_idx").agg(F.avg("value").alias("value"))
    return spatial.align_nearest(means, c.grid, dims.grid_dim(c.spark, dims.SHIFTED_GRID))


@query("g13_connected_components", "SELECT aoi, row_idx, col_idx, value, component_id FROM frp_comp", "value")
def _(c):
    return c.frp_components


@query("g13_connected_components_8", "SELECT aoi, row_idx, col_idx, value, component_id FROM mark8", "value")
def _(c):
    marks = c.strip_new.where("burn_date > 0").withColumn("mark", F.lit(1.0))
    return patches.connected_components(marks, ["aoi"], "mark", 8)


@query("g14_dissolve_patches", f"""SELECT aoi, component_id, n_rings, length, n_cells AS area_cells FROM ({rings_sql('frp_comp', 'aoi')})
JOIN (SELECT aoi, component_id, CAST(count(*) AS DOUBLE) AS n_cells FROM frp_comp GROUP BY ALL) USING (aoi, component_id)""", "area_cells")
def _(c):
    return patches.ring_totals(c.frp_outline, ["aoi"]).groupBy("aoi", "component_id").agg(
        F.count(F.lit(1)).alias("n_rings"), F.sum("length").alias("length"), F.sum("area_cells").alias("area_cells")
    )


@query("g15_distance_to_nearest", "SELECT aoi, row_idx, col_idx, distance FROM distances", "distance")
def _(c):
    pairs = c.stored_strip_pairs
    return distance.distance_to_nearest(pairs.where("doy_new > 0"), pairs.where("doy_old > 0"), ["aoi"])


@query("g16_erode", """SELECT a.aoi, a.row_idx, a.col_idx, count(*) = 13 AS interior FROM strip_new a JOIN strip_new b
ON a.aoi = b.aoi AND abs(a.row_idx - b.row_idx) + abs(a.col_idx - b.col_idx) <= 2 GROUP BY ALL""")
def _(c):
    return spatial.erode(c.strip_new, ["aoi"], 2)


@query("g17_compare_grids", """SELECT aoi, a.r = b.r AND a.c = b.c AS match, CASE WHEN a.r = b.r AND a.c = b.c THEN '' ELSE 'shape, bbox' END AS differs_in
FROM (SELECT aoi, max(row_idx) AS r, max(col_idx) AS c FROM strip_new GROUP BY ALL) a
JOIN (SELECT aoi, max(row_idx) AS r, max(col_idx) AS c FROM strip_pairs WHERE doy_old > 0 GROUP BY ALL) b USING (aoi)""")
def _(c):
    def extent(cells):
        sizes = cells.groupBy("aoi").agg((F.max("row_idx") + 1).alias("n_rows"), (F.max("col_idx") + 1).alias("n_cols"))
        return c.strip_grid.drop("n_rows", "n_cols").join(sizes, "aoi")
    return spatial.compare_grids(extent(c.stored_strip_pairs), extent(c.stored_strip_pairs.where("doy_old > 0")))


@query("b16_frp_patches", "frp_patches", "frp_years area_km2")
def _(c):
    return c.frp_patches


@query("q17_ba_monthly_patches", f"""SELECT aoi, year, month, component_id, CAST(value AS INT) AS burn_date, n_cells, n_rings, n_cells * 0.25 AS area_km2 FROM (
SELECT aoi, year, month, component_id, value, count(*) AS n_cells FROM month_comp GROUP BY ALL)
JOIN ({rings_sql('month_comp', 'aoi, year, month')}) USING (aoi, year, month, component_id)""", "area_km2")
def _(c):
    key = ["aoi", "year", "month"]
    parts = patches.cut_lineage(patches.connected_components(c.burns.where("burn_date > 0"), key, "burn_date", 4))
    sizes = parts.groupBy(*key, "component_id").agg(F.max("value").cast("int").alias("burn_date"), F.count(F.lit(1)).alias("n_cells"))
    rings = patches.ring_totals(patches.patch_outline(parts, key), key).groupBy(*key, "component_id").agg(F.count(F.lit(1)).alias("n_rings"))
    return sizes.join(rings, [*key, "component_id"]).withColumn("area_km2", F.col("n_cells") * 0.25)


def _cover(c):
    """Outlines of land-cover patches: classes in 4 x 4 blocks over the observed strip cells."""
    index = (F.floor(F.col("row_idx") / 4) + F.floor(F.col("col_idx") / 4)) % len(fixed.LAND_COVER)
    parts = patches.cut_lineage(patches.connected_components(c.strip_new.withColumn("cover", index.cast("double")), ["aoi"], "cover", 4))
    names = F.array(*[F.lit(n) for n in fixed.LAND_COVER])
    classes = parts.groupBy("aoi", "component_id").agg(F.element_at(names, (F.max("value") + 1).cast("int")).alias("land_cover"))
    return patches.cut_lineage(patches.patch_outline(parts, ["aoi"])), classes


@query("q19_landcover_area", f"""SELECT aoi, component_id, land_cover, area * 100 AS area_ha, area / sum(area) OVER (PARTITION BY aoi) * 100 AS pct_of_study_area FROM (
SELECT aoi, component_id, value, sum({STRIP_ROW_AREA}) AS area FROM cover_comp GROUP BY ALL) JOIN classes ON value = class_no""", "area_ha pct_of_study_area")
def _(c):
    outline, classes = _cover(c)
    areas = patches.outline_area(outline, ["aoi"], c.strip_grid)
    return views.landcover_area(areas.join(classes, ["aoi", "component_id"]), areas.groupBy("aoi").agg(F.sum("area_km2").alias("aoi_km2")))


def _simplified_cover(c):
    outline, classes = _cover(c)
    kept = topology.simplify_outlines(outline, ["aoi"], c.strip_grid, fixed.SIMPLIFY_METRES)
    return outline, classes, patches.vertex_area(kept, ["aoi", "component_id"])


@query("q19_landcover_area_simplified")
def _(c):
    outline, classes, areas = _simplified_cover(c)
    whole = patches.outline_area(outline, ["aoi"], c.strip_grid).groupBy("aoi").agg(F.sum("area_km2").alias("aoi_km2"))
    return views.landcover_area(areas.join(classes, ["aoi", "component_id"]), whole)


@query("q19_simplified_close", "SELECT aoi, land_cover, count(DISTINCT component_id) AS n_features, 0 AS n_beyond FROM cover_comp JOIN classes ON value = class_no GROUP BY ALL")
def _(c):
    # No border moves by more than the tolerance, to either side, so an area changes by twice that times the length of
    # its outline at most. Cells of the strip grid are no wider than 60 m.
    outline, classes, areas = _simplified_cover(c)
    key = ["aoi", "component_id"]
    room = outline.groupBy(*key).agg((F.count(F.lit(1)) * 60.0 * 2 * fixed.SIMPLIFY_METRES / 1e6).alias("room"))
    before = patches.outline_area(outline, ["aoi"], c.strip_grid).withColumnRenamed("area_km2", "before")
    beyond = F.abs(F.col("area_km2") - F.col("before")) > F.col("room")
    return areas.join(before, key).join(room, key).join(classes, key).groupBy("aoi", "land_cover").agg(
        F.count(F.lit(1)).alias("n_features"), F.sum(beyond.cast("int")).alias("n_beyond"))


@query("q21_frp_feature_summary", """SELECT aoi, count(*) AS n_features, max(n_years) AS n_years_in_dataset, min(frp_years) AS frp_years_min,
max(frp_years) AS frp_years_max, avg(frp_years) AS frp_years_mean FROM frp_patches GROUP BY ALL""", "frp_years_min frp_years_max frp_years_mean")
def _(c):
    return views.frp_feature_summary(c.frp_patches)


@query("q28_frp_patches_view", """SELECT aoi, component_id, frp_years, burn_count, year_start, year_end, CAST(year_end - year_start + 1 AS INT) AS n_years
FROM (SELECT * EXCLUDE (n_years) FROM frp_patches) JOIN (SELECT aoi, min(year) AS year_start, max(year) AS year_end FROM strip_burns GROUP BY ALL) USING (aoi)""", "frp_years")
def _(c):
    return views.frp_patches_view(c.frp_patches, views.ba_year_range(c.strip_years)).select(
        "aoi", "component_id", "frp_years", "burn_count", "year_start", "year_end", "n_years"
    )


def _simplified_features(c):
    kept = _simplified(c).select("aoi", "component_id", "ring_id", "seq", "lon", "lat")
    props = views.frp_patches_view(c.frp_patches, views.ba_year_range(c.strip_years)).drop("n_cells", "n_rings", "area_km2")
    return patches.patch_features(kept, ["aoi"], props)


@query("q28_frp_patches_simplified")
def _(c):
    return _simplified_features(c)


@query("q28_simplified_rings", """SELECT aoi, component_id, frp_years, CAST(n_rings AS INT) AS n_rings, true AS closed FROM frp_patches""", "frp_years")
def _(c):
    shape = F.from_json("feature", "properties struct<frp_years:double>, geometry struct<type:string,coordinates:array<array<array<double>>>>")
    rings = F.col("f.geometry.coordinates")
    closed = F.forall(rings, lambda r: (F.size(r) >= 4) & (r[0] == F.element_at(r, -1)))
    return _simplified_features(c).withColumn("f", shape).select(
        "aoi", "component_id", F.col("f.properties.frp_years").alias("frp_years"), F.size(rings).alias("n_rings"), closed.alias("closed"))
