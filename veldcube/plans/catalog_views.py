"""Query operators and documented readings as named queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from veldcube.functions.columns import row_area
from veldcube.operators import annual, documented, monthly, trend, views
from veldcube.plans.oracle import STRIP_ROW_AREA
from veldcube.plans.registry import query
from veldcube.sources import adapter

S = "aoi, sensor, resolution"
SY = f"{S}, year, month"


@query("q1_ym_filter", "SELECT * FROM a1 WHERE year * 12 + month BETWEEN 1996 * 12 + 3 AND 1999 * 12 + 8", "mean_ndvi")
def _(c):
    return views.ym_filter(c.monthly, "1996-03", "1999-08")


@query("q2_resolve_resolution", """SELECT o_orderkey, sensor, resolution, "start", "end", CAST(CASE WHEN resolution NOT IN ('auto', '0') THEN 250
WHEN sensor = 'sentinel2' THEN 100 WHEN sensor = 'burned_area' THEN 500
WHEN sensor = 'modis' THEN CASE WHEN span IS NULL OR span > 5 THEN 1000 ELSE 250 END
WHEN resolution = 'auto' THEN 1000 ELSE 0 END AS INT) AS resolved FROM (SELECT *,
(CAST(substr("end", 1, 4) AS INT) + CAST(substr("end", 6, 2) AS INT) / 12.0::DOUBLE)
 - (CAST(substr("start", 1, 4) AS INT) + CAST(substr("start", 6, 2) AS INT) / 12.0::DOUBLE) AS span FROM requests)""")
def _(c):
    return views.resolve_resolution(adapter.requests(c.spark, c.sf_dir))


@query("q3_timeseries_table", f"SELECT a1.*, ts_lower, ts_upper, climatology, hist_std FROM a1 LEFT JOIN a2 USING ({S}, month)",
       "mean_ndvi ts_lower ts_upper climatology hist_std")
def _(c):
    return views.timeseries_table(c.stored_monthly, monthly.ndvi_monthly_baselines(c.stored_monthly))


@query("q4_timeseries_enriched", f"""SELECT {SY}, mean_ndvi, mean_ndvi - climatology AS vs_climatology,
CASE WHEN mean_ndvi IS NULL OR ts_lower IS NULL OR ts_upper IS NULL THEN 'unknown' WHEN mean_ndvi > ts_upper THEN 'above'
WHEN mean_ndvi < ts_lower THEN 'below' ELSE 'normal' END AS status, trend_direction,
coalesce(mk_p < 0.05, false) AS trend_significant, sen_slope AS sen_slope_per_year
FROM a1 LEFT JOIN a2 USING ({S}, month) LEFT JOIN trend_stats USING ({S})""", "mean_ndvi vs_climatology sen_slope_per_year")
def _(c):
    table = views.timeseries_table(c.stored_monthly, monthly.ndvi_monthly_baselines(c.stored_monthly))
    return views.timeseries_enriched(table, c.trend_stats)


@query("q5_annual_series", "SELECT aoi, year, mean_ndvi, n_months, is_complete FROM a3", "mean_ndvi")
def _(c):
    return c.annual.select("aoi", "year", "mean_ndvi", "n_months", "is_complete")


@query("q6_by_landcover", f"SELECT * EXCLUDE (hist_sd) FROM a7 LEFT JOIN b1 USING ({S}, year, land_cover)",
       "mean_ndvi annual_mean hist_min hist_max hist_mean_all cv")
def _(c):
    return views.by_landcover(c.stored_by_class, annual.ndvi_annual_by_class(c.stored_by_class))


@query("q7_anomaly_view", "SELECT *, CASE WHEN anomaly_value < 0 THEN 'deficit' ELSE 'surplus' END AS status FROM a11",
       "anomaly_value mean_ndvi hist_mean")
def _(c):
    return views.anomaly_view(c.anomaly)


@query("q7_resilience_view", "SELECT * FROM b7 WHERE anomaly_year = 1998", "max_deficit resilience_score")
def _(c):
    return views.resilience_view(c.resilience, 1998)


@query("q8_phenology_view", "SELECT * FROM b11 WHERE land_cover = 'Crops'", "peak_ndvi")
def _(c):
    return views.phenology_view(c.phenology, "Crops")


@query("q9_annual_grid", f"""SELECT {S}, year, row_idx, col_idx, avg(value) AS value, months_available FROM cells JOIN (
SELECT {S}, year, CAST(count(DISTINCT month) AS INT) AS months_available FROM cells GROUP BY ALL) USING ({S}, year) GROUP BY ALL""", "value")
def _(c):
    return views.annual_grid(c.stored_cells)


@query("q11_monthly_anomaly_grid", f"""SELECT {SY}, row_idx, col_idx, delta, n_baseline_years, baseline_start, baseline_end, baseline_years FROM (
SELECT {SY}, row_idx, col_idx, value - avg(value) OVER (PARTITION BY {S}, row_idx, col_idx, month ORDER BY year
ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS delta FROM cells)
JOIN (SELECT a.aoi, a.sensor, a.resolution, a.year, a.month, CAST(count(*) AS INT) AS n_baseline_years, min(b.year) AS baseline_start,
max(b.year) AS baseline_end, string_agg(b.year, ',' ORDER BY b.year) AS baseline_years FROM a1 a JOIN a1 b
ON a.aoi = b.aoi AND a.sensor = b.sensor AND a.resolution = b.resolution AND a.month = b.month AND b.year < a.year GROUP BY ALL)
USING ({SY})""", "delta")
def _(c):
    return views.monthly_anomaly_grid(c.stored_cells)


@query("q12_compact_grid", f"""SELECT {SY}, d.row_idx, -14.0 + (d.row_idx + 0.5::DOUBLE) * (-0.005::DOUBLE) AS lat, CAST(count(value) AS INT) AS n_pixels,
string_agg(coalesce(CAST(CAST(round(value * 10000) AS BIGINT) AS VARCHAR), 'null'), ',' ORDER BY r.range) AS ten_thousandths,
string_agg(CAST(CAST(round((26.0 + (r.range + 0.5) * 0.005) * 1000000) AS BIGINT) AS VARCHAR), ',' ORDER BY r.range) AS millionths_east
FROM (SELECT DISTINCT {SY} FROM cells) m CROSS JOIN (SELECT CAST(range AS INT) AS row_idx FROM range(8)) d CROSS JOIN range(8) r
LEFT JOIN (SELECT {SY}, row_idx, col_idx, value FROM cells) c ON c.aoi = m.aoi AND c.sensor = m.sensor AND c.resolution = m.resolution
AND c.year = m.year AND c.month = m.month AND c.row_idx = d.row_idx AND c.col_idx = r.range GROUP BY ALL""".replace(f"SELECT {SY}, d.row_idx", "SELECT m.aoi, m.sensor, m.resolution, m.year, m.month, d.row_idx", 1), "lat")
def _(c):
    text = F.array_join(F.transform("values", lambda v: F.round(v * 10000).cast("long").cast("string")), ",", "null")
    east = F.array_join(F.transform("lons", lambda v: F.round(v * 1000000).cast("long").cast("string")), ",")
    return views.compact_grid(c.cells, c.grid).withColumn("ten_thousandths", text).withColumn("millionths_east", east).drop("values", "lons")


@query("q13_ba_summary", """SELECT *, burned_km2 - ba_mean AS vs_baseline,
CASE WHEN burned_km2 > ba_upper_ci THEN 'above_normal' ELSE 'normal' END AS status FROM a9""",
       "burned_km2 ba_mean ba_lower_ci ba_upper_ci vs_baseline")
def _(c):
    return views.ba_summary(c.ba_monthly)


@query("q14_ba_daily_view", "SELECT * REPLACE (CAST(date AS VARCHAR) AS date) FROM a10 WHERE year = 1998", "burned_km2")
def _(c):
    return views.ba_daily_view(c.ba_daily, 1998).withColumn("date", F.col("date").cast("string"))


@query("q15_ba_monthly_grid", f"""SELECT {SY}, row_idx, col_idx, burn_date, burned_pixels, burned_pixels * 0.25 AS burned_km2 FROM burns JOIN (
SELECT {SY}, sum(CASE WHEN burn_date > 0 THEN 1 ELSE 0 END) AS burned_pixels FROM burns GROUP BY ALL) USING ({SY})""", "burned_km2")
def _(c):
    return views.ba_monthly_grid(c.burns)


@query("q16_ba_annual_grid", f"""SELECT {S}, year, row_idx, col_idx, CAST(sum(CASE WHEN burn_date > 0 THEN 1 ELSE 0 END) AS INT) AS burn_count
FROM burns GROUP BY ALL""")
def _(c):
    return views.ba_annual_grid(c.burns)


@query("q16_ba_annual_totals", f"""SELECT {S}, year, burned_pixels, multi_burn_pixels, months_available, burned_pixels * 0.25 AS total_burned_km2 FROM (
SELECT {S}, year, count(*) FILTER (n > 0) AS burned_pixels, count(*) FILTER (n > 1) AS multi_burn_pixels FROM (
SELECT {S}, year, row_idx, col_idx, count(*) FILTER (burn_date > 0) AS n FROM burns GROUP BY ALL) GROUP BY ALL)
JOIN (SELECT {S}, year, CAST(count(DISTINCT month) AS INT) AS months_available FROM burns GROUP BY ALL) USING ({S}, year)""", "total_burned_km2")
def _(c):
    return views.ba_annual_totals(c.burns)


@query("q20_ba_year_range", """SELECT aoi, min(year) AS year_start, max(year) AS year_end,
CAST(max(year) - min(year) + 1 AS INT) AS n_years FROM a9 GROUP BY ALL""")
def _(c):
    return views.ba_year_range(c.ba_monthly)


@query("q22_frp_area_summary", """SELECT aoi, sum(frp_years * area) / sum(area) AS mean_frp_years,
min(frp_years) FILTER (upto >= total / 2) AS median_frp_years,
100 * sum(CASE WHEN frp_years < 3 THEN area ELSE 0 END) / sum(area) AS pct_lt_3,
100 * sum(CASE WHEN frp_years >= 3 AND frp_years < 7 THEN area ELSE 0 END) / sum(area) AS pct_lt_7,
100 * sum(CASE WHEN frp_years >= 7 AND frp_years < 15 THEN area ELSE 0 END) / sum(area) AS pct_lt_15,
100 * sum(CASE WHEN frp_years >= 15 THEN area ELSE 0 END) / sum(area) AS pct_rest
FROM (SELECT aoi, frp_years, area, sum(area) OVER (PARTITION BY aoi ORDER BY frp_years) AS upto, sum(area) OVER (PARTITION BY aoi) AS total
FROM (SELECT aoi, frp_years, """ + STRIP_ROW_AREA + """ AS area FROM strip_frp WHERE frp_years IS NOT NULL)) GROUP BY aoi""",
       "mean_frp_years median_frp_years pct_lt_3 pct_lt_7 pct_lt_15 pct_rest")
def _(c):
    cells = c.strip_frp.join(c.strip_grid.select("aoi", "resolution", "north", "dx", "dy"), ["aoi", "resolution"])
    area = row_area(F.col("row_idx"), F.col("north"), F.col("dx"), F.col("dy"))
    return views.frp_area_summary(cells.select("aoi", "frp_years", area.alias("area")))


_CHANGE = """SELECT {s}, count(*) FILTER (d > 0.02) * 0.25 AS gain_km2, count(*) FILTER (d < -0.02) * 0.25 AS loss_km2,
count(*) * 0.25 AS total_area_km2, 100.0::DOUBLE * count(*) FILTER (d > 0.02) / count(*) AS pct_gaining,
100.0::DOUBLE * count(*) FILTER (d < -0.02) / count(*) AS pct_losing, avg(d) AS mean_ndvi_change, max(d) AS max_gain, min(d) AS max_loss
FROM (SELECT {s}, round(b, 4) - round(a, 4) AS d FROM (SELECT {s}, row_idx, col_idx, avg(value) FILTER (year = 1996) AS a,
avg(value) FILTER (year = 2000) AS b FROM cells {where} GROUP BY ALL) WHERE a IS NOT NULL AND b IS NOT NULL) GROUP BY ALL"""
_CHANGE_COLS = "gain_km2 loss_km2 total_area_km2 pct_gaining pct_losing mean_ndvi_change max_gain max_loss"


@query("q23_spatial_change", _CHANGE.format(s=S, where=""), _CHANGE_COLS)
def _(c):
    return views.spatial_change(c.cells, 1996, 2000)


@query("q23_spatial_change_month", _CHANGE.format(s=S, where="WHERE month = 7"), _CHANGE_COLS)
def _(c):
    return views.spatial_change(c.cells, 1996, 2000, 7)


@query("q24_available_sensors", """SELECT sensor, min(ym) AS "start", max(ym) AS "end" FROM (
SELECT sensor, printf('%04d-%02d', year, month) AS ym FROM months) GROUP BY ALL""")
def _(c):
    return views.available_sensors(c.months)


@query("q24_available_classes", "SELECT aoi, string_agg(DISTINCT land_cover, ',' ORDER BY land_cover) AS classes FROM a7 GROUP BY ALL")
def _(c):
    return views.available_classes(c.by_class)


@query("q25_data_through", """SELECT aoi, max(printf('%04d-%02d', year, month)) AS data_through FROM months
WHERE sensor = 'sentinel2' GROUP BY ALL""")
def _(c):
    return views.data_through(c.months, [("sentinel2", 100), ("sentinel2", 500), ("modis", 1000), ("burned_area", 500)])


@query("q26_rank_years", """SELECT aoi, year, total_km2, CAST(row_number() OVER (PARTITION BY aoi ORDER BY total_km2 DESC, year) AS INT) AS year_rank
FROM (SELECT aoi, year, sum(burned_km2) AS total_km2 FROM a9 GROUP BY ALL)""", "total_km2")
def _(c):
    return views.rank_years(c.ba_monthly)


@query("q26_top_years", """SELECT * FROM (SELECT aoi, year, total_km2,
CAST(row_number() OVER (PARTITION BY aoi ORDER BY total_km2 DESC, year) AS INT) AS year_rank
FROM (SELECT aoi, year, sum(burned_km2) AS total_km2 FROM a9 WHERE month = 8 GROUP BY ALL)) WHERE year_rank <= 3""", "total_km2")
def _(c):
    return views.top_years(c.ba_monthly, 3, month=8)


@query("q27_last_run", "SELECT CAST(max(run_timestamp) AS VARCHAR) AS last_run FROM run_log")
def _(c):
    return views.last_run(adapter.run_log(c.spark, c.sf_dir)).select(F.col("last_run").cast("string").alias("last_run"))


# --- documented readings -------------------------------------------------------------------

@query("d1_status_badge", f"""SELECT {S}, year, CASE WHEN smk_p < 0.05 AND smk_sen_slope < 0 THEN 'Degrading'
WHEN wilcox_p < 0.05 AND median_anomaly < 0 THEN 'Mild stress' ELSE 'Stable' END AS status_badge FROM wilcoxon LEFT JOIN smk USING ({S})""")
def _(c):
    wilcoxon = documented.wilcoxon_signed_rank(documented.prior_years_baseline(c.stored_monthly))
    return documented.status_badge(trend.seasonal_mann_kendall(c.stored_monthly), wilcoxon)


@query("d2_wilcoxon", "wilcoxon", "median_anomaly wilcox_p")
def _(c):
    return documented.wilcoxon_signed_rank(documented.prior_years_baseline(c.monthly))


@query("d3_prior_years_baseline", "prior_years", "mean_ndvi lower upper climatology anomaly")
def _(c):
    return documented.prior_years_baseline(c.monthly)


@query("d4_normalised_delta", "norm_delta", "delta_ndvi")
def _(c):
    return documented.normalised_delta(c.cells)


@query("d5_symmetric_delta_range", f"""SELECT {S}, greatest(abs(quantile_cont(delta_ndvi, 0.02)), abs(quantile_cont(delta_ndvi, 0.98))) AS max_abs
FROM norm_delta GROUP BY ALL""", "max_abs")
def _(c):
    return documented.symmetric_delta_range(documented.normalised_delta(c.stored_cells), ["aoi", "sensor", "resolution"], "delta_ndvi")


@query("d6_burned_percentage", """SELECT aoi, year, month, CASE WHEN burned_km2 <= 1 THEN 0 ELSE burned_km2 / area_km2 * 100 END AS pct_burned
FROM a9 JOIN (SELECT aoi, 0.25 * count(DISTINCT row_idx * 8 + col_idx) AS area_km2 FROM burns GROUP BY ALL) USING (aoi)""", "pct_burned")
def _(c):
    areas = c.burns.groupBy("aoi").agg((F.count_distinct("row_idx", "col_idx") * 0.25).alias("area_km2"))
    return documented.burned_percentage(c.ba_monthly, areas)


@query("d7_productivity_change", f"""SELECT {S}, land_cover, year, annual_mean - before AS change,
CASE WHEN land_cover = 'Trees' AND cv < 0.05 THEN 'Stable & highly productive' WHEN land_cover = 'Rangeland' AND cv < 0.05 THEN 'Stable & productive'
WHEN land_cover = 'Crops' AND cv < 0.08 THEN 'Consistent productivity' ELSE '' END AS interpretation
FROM b1 JOIN (SELECT {S}, land_cover, CAST(year + 1 AS INT) AS year, annual_mean AS before FROM b1) USING ({S}, land_cover, year)""", "change")
def _(c):
    return documented.productivity_change(c.annual_by_class)


@query("d8_linear_trend", f"""SELECT {S}, regr_slope(y, CAST(year AS DOUBLE)) AS slope_per_year, count(*) AS n_years FROM (
SELECT {S}, year, avg(mean_ndvi) AS y FROM a1 GROUP BY ALL HAVING count(mean_ndvi) >= 6) GROUP BY ALL""", "slope_per_year")
def _(c):
    return documented.linear_trend(c.monthly)


@query("d9_last_years", f"""SELECT {SY} FROM (SELECT {SY}, row_number() OVER (PARTITION BY {S}, month ORDER BY year DESC) AS rn FROM a1) WHERE rn <= 4""")
def _(c):
    return documented.last_years(c.monthly)


@query("d9_fire_season", "SELECT * REPLACE (CAST(date AS VARCHAR) AS date) FROM a10 WHERE month(date) IN (6, 7, 8, 9, 10)", "burned_km2")
def _(c):
    return documented.fire_season(c.ba_daily, [6, 7, 8, 9, 10]).withColumn("date", F.col("date").cast("string"))
