"""Scenes, composites, monthly tables and annual analytics as named queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from veldcube.operators import annual, composite, trend
from veldcube.operators.order_stats import exact_median
from veldcube.plans.registry import query

CM = ["aoi", "sensor", "resolution", "year", "month", "row_idx", "col_idx"]
S = "aoi, sensor, resolution"
NDVI_SQL = "CASE WHEN b8 + b4 <> 0 THEN (b8 - b4) / (b8 + b4) END"
OBS_KEYS = "aoi, year, month, row_idx, col_idx"


# --- scenes and composites -----------------------------------------------------------------

@query("s1_scan_scenes", f"""SELECT {OBS_KEYS}, b8, b4, cloud_pct FROM obs WHERE acq_ts >= TIMESTAMP '1997-01-01'
AND acq_ts < TIMESTAMP '1999-01-01' AND cloud_pct < 50 AND row_idx BETWEEN 1 AND 6 AND col_idx BETWEEN 2 AND 7""", "b8 b4 cloud_pct")
def _(c):
    kept = composite.scan_scenes(c.obs, "1997-01-01", "1999-01-01", 50, (1, 6), (2, 7))
    return kept.select("aoi", "year", "month", "row_idx", "col_idx", "b8", "b4", "cloud_pct")


@query("c1_mask_scl", f"SELECT {OBS_KEYS}, scl FROM obs WHERE scl NOT IN (1, 2, 3, 7, 8, 9, 10, 11)")
def _(c):
    return composite.mask_scl(c.obs).select("aoi", "year", "month", "row_idx", "col_idx", "scl")


@query("c2_normalized_difference", f"SELECT {OBS_KEYS}, {NDVI_SQL} AS ndvi FROM obs", "ndvi")
def _(c):
    return composite.with_ndvi(c.obs).select("aoi", "year", "month", "row_idx", "col_idx", "ndvi")


@query("c3_mask_summary_qa", f"SELECT {OBS_KEYS}, summary_qa FROM obs WHERE summary_qa <= 1")
def _(c):
    return composite.mask_summary_qa(c.obs).select("aoi", "year", "month", "row_idx", "col_idx", "summary_qa")


@query("c4_modis_median_composite", f"""SELECT {', '.join(CM)},
median(CASE WHEN summary_qa <= 1 THEN ndvi_raw * CAST(0.0001 AS DOUBLE) END) AS value FROM obs GROUP BY ALL""", "value")
def _(c):
    return composite.modis_median_composite(c.obs)


@query("c5_monthly_median_composite", "cells", "value")
def _(c):
    return c.cells


@query("c5_median_of_hot_groups", """SELECT aoi, median(v) AS median_ndvi FROM (
SELECT aoi, CASE WHEN scl NOT IN (1, 2, 3, 7, 8, 9, 10, 11) THEN (b8 - b4) / (b8 + b4) END AS v FROM obs WHERE cloud_pct < 100) GROUP BY ALL""",
       "median_ndvi")
def _(c):
    return exact_median(composite.visible_ndvi(c.obs), ["aoi"], "value", "median_ndvi")


@query("c6_monthly_mosaic_composite", "old_cells", "value")
def _(c):
    return c.old_cells


@query("c7_first_image_composite", "burns")
def _(c):
    return c.burns


@query("c8_latest_available_month", """SELECT aoi, CAST(year(ts) AS INT) AS year, CAST(month(ts) AS INT) AS month FROM (
SELECT aoi, max(acq_ts) AS ts FROM obs GROUP BY ALL)""")
def _(c):
    return composite.latest_available_month(c.obs)


@query("c9_legacy_scl_mask", f"SELECT {OBS_KEYS}, scl FROM obs WHERE scl NOT IN (1, 7, 8, 9, 10, 11)")
def _(c):
    return composite.mask_scl(c.obs, legacy=True).select("aoi", "year", "month", "row_idx", "col_idx", "scl")


# --- monthly tables ------------------------------------------------------------------------

@query("a1_ndvi_monthly", "a1", "mean_ndvi")
def _(c):
    return c.monthly


@query("a2_ndvi_monthly_baselines", "a2", "ts_lower ts_upper climatology hist_std")
def _(c):
    return c.baselines


@query("a3_ndvi_annual", "a3", "mean_ndvi")
def _(c):
    return c.annual


@query("a4_annual_range_stats", "ranges", "q1_ndvi q3_ndvi min_ndvi max_ndvi long_term_avg")
def _(c):
    return trend.annual_range_stats(c.annual)


@query("a5_mann_kendall", f"SELECT {S}, CAST(n AS INT) AS n, s AS mk_s, v AS mk_var, sen_slope, mk_p, trend_direction FROM mk_label",
       "mk_s mk_var sen_slope mk_p")
def _(c):
    return trend.annual_trend(c.annual)


@query("a6_seasonal_mann_kendall", "smk", "smk_s smk_var smk_sen_slope smk_p")
def _(c):
    return trend.seasonal_mann_kendall(c.monthly)


@query("a6_ndvi_trend_stats", "trend_stats",
       "mk_p sen_slope q1_ndvi q3_ndvi min_ndvi max_ndvi long_term_avg smk_p smk_sen_slope")
def _(c):
    return c.trend_stats


@query("a7_ndvi_monthly_by_class", "a7", "mean_ndvi")
def _(c):
    return c.by_class


@query("a8_class_baselines", "a8", "lc_mean lc_lower_ci lc_upper_ci hist_mean hist_sd")
def _(c):
    return c.class_baselines


@query("a9_ba_monthly", "a9", "burned_km2 ba_mean ba_lower_ci ba_upper_ci")
def _(c):
    return c.ba_monthly


@query("a10_ba_daily", "SELECT * REPLACE (CAST(date AS VARCHAR) AS date) FROM a10", "burned_km2")
def _(c):
    return c.ba_daily.withColumn("date", F.col("date").cast("string"))


@query("a11_ndvi_anomaly_monthly", "a11", "anomaly_value mean_ndvi hist_mean")
def _(c):
    return c.anomaly


# --- annual analytics ----------------------------------------------------------------------

@query("b1_ndvi_annual_by_class", "b1", "annual_mean hist_min hist_max hist_mean_all hist_sd cv")
def _(c):
    return c.annual_by_class


@query("b2_complete_class_years", "b2", "anomaly_value mean_ndvi hist_mean")
def _(c):
    return annual.complete_class_years(c.anomaly)


@query("b3_max_deficit", "b3", "max_deficit")
def _(c):
    return annual.max_deficit(annual.complete_class_years(c.anomaly))


@query("b4_recovery_months", "recovered", "max_deficit")
def _(c):
    complete = annual.complete_class_years(c.anomaly)
    return annual.recovery_months(complete, annual.max_deficit(complete), c.stored_class_baselines)


@query("b5_severity_label", f"SELECT {S}, anomaly_year, land_cover, max_deficit, severity FROM b7", "max_deficit")
def _(c):
    worst = annual.max_deficit(annual.complete_class_years(c.anomaly)).withColumnRenamed("year", "anomaly_year")
    return worst.withColumn("severity", annual.severity_label(F.col("max_deficit"))).drop("deficit_month")


@query("b6_resilience_rank", f"SELECT {S}, anomaly_year, land_cover, resilience_score, resilience_rank FROM b7", "resilience_score")
def _(c):
    return c.resilience.select("aoi", "sensor", "resolution", "anomaly_year", "land_cover", "resilience_score", "resilience_rank")


@query("b7_anomaly_resilience", "b7", "max_deficit resilience_score")
def _(c):
    return c.resilience


@query("b8_phenology_green_up", f"SELECT {S}, year, land_cover, green_up_month, green_up_conf FROM b11")
def _(c):
    return c.phenology.select("aoi", "sensor", "resolution", "year", "land_cover", "green_up_month", "green_up_conf")


@query("b9_phenology_peak", f"SELECT {S}, year, land_cover, peak_month, peak_ndvi, peak_conf FROM b11", "peak_ndvi")
def _(c):
    return c.phenology.select("aoi", "sensor", "resolution", "year", "land_cover", "peak_month", "peak_ndvi", "peak_conf")


@query("b10_phenology_senescence", f"SELECT {S}, year, land_cover, senescence_month FROM b11")
def _(c):
    return c.phenology.select("aoi", "sensor", "resolution", "year", "land_cover", "senescence_month")


@query("b11_ndvi_phenology", "b11", "peak_ndvi")
def _(c):
    return c.phenology


@query("b12_annual_cell_mean", "b12", "annual_mean")
def _(c):
    return c.cell_means


@query("b13_ndvi_annual_delta", "b13", "gain_km2 loss_km2 total_km2")
def _(c):
    return c.delta


@query("b14_burn_count", "b14")
def _(c):
    return c.burn_counts


@query("b15_fire_return_period", "b15", "frp_years")
def _(c):
    return c.frp
