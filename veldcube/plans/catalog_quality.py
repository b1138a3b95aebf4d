"""Data-quality checks and incremental operators as named queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from veldcube.operators import incremental, monthly, quality
from veldcube.plans.registry import query
from veldcube.sources import adapter, dims

S = "aoi, sensor, resolution"
SY = f"{S}, year, month"
KEY = ["aoi", "sensor", "resolution"]
MONTH = [*KEY, "year", "month"]


def _whole_years(months):
    """Every month from January of the first to December of the last year of each series."""
    ranges = months.groupBy(*KEY).agg(
        F.make_date(F.min("year"), F.lit(1), F.lit(1)).alias("start"), F.make_date(F.max("year"), F.lit(12), F.lit(1)).alias("end")
    )
    return incremental.month_spine(ranges)


@query("k2_check_new_months", f"""SELECT {SY}, 'new_month_present' AS "check", 'fail' AS severity FROM month_ends ANTI JOIN a1 USING ({SY})""")
def _(c):
    return quality.check_new_months(_whole_years(c.stored_monthly), c.stored_monthly)


@query("k2_check_new_months_by_class", f"""SELECT {SY}, 'new_month_present' AS "check", 'warn' AS severity FROM month_ends ANTI JOIN a7 USING ({SY})""")
def _(c):
    by_class = monthly.ndvi_monthly_by_class(c.stored_cells, dims.land_cover_cells(c.spark), dims.aoi_classes(c.spark))
    return quality.check_new_months(_whole_years(monthly.ndvi_monthly(c.stored_cells)), by_class, "warn")


@query("k3_check_ranges", """SELECT table_name, metric, lowest, highest, coalesce(lowest < low, false) AS below, coalesce(highest > high, false) AS above,
CASE WHEN coalesce(lowest < low, false) OR coalesce(highest > high, false) THEN 'fail' ELSE 'ok' END AS severity FROM metric_rows""", "lowest highest")
def _(c):
    return quality.check_ranges(quality.metric_summaries(c.products))


@query("k4_check_all_null", """SELECT table_name, metric, n_rows, n_values, CASE WHEN n_values = 0 AND metric <> 'n_valid_px' THEN 'warn' ELSE 'ok' END AS severity
FROM metric_rows""")
def _(c):
    return quality.check_all_null(quality.metric_summaries(c.products))


def _snapshot(old_cells):
    """Snapshot of the monthly table as the older composites give it."""
    return quality.snapshot(monthly.ndvi_monthly(old_cells), "ndvi_monthly", MONTH, ["mean_ndvi", "n_valid_px"])


@query("k5_snapshot", "snap", "value")
def _(c):
    return _snapshot(c.old_cells)


@query("k6_check_regression", """SELECT table_name, row_key, metric, value AS expected, actual, CASE WHEN abs(actual - value) > 0.001 THEN 'fail' ELSE 'ok' END AS severity
FROM snap JOIN (SELECT concat_ws('|', aoi, sensor, resolution, year, month) AS row_key, unnest(['mean_ndvi']) AS metric,
unnest([mean_ndvi]) AS actual FROM a1) USING (row_key, metric) WHERE value IS NOT NULL AND actual IS NOT NULL""", "expected actual")
def _(c):
    new, old = c.new_and_old_cells
    return quality.check_regression(_snapshot(old), monthly.ndvi_monthly(new), MONTH, ["mean_ndvi", "n_valid_px"])


@query("k7_check_tiles", f"""SELECT {SY}, 100.0::DOUBLE * n_valid / 64 AS pct_valid,
CASE WHEN n_valid = 0 THEN 'fail' WHEN 100.0::DOUBLE * n_valid / 64 < 10 THEN 'warn' ELSE 'ok' END AS valid_pixels,
CASE WHEN coalesce(lowest < -1 OR highest > 1, false) THEN 'fail' ELSE 'ok' END AS value_range,
CASE WHEN abs(n_rows - first_rows) > 1 OR abs(n_cols - first_cols) > 1 THEN 'fail' ELSE 'ok' END AS dimensions FROM tiles
JOIN (SELECT {S}, arg_min(n_rows, year * 12 + month) AS first_rows, arg_min(n_cols, year * 12 + month) AS first_cols FROM tiles GROUP BY {S}) USING ({S})""",
       "pct_valid")
def _(c):
    return quality.check_tiles(quality.tile_stats(c.cells, c.grid, "value"))


@query("k7_check_burn_tiles", f"""SELECT {SY}, 100.0::DOUBLE * n / 64 AS pct_valid, 'ok' AS valid_pixels, CASE WHEN coalesce(top > 366, false) THEN 'fail' ELSE 'ok' END AS value_range,
CASE WHEN abs(r - fr) > 1 OR abs(k - fk) > 1 THEN 'fail' ELSE 'ok' END AS dimensions FROM (
SELECT {SY}, count(*) AS n, max(burn_date) AS top, max(row_idx) AS r, max(col_idx) AS k FROM burns GROUP BY ALL)
JOIN (SELECT {S}, arg_min(r, q) AS fr, arg_min(k, q) AS fk FROM (
SELECT {S}, year * 12 + month AS q, max(row_idx) AS r, max(col_idx) AS k FROM burns GROUP BY ALL) GROUP BY {S}) USING ({S})""", "pct_valid")
def _(c):
    return quality.check_tiles(quality.tile_stats(c.burns, c.grid, "burn_date", burned=True), burned=True)


@query("k8_check_frp", """SELECT aoi, count(*) AS n_features, count(*) >= 100 AS enough_features, min(frp_years >= 1 AND frp_years <= n_years) AS frp_in_range,
min(burn_count >= 1 AND burn_count <= n_years) AS burn_count_in_range FROM frp_patches GROUP BY ALL""")
def _(c):
    return quality.check_frp(c.frp_patches)


@query("k9_check_stage_means", f"""SELECT {SY}, m.mean_ndvi AS mean_value, o.mean_ndvi AS legacy_mean, CASE WHEN m.aoi IS NULL THEN 'missing'
WHEN m.mean_ndvi IS NULL THEN 'no valid cells' WHEN m.mean_ndvi < -0.2 OR m.mean_ndvi > 0.95 THEN 'out of range'
WHEN abs(m.mean_ndvi - o.mean_ndvi) > 0.15 THEN 'differs from legacy' ELSE 'ok' END AS problem
FROM month_ends LEFT JOIN a1 m USING ({SY}) LEFT JOIN old_monthly o USING ({SY})""", "mean_value legacy_mean")
def _(c):
    new, old = (monthly.ndvi_monthly(x) for x in c.new_and_old_cells)
    means, legacy = (x.withColumnRenamed("mean_ndvi", "mean_value") for x in (new, old))
    return quality.check_stage_means(means, legacy, _whole_years(new), -0.2, 0.95)


@query("k10_recompute_check", f"""SELECT {SY}, s.mean_ndvi AS stored_mean, f.mean_ndvi AS fresh_mean, abs(s.mean_ndvi - f.mean_ndvi) AS abs_diff,
coalesce(abs(s.mean_ndvi - f.mean_ndvi) < 0.01, false) AS passes FROM old_monthly s FULL JOIN a1 f USING ({SY})""", "stored_mean fresh_mean abs_diff")
def _(c):
    new, old = c.new_and_old_cells
    return quality.recompute_check(monthly.ndvi_monthly(old), monthly.ndvi_monthly(new))


@query("k11_trend_expectation", f"""SELECT {S}, 'decreasing' AS expected, trend_direction AS actual, coalesce(trend_direction = 'decreasing', false) AS passes
FROM trend_stats""")
def _(c):
    return quality.trend_expectation(c.trend_stats, c.stored_monthly.select(*KEY).distinct().withColumn("expected", F.lit("decreasing")))


@query("k12_ba_range", "SELECT aoi, year, month, burned_km2, burned_km2 BETWEEN 0.5 AND 2.0 AS passes FROM a9", "burned_km2")
def _(c):
    return quality.ba_range_expectation(c.ba_monthly, 0.5, 2.0)


@query("k12_delta_expectation", f"""SELECT {S}, year_a, year_b, gain_km2, loss_km2, coalesce(abs(gain_km2 - 9.0) / 9.0 <= 0.2, false) AS gain_ok,
coalesce(abs(loss_km2 - 9.0) / 9.0 <= 0.2, false) AS loss_ok FROM b13 WHERE year_b = year_a + 1""", "gain_km2 loss_km2")
def _(c):
    years = c.stored_annual.where("is_complete").select(*KEY, F.col("year").alias("year_a"), (F.col("year") + 1).alias("year_b"))
    both = years.join(c.stored_annual.where("is_complete").select(*KEY, F.col("year").alias("year_b")), [*KEY, "year_b"], "left_semi")
    expected = both.select(*KEY, "year_a", "year_b", F.lit(9.0).alias("exp_gain_km2"), F.lit(9.0).alias("exp_loss_km2"))
    return quality.delta_expectation(c.delta, expected)


@query("k12_phenology_medians", f"""SELECT *, coalesce(median_green_up = 12, false) AS green_up_ok, coalesce(median_peak = 2, false) AS peak_ok,
coalesce(median_peak_ndvi BETWEEN 0.55 AND 0.75, false) AS peak_ndvi_ok FROM (SELECT {S}, land_cover, CAST(trunc(median(green_up_month)) AS INT) AS median_green_up,
CAST(trunc(median(peak_month)) AS INT) AS median_peak, median(peak_ndvi) AS median_peak_ndvi FROM b11 GROUP BY ALL)""", "median_peak_ndvi")
def _(c):
    return quality.phenology_expectation(quality.phenology_medians(c.phenology))


@query("k13_resilience_invariants", f"""SELECT {S}, anomaly_year, count(DISTINCT land_cover) AS n_classes, 0 AS wrong_labels,
min(resilience_rank) = 1 AS rank1_is_lowest, abs(arg_max(resilience_score, resilience_rank) - max(resilience_score)) < 1e-6 AS last_is_highest
FROM b7 GROUP BY {S}, anomaly_year""")
def _(c):
    return quality.resilience_invariants(c.resilience)


# --- incremental -----------------------------------------------------------------------------

@query("i1_month_spine", "month_ends")
def _(c):
    return _whole_years(c.stored_monthly)


@query("i2_latest_month", "latest")
def _(c):
    return incremental.latest_month(c.months)


SENSOR_END = [("sentinel2", 2002, 2), ("burned_area", 2001, 12)]


@query("i3_missing_months", f"""SELECT {S}, CAST(year(m) AS INT) AS year, CAST(month(m) AS INT) AS month FROM (
SELECT {S}, unnest(generate_series(make_date(year, month, 1)::TIMESTAMP + INTERVAL 1 MONTH, make_date(ey, em, 1)::TIMESTAMP, INTERVAL 1 MONTH)) AS m
FROM latest JOIN (VALUES ('sentinel2', 2002, 2), ('burned_area', 2001, 12)) t(sensor, ey, em) USING (sensor))""")
def _(c):
    ends = c.spark.createDataFrame(SENSOR_END, "sensor string, end_year int, end_month int")
    return incremental.missing_months(incremental.latest_month(c.months), ends)


def _backfill_log(c):
    done = (F.col("year") * 12 + F.col("month")) % 5 != 0
    return c.stored_monthly.select(*MONTH, F.when(done, "success").otherwise("error").alias("status"))


@query("i4_pending_from_log", f"SELECT {SY} FROM month_ends ANTI JOIN (SELECT * FROM backfill_log WHERE status = 'success') USING ({SY})")
def _(c):
    return incremental.pending_from_log(_whole_years(c.stored_monthly), _backfill_log(c))


@query("i5_complete_years", f"""SELECT year FROM (SELECT DISTINCT {S}, year FROM months WHERE month = 12) GROUP BY year
HAVING count(*) = (SELECT count(*) FROM (SELECT DISTINCT {S} FROM months))""")
def _(c):
    return incremental.complete_years(c.stored_months, c.stored_months.select(*KEY).distinct())


@query("i6_new_complete_year", f"""SELECT year FROM (SELECT max(year) AS year FROM (SELECT year FROM (SELECT DISTINCT {S}, year FROM months WHERE month = 12) GROUP BY year
HAVING count(*) = (SELECT count(*) FROM (SELECT DISTINCT {S} FROM months)))) WHERE year > (
SELECT coalesce(max(new_year_detected), 0) FROM run_log WHERE pass_b_ran)""")
def _(c):
    complete = incremental.complete_years(c.stored_months, c.stored_months.select(*KEY).distinct())
    return incremental.new_complete_year(complete, adapter.run_log(c.spark, c.sf_dir))

