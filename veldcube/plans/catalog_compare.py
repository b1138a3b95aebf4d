"""Comparison and diagnostics as named queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from veldcube.operators import compare, monthly, spatial
from veldcube.plans.registry import query

S = "aoi, sensor, resolution"
KEY = ["aoi", "sensor", "resolution"]
MONTH = [*KEY, "year", "month"]
AT = ["row_idx", "col_idx"]
SOURCES = ["first", "last", "any"]
COUNTS = "count(*) FILTER (member = 'overlap') AS n_overlap, count(*) FILTER (member = 'only_new') AS n_only_new"


def _v1(c):
    return compare.compare_cells(*c.new_and_old_cells, MONTH, AT)


@query("v1_compare_cells", "v1", "mean_new std_new min_new max_new mean_old std_old min_old max_old correlation mean_abs_diff "
       "median_abs_diff pct_diff_gt_005 pct_diff_gt_010")
def _(c):
    return _v1(c)


@query("v1_compare_cells_whole_area", f"""SELECT {S}, count(a) AS n_valid_new, avg(a) AS mean_new, stddev_pop(a) AS std_new, min(a) AS min_new, max(a) AS max_new,
count(b) AS n_valid_old, avg(b) AS mean_old, stddev_pop(b) AS std_old, min(b) AS min_old, max(b) AS max_old, count(d) AS n_overlapping,
corr(a, b) FILTER (d IS NOT NULL) AS correlation, avg(d) AS mean_abs_diff, 100.0::DOUBLE * count(*) FILTER (d > 0.05) / count(d) AS pct_diff_gt_005,
100.0::DOUBLE * count(*) FILTER (d > 0.10) / count(d) AS pct_diff_gt_010, median(d) AS median_abs_diff FROM cell_pairs GROUP BY {S}""",
       "mean_new std_new min_new max_new mean_old std_old min_old max_old correlation mean_abs_diff median_abs_diff pct_diff_gt_005 pct_diff_gt_010")
def _(c):
    return compare.compare_cells(*c.new_and_old_cells, KEY, ["year", "month", *AT])


@query("v2_compare_burned", f"""SELECT *, n_burned_new * pixel_area_km2 AS burned_new_km2, n_burned_old * pixel_area_km2 AS burned_old_km2 FROM (
SELECT aoi, year, month, count(*) FILTER (doy_new > 0) AS n_burned_new, count(*) FILTER (doy_old > 0) AS n_burned_old, {COUNTS},
count(*) FILTER (member = 'only_old') AS n_only_old, avg(abs(doy_new - doy_old)) FILTER (member = 'overlap') AS mean_abs_diff_days,
0.005 * 111.32 * cos(radians(-14.0 + (-0.005) * 4)) * 0.005 * 111.32 AS pixel_area_km2 FROM burn_pairs GROUP BY aoi, year, month)""",
       "mean_abs_diff_days pixel_area_km2 burned_new_km2 burned_old_km2")
def _(c):
    return compare.compare_burned(c.burn_pairs, ["aoi", "year", "month"], c.grid)


@query("v3_cell_stats", f"""SELECT {S}, year, month, count(value) AS n_valid, avg(value) AS mean, stddev_pop(value) AS std, min(value) AS min,
max(value) AS max FROM cells GROUP BY ALL""", "mean std min max")
def _(c):
    return compare.cell_stats(c.cells, MONTH)


def _v4(c):
    return compare.pairwise_match(c.burn_sources, SOURCES, ["aoi"])


@query("v4_pairwise_match", "match_pairs", "mad_days pct_a_captured pct_b_captured jaccard")
def _(c):
    return _v4(c)


@query("v5_three_way_membership", """SELECT aoi, first_date > 0 AS in_first, last_date > 0 AS in_last, any_date > 0 AS in_any, count(*) AS n_cells
FROM burn_sources WHERE first_date > 0 OR last_date > 0 OR any_date > 0 GROUP BY ALL""")
def _(c):
    return compare.presence_counts(c.burn_sources, SOURCES, ["aoi"])


@query("v6_subset_verdict", """SELECT a.aoi, a.pct_a_captured, a.pct_b_captured, a.jaccard, b.jaccard AS other_jaccard,
CASE WHEN a.pct_a_captured >= 90 AND a.pct_b_captured >= 90 AND coalesce(a.mad_days, 0) < 2 THEN 'near_perfect'
WHEN (a.pct_a_captured >= 50 OR a.pct_b_captured >= 50) AND (b.jaccard = 0 OR a.jaccard / b.jaccard >= 1.2) THEN 'partial'
WHEN b.n_only_a = 0 AND coalesce(b.mad_days, 0) < 1 THEN 'strict_subset' ELSE 'different' END AS verdict
FROM match_pairs a JOIN match_pairs b USING (aoi) WHERE a.source_a = 'first' AND a.source_b = 'last' AND b.source_a = 'first' AND b.source_b = 'any'""",
       "pct_a_captured pct_b_captured jaccard other_jaccard")
def _(c):
    return compare.subset_verdict(_v4(c), "first", "last", "any", ["aoi"])


@query("v7_yearly_ratio", "ratios", "ratio")
def _(c):
    return compare.yearly_ratio(c.burn_pairs, ["aoi"])


@query("v7_temporal_ratio", """SELECT aoi, n_years, ratio_range, ratio_cv, n_up, CASE WHEN ratio_range < 0.30 AND lowest > 1.1 THEN 'constant'
WHEN ratio_cv > 0.5 THEN 'erratic' WHEN n_up >= n_years - 2 THEN 'increasing' ELSE 'mixed' END AS verdict FROM (
SELECT aoi, count(*) AS n_years, max(ratio) - min(ratio) AS ratio_range, stddev_pop(ratio) / avg(ratio) AS ratio_cv,
count(*) FILTER (ratio > prev) AS n_up, min(ratio) AS lowest FROM (
SELECT *, lag(ratio) OVER (PARTITION BY aoi ORDER BY year) AS prev FROM ratios WHERE ratio IS NOT NULL) GROUP BY aoi HAVING count(*) >= 3)""", "ratio_range ratio_cv")
def _(c):
    return compare.temporal_ratio(compare.yearly_ratio(c.burn_pairs, ["aoi"]), ["aoi"])


def _sizes(c, connectivity):
    return compare.cluster_sizes(compare.burned_clusters(c.strip_pairs, ["aoi"], connectivity), ["aoi"])


@query("v8_cluster_classes", """SELECT *, CASE WHEN pct_isolated > 50 THEN 'isolated' WHEN pct_mixed > 50 THEN 'mixed' WHEN pct_all_new > 50 THEN 'all_new'
ELSE 'no_majority' END AS verdict FROM (SELECT aoi, n_only_new, n_isolated, n_mixed, n_all_new, 100.0::DOUBLE * n_isolated / n_only_new AS pct_isolated,
100.0::DOUBLE * n_mixed / n_only_new AS pct_mixed, 100.0::DOUBLE * n_all_new / n_only_new AS pct_all_new FROM (
SELECT aoi, sum(size - n_old) AS n_only_new, sum(CASE WHEN size = 1 THEN size - n_old ELSE 0 END) AS n_isolated,
sum(CASE WHEN size > 1 AND n_old > 0 THEN size - n_old ELSE 0 END) AS n_mixed, sum(CASE WHEN size > 1 AND n_old = 0 THEN size ELSE 0 END) AS n_all_new
FROM sizes8 GROUP BY aoi) WHERE n_only_new > 0)""", "pct_isolated pct_mixed pct_all_new")
def _(c):
    return compare.cluster_classes(_sizes(c, 8), ["aoi"])


@query("v9_cluster_size_classes", """SELECT aoi, CASE WHEN n_old = size THEN 'fully_old' WHEN n_old = 0 THEN 'only_new' ELSE 'mixed' END AS kind,
count(*) AS n_clusters, floor(median(size)) AS median_size FROM sizes4 GROUP BY ALL""")
def _(c):
    return compare.cluster_size_classes(_sizes(c, 4), ["aoi"])


@query("v10_min_cluster_curve", """SELECT aoi, k AS min_size, kept AS cells_kept, kept - n_old AS vs_old FROM (
SELECT aoi, k, sum(CASE WHEN size >= k THEN size ELSE 0 END) AS kept, sum(n_old) AS n_old FROM sizes4
CROSS JOIN (VALUES (1), (2), (3), (4), (5), (10)) t(k) GROUP BY aoi, k)""")
def _(c):
    return compare.min_cluster_curve(_sizes(c, 4), ["aoi"])


@query("v11_distance_histogram", """SELECT aoi, CASE WHEN distance >= 50 THEN 50 WHEN distance >= 20 THEN 20 WHEN distance >= 10 THEN 10 WHEN distance >= 5 THEN 5
WHEN distance >= 3 THEN 3 WHEN distance >= 2 THEN 2 WHEN distance >= 1 THEN 1 ELSE 0 END AS bin_from, count(*) AS n_cells
FROM distances WHERE member = 'only_new' GROUP BY ALL""")
def _(c):
    return compare.distance_histogram(compare.distance_groups(c.stored_strip_pairs, ["aoi"]), ["aoi"])


@query("v11_distance_stats", """SELECT aoi, member, count(*) AS n_cells, avg(distance) AS mean_distance, median(distance) AS median_distance,
max(distance) AS max_distance FROM distances GROUP BY ALL""", "mean_distance median_distance max_distance")
def _(c):
    return compare.distance_stats(compare.distance_groups(c.stored_strip_pairs, ["aoi"]), ["aoi"])


@query("v12_qa_stratify", f"""SELECT aoi, burn_qa, count(*) AS n_burned, {COUNTS},
CASE burn_qa & 3 WHEN 0 THEN 'water' WHEN 1 THEN 'land' WHEN 2 THEN 'barren' ELSE 'other' END AS land_water, (burn_qa >> 2) & 1 AS valid_burn,
(burn_qa >> 3) & 1 AS shortened, (burn_qa >> 4) & 1 AS special, (burn_qa >> 5) & 1 AS "grouped" FROM strip_pairs WHERE doy_new > 0 GROUP BY aoi, burn_qa""")
def _(c):
    return compare.qa_stratify(c.strip_pairs, ["aoi"])


@query("v13_reliable_window", f"""SELECT aoi, first_day > 0 AND last_day > 0 AND first_day <= doy_new AND doy_new <= last_day AS in_window,
count(*) AS n_burned, {COUNTS} FROM strip_pairs WHERE doy_new > 0 GROUP BY ALL""")
def _(c):
    return compare.reliable_window(c.strip_pairs, ["aoi"])


@query("v14_edge_effect", """SELECT aoi, count(*) AS n_only_new, count(*) FILTER (votes < 13) AS n_edge, count(*) FILTER (votes = 13) AS n_interior FROM (
SELECT a.aoi, a.row_idx, a.col_idx, count(*) AS votes FROM strip_new a JOIN strip_new b
ON a.aoi = b.aoi AND abs(a.row_idx - b.row_idx) + abs(a.col_idx - b.col_idx) <= 2 GROUP BY ALL)
JOIN (SELECT aoi, row_idx, col_idx FROM strip_pairs WHERE member = 'only_new') USING (aoi, row_idx, col_idx) GROUP BY ALL""")
def _(c):
    return compare.edge_effect(c.stored_strip_pairs, c.stored_strip_pairs, ["aoi"])


@query("v15_inside_outside", """SELECT *, n_cells - n_inside AS n_outside, 100.0::DOUBLE * n_inside / n_cells AS pct_inside,
CASE WHEN n_inside = n_cells THEN 'all_inside' WHEN (n_cells - n_inside) / n_cells < 0.05 THEN 'marginal' ELSE 'significant' END AS verdict FROM (
SELECT aoi, member, count(*) AS n_cells, count(layer) AS n_inside FROM burn_pairs
LEFT JOIN (SELECT * FROM touched WHERE layer = 'aoi') USING (row_idx, col_idx) WHERE member IS NOT NULL GROUP BY ALL)""", "pct_inside")
def _(c):
    edges = c.edges.where("layer = 'aoi'")
    spans = spatial.polygon_spans(edges, c.grid).unionByName(spatial.touched_spans(edges, c.grid))
    return compare.inside_outside(c.burn_pairs, spans, ["aoi"])


@query("v16_clip_verdict", f"""SELECT *, CASE WHEN outside_valued + outside_nodata = 0 THEN 'no outside cells' WHEN outside_valued = 0 THEN 'polygon clip'
WHEN outside_nodata = 0 THEN 'bbox clip only' ELSE 'partial polygon clip' END AS verdict FROM (
SELECT {S}, year, month, count(*) FILTER (layer IS NOT NULL AND value IS NOT NULL) AS inside_valued,
count(*) FILTER (layer IS NOT NULL AND value IS NULL) AS inside_nodata, count(*) FILTER (layer IS NULL AND value IS NOT NULL) AS outside_valued,
count(*) FILTER (layer IS NULL AND value IS NULL) AS outside_nodata
FROM cells LEFT JOIN (SELECT * FROM inside WHERE layer = 'aoi') USING (row_idx, col_idx) GROUP BY ALL)""")
def _(c):
    return compare.clip_verdict(c.cells, c.aoi_spans, MONTH)


@query("v17_mean_shift", """SELECT *, abs(shift) > 0.2 OR opposed AS anomalous FROM (
SELECT *, min(shift) OVER w < 0 AND max(shift) OVER w > 0 AND max(shift) OVER w - min(shift) OVER w > 0.05 AS opposed FROM (
SELECT sensor, aoi, new_mean, ref_mean, new_mean - ref_mean AS shift FROM (SELECT sensor, aoi, avg(value) AS new_mean FROM cells GROUP BY ALL)
JOIN (SELECT sensor, aoi, avg(value) AS ref_mean FROM old_cells GROUP BY ALL) USING (sensor, aoi)) WINDOW w AS (PARTITION BY sensor))""",
       "new_mean ref_mean shift")
def _(c):
    new, old = c.new_and_old_cells
    reference = old.groupBy("sensor", "aoi").agg(F.avg("value").alias("ref_mean"))
    return compare.mean_shift(new, reference, ["aoi"], ["sensor"])


# Expected agreement of the registered check.
EXPECTED = (0.95, 0.02)


@query("v18_regression_baselines", f"""SELECT {S}, year, month, exp_corr, exp_mad, correlation, mean_abs_diff,
coalesce(abs(correlation - exp_corr) <= 0.005, false) AS corr_ok, coalesce(abs(mean_abs_diff - exp_mad) <= 0.005, false) AS mad_ok,
coalesce(correlation >= 0.9, false) AS spot_ok FROM (SELECT {S}, year, month, 0.95::DOUBLE AS exp_corr, 0.02::DOUBLE AS exp_mad FROM a1)
LEFT JOIN v1 USING ({S}, year, month)""", "exp_corr exp_mad correlation mean_abs_diff")
def _(c):
    corr, mad = EXPECTED
    expected = monthly.ndvi_monthly(c.new_and_old_cells[0]).select(*MONTH, F.lit(corr).alias("exp_corr"), F.lit(mad).alias("exp_mad"))
    return compare.regression_baselines(_v1(c), expected, MONTH)


@query("v19_sample_spaced", """SELECT aoi, CAST(i AS INT) AS sample, row_idx, col_idx FROM (
SELECT aoi, row_idx, col_idx, row_number() OVER (PARTITION BY aoi ORDER BY row_idx, col_idx) - 1 AS rk FROM strip_pairs WHERE member = 'only_new')
JOIN (SELECT aoi, i.range AS i, CAST(floor(i.range * ((n - 1) / (least(8, n) - 1))) AS BIGINT) AS rk FROM (
SELECT aoi, count(*) AS n FROM strip_pairs WHERE member = 'only_new' GROUP BY ALL) CROSS JOIN range(8) i) USING (aoi, rk)""")
def _(c):
    return compare.sample_spaced(c.stored_strip_pairs.where(compare.membership() == "only_new"), ["aoi"], 8)


@query("v19_sample_seeded", """SELECT aoi, row_idx, col_idx, member FROM (SELECT *, row_number() OVER (PARTITION BY aoi, member
ORDER BY md5(concat_ws('|', '42', aoi, row_idx, col_idx))) AS rn FROM strip_pairs WHERE member IS NOT NULL) WHERE rn <= 5""")
def _(c):
    rows = c.strip_pairs.withColumn("member", compare.membership()).where("member IS NOT NULL").select("aoi", "row_idx", "col_idx", "member")
    return compare.sample_seeded(rows, ["aoi", "member"], ["aoi", "row_idx", "col_idx"], 5)
