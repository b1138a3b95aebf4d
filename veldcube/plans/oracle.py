"""The same results as plain SQL over the given tables, for an independent check.

`CTE` holds named fragments; `sql()` prefixes a final SELECT with the fragments it needs.
"""

from __future__ import annotations

import math
import re

from veldcube.functions import columns, fixed
from veldcube.sources import dims


def _values(rows, columns_):
    body = ", ".join("(" + ", ".join(repr(v) if not isinstance(v, str) else f"'{v}'" for v in r) + ")" for r in rows)
    return f"SELECT * FROM (VALUES {body}) AS t({columns_})"


def _adapter(row, col):
    return f"""
SELECT r_name AS aoi, 'sentinel2' AS sensor, 500 AS resolution, l_shipdate AS acq_ts,
       CAST(year(l_shipdate) AS INT) AS year, CAST(month(l_shipdate) AS INT) AS month,
       CAST({row} AS INT) AS row_idx, CAST({col} AS INT) AS col_idx,
       l_extendedprice / 1000 AS b8, l_quantity AS b4,
       CAST((l_suppkey * 3 + l_linenumber) % 12 AS INT) AS scl,
       CAST((l_suppkey + l_linenumber * 3) % 4 AS INT) AS summary_qa,
       CAST((l_suppkey * 97 + l_linenumber * 1009) % 10001 AS INT) AS ndvi_raw,
       l_discount * 1000 AS cloud_pct,
       CAST(CASE WHEN l_returnflag = 'R' AND l_discount >= 0.08 THEN dayofyear(l_shipdate) ELSE 0 END AS INT) AS burn_date,
       CAST(dayofyear(l_shipdate) - (l_linenumber % 5) + 1 AS INT) AS first_day,
       CAST(dayofyear(l_shipdate) + 5 AS INT) AS last_day,
       CAST(l_suppkey % 64 AS INT) AS burn_qa
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"""


def _area(lat_top, lat_bot, dx):
    e2, e = columns.E2, columns.ECC

    def q(lat):
        s = f"sin(radians({lat}))"
        return f"({s} / (1 - {e2!r} * {s} * {s}) + {1 / (2 * e)!r} * ln((1 + {e!r} * {s}) / (1 - {e!r} * {s})))"

    return f"abs({columns.B ** 2 / 2!r} * radians({dx}) * ({q(lat_top)} - {q(lat_bot)})) / 1e6"


def _pvalue(z):
    x = f"(abs({z}) / {math.sqrt(2.0)!r})"
    t = f"(1.0 / (1.0 + 0.5 * {x}))"
    c = [-1.26551223, 1.00002368, 0.37409196, 0.09678418, -0.18628806,
         0.27886807, -1.13520398, 1.48851587, -0.82215223, 0.17087277]
    poly = repr(c[-1])
    for v in reversed(c[:-1]):
        poly = f"({v!r} + {t} * {poly})"
    return f"({t} * exp(-{x} * {x} + {poly}))"


G = dims.BLOCK_GRID
_MASK = ", ".join(map(str, fixed.MASKED_SCL))
_LEGACY = ", ".join(map(str, fixed.LEGACY_MASKED_SCL))
_NDVI = "CASE WHEN b8 + b4 <> 0 THEN (b8 - b4) / (b8 + b4) END"
_CM = "aoi, sensor, resolution, year, month, row_idx, col_idx"
_S = "aoi, sensor, resolution"
_ORDER = "acq_ts, b8, b4, scl, burn_date, burn_qa"
_DESC = ", ".join(f"{c} DESC" for c in _ORDER.split(", "))
_ROW_AREA = _area(f"{G['north']} + row_idx * ({G['dy']})", f"({G['north']} + row_idx * ({G['dy']})) + ({G['dy']})", G["dx"])

_T = dims.STRIP_GRID
STRIP_ROW_AREA = _area(f"{_T['north']} + row_idx * ({_T['dy']})", f"({_T['north']} + row_idx * ({_T['dy']})) + ({_T['dy']})", _T["dx"])


def _burns(obs, order):
    return f"""SELECT aoi, 'burned_area' AS sensor, resolution, year, month, row_idx, col_idx, burn_date, first_day, last_day, burn_qa
FROM (SELECT *, row_number() OVER (PARTITION BY {_CM} ORDER BY {order}) AS rn FROM {obs}) WHERE rn = 1"""


def _burn_counts(burns):
    return f"""SELECT aoi, resolution, row_idx, col_idx, CAST(sum(burned) AS INT) AS burn_count, n_years FROM (
 SELECT aoi, resolution, row_idx, col_idx, year, max(CASE WHEN burn_date > 0 THEN 1 ELSE 0 END) AS burned FROM {burns} GROUP BY ALL)
JOIN (SELECT aoi, resolution, CAST(count(DISTINCT year) AS INT) AS n_years FROM {burns} GROUP BY ALL) USING (aoi, resolution)
GROUP BY ALL"""


def _frp(counts):
    # Python's half-to-even rule at one decimal.
    x = "(n_years / burn_count * 10)"
    even = f"CASE WHEN {x} - floor({x}) = 0.5 THEN 2 * round({x} / 2) ELSE round({x}) END / 10"
    return f"SELECT *, CASE WHEN burn_count > 0 THEN {even} END AS frp_years FROM {counts}"


def _reach(src, keys, me, diagonal=False):
    same = " AND ".join(f"t.{k.strip()} = n.{k.strip()}" for k in keys.split(","))
    near = "abs(t.r - n.row_idx) <= 1 AND abs(t.c - n.col_idx) <= 1" if diagonal else "abs(t.r - n.row_idx) + abs(t.c - n.col_idx) = 1"
    cols = ", ".join(f"t.{k.strip()}" for k in keys.split(","))
    return f"""SELECT {keys}, row_idx, col_idx, value, row_idx AS r, col_idx AS c FROM {src} UNION
SELECT {cols}, t.row_idx, t.col_idx, t.value, n.row_idx, n.col_idx FROM {me} t JOIN {src} n ON {same} AND t.value = n.value AND {near}"""


def _comp(reach, keys):
    return f"SELECT {keys}, row_idx, col_idx, value, min(CAST(r AS BIGINT) * 2147483648 + c) AS component_id FROM {reach} GROUP BY ALL"


def rings_sql(comp, keys):
    """Outline rings of a four-connected patch by Euler's formula: 2 - (cells - pairs + full squares)."""
    on = " AND ".join(f"a.{k.strip()} = {{}}.{k.strip()}" for k in [*keys.split(","), "component_id"])
    join = lambda t, dr, dc: f"LEFT JOIN {comp} {t} ON {on.format(*[t] * (len(keys.split(',')) + 1))} AND {t}.row_idx = a.row_idx + {dr} AND {t}.col_idx = a.col_idx + {dc}"
    cols = ", ".join(f"a.{k.strip()}" for k in [*keys.split(","), "component_id"])
    return f"""SELECT {cols}, 2 - (count(*) - count(b.row_idx) - count(d.row_idx)
+ count(CASE WHEN b.row_idx IS NOT NULL AND d.row_idx IS NOT NULL AND e.row_idx IS NOT NULL THEN 1 END)) AS n_rings,
4 * count(*) - 2 * (count(b.row_idx) + count(d.row_idx)) AS length FROM {comp} a {join('b', 0, 1)} {join('d', 1, 0)} {join('e', 1, 1)} GROUP BY ALL"""


def edge_term(lon1, lat1, lon2, lat2):
    e2, e, qp = columns.E2, columns.ECC, columns.q_pole()

    def half(lat):
        s = f"sin(radians({lat}))"
        q = f"({s} / (1 - {e2!r} * {s} * {s}) + {1 / (2 * e)!r} * ln((1 + {e!r} * {s}) / (1 - {e!r} * {s})))"
        return f"tan(asin(least(greatest({q} / {qp!r}, -1), 1)) / 2)"

    t1, t2 = half(lat1), half(lat2)
    return f"({columns.B ** 2 * qp / 1e6!r} * atan2(tan(radians({lon2} - ({lon1})) / 2) * ({t1} + {t2}), 1 + {t1} * {t2}))"


_PROFILE = (
    "profile_order, profile_key, land_cover, green_up_lo, green_up_hi, baseline_month, green_up_threshold, "
    "conf_lo_min, peak_lo, peak_hi, peak_delta, sen_lo, sen_hi, sen_threshold"
)
_KEYS = list(dict.fromkeys(p[0] for p in dims.PHENOLOGY_PROFILES))
_MK_Z = "CASE WHEN s > 0 THEN (s - 1) / sqrt(nullif(v, 0)) WHEN s < 0 THEN (s + 1) / sqrt(nullif(v, 0)) ELSE 0 END"
_TIES = "(n * (n - 1.0) * (2 * n + 5) - coalesce(ties, 0)) / 18"

CTE: dict[str, str] = {
    "obs": _adapter("l_orderkey % 8", "l_partkey % 8"),
    "strip_obs": _adapter(
        "(l_orderkey // 64) % 20000", "l_partkey % 8 + 8 * ((l_orderkey // 64) // 20000)"
    ),
    "aois": _values([(a,) for a in dims.AOIS], "aoi"),
    "classes": _values([(i, c) for i, c in enumerate(fixed.LAND_COVER)], "class_no, land_cover"),
    "cells": f"""SELECT {_CM}, median(CASE WHEN scl NOT IN ({_MASK}) THEN {_NDVI} END) AS value
FROM obs WHERE cloud_pct < 100 GROUP BY ALL""",
    "old_cells": f"""SELECT {_CM}, max(CASE WHEN rn = 1 THEN v END) AS value FROM (
 SELECT *, row_number() OVER (PARTITION BY {_CM} ORDER BY (v IS NULL), {_DESC}) AS rn FROM (
  SELECT *, CASE WHEN scl NOT IN ({_LEGACY}) THEN {_NDVI} END AS v FROM obs WHERE cloud_pct < 100)) GROUP BY ALL""",
    "burns": _burns("obs", _ORDER),
    "old_burns": _burns("obs", _DESC),
    "strip_burns": _burns("strip_obs", _ORDER),
    "old_strip_burns": _burns("strip_obs", _DESC),
    "a1": f"""SELECT {_S}, year, month, avg(value) AS mean_ndvi, CAST(count(value) AS INT) AS n_valid_px
FROM cells GROUP BY ALL""",
    "a2": f"""SELECT {_S}, month, min(mean_ndvi) AS ts_lower, max(mean_ndvi) AS ts_upper, avg(mean_ndvi) AS climatology,
stddev_samp(mean_ndvi) AS hist_std, CAST(count(mean_ndvi) AS INT) AS n_years FROM a1 GROUP BY ALL""",
    "a3": f"""SELECT {_S}, year, avg(mean_ndvi) AS mean_ndvi, CAST(count(*) AS INT) AS n_months, count(*) = 12 AS is_complete
FROM a1 GROUP BY ALL""",
    "complete_years": f"""SELECT {_S}, year, mean_ndvi AS x, row_number() OVER (PARTITION BY {_S} ORDER BY year) AS i
FROM a3 WHERE is_complete""",
    "mk_pairs": f"""SELECT a.aoi, a.sensor, a.resolution, sum(sign(b.x - a.x)) AS s,
median((b.x - a.x) / (b.i - a.i)) AS sen_slope
FROM complete_years a JOIN complete_years b ON a.aoi = b.aoi AND a.sensor = b.sensor AND a.resolution = b.resolution AND a.i < b.i
GROUP BY ALL""",
    "mk_ties": f"""SELECT {_S}, sum(n) AS n, sum(n * (n - 1.0) * (2 * n + 5)) AS ties FROM (
SELECT {_S}, x, count(*) AS n FROM complete_years GROUP BY ALL) GROUP BY ALL""",
    "mk": f"""SELECT {_S}, s, v, sen_slope, n, {_pvalue(_MK_Z)} AS mk_p FROM (
SELECT {_S}, n, s, sen_slope, {_TIES} AS v FROM mk_pairs JOIN mk_ties USING ({_S}))""",
    "mk_label": """SELECT *, CASE WHEN mk_p < 0.05 THEN CASE WHEN sen_slope < 0 THEN 'decreasing' ELSE 'increasing' END
ELSE 'no_trend' END AS trend_direction FROM mk WHERE n >= 5""",
    "ranges": f"""SELECT {_S}, n_complete_years, CASE WHEN n_complete_years >= 5 THEN q1 END AS q1_ndvi,
CASE WHEN n_complete_years >= 5 THEN q3 END AS q3_ndvi, CASE WHEN n_complete_years >= 5 THEN lo END AS min_ndvi,
CASE WHEN n_complete_years >= 5 THEN hi END AS max_ndvi, CASE WHEN n_complete_years >= 5 THEN m END AS long_term_avg FROM (
SELECT {_S}, CAST(count(*) AS INT) AS n_complete_years, quantile_cont(mean_ndvi, 0.25) AS q1, quantile_cont(mean_ndvi, 0.75) AS q3,
min(mean_ndvi) AS lo, max(mean_ndvi) AS hi, avg(mean_ndvi) AS m FROM a3 WHERE is_complete GROUP BY ALL)""",
    "seasons": f"""SELECT {_S}, mean_ndvi AS x, p % 12 AS season, p // 12 AS i FROM (
SELECT *, row_number() OVER (PARTITION BY {_S} ORDER BY year, month) - 1 AS p FROM a1 WHERE mean_ndvi IS NOT NULL)""",
    "smk_pairs": f"""SELECT a.aoi, a.sensor, a.resolution, sum(sign(b.x - a.x)) AS s, median((b.x - a.x) / (b.i - a.i)) AS slope
FROM seasons a JOIN seasons b ON a.aoi = b.aoi AND a.sensor = b.sensor AND a.resolution = b.resolution
AND a.season = b.season AND a.i < b.i GROUP BY ALL""",
    "smk_var": f"""SELECT {_S}, sum(m) AS n_points, sum({_TIES}) AS v FROM (
SELECT {_S}, season, sum(n) AS n, sum(n) AS m, sum(n * (n - 1.0) * (2 * n + 5)) AS ties FROM (
SELECT {_S}, season, x, count(*) AS n FROM seasons GROUP BY ALL) GROUP BY ALL) GROUP BY ALL""",
    "smk": f"""SELECT {_S}, CAST(n_points AS INT) AS n_points, s AS smk_s, v AS smk_var, slope AS smk_sen_slope, {_pvalue(_MK_Z)} AS smk_p
FROM smk_pairs JOIN smk_var USING ({_S}) WHERE n_points >= 60""",
    "trend_stats": f"""SELECT {_S}, n_complete_years, mk_p, sen_slope, coalesce(trend_direction, 'insufficient_data') AS trend_direction,
q1_ndvi, q3_ndvi, min_ndvi, max_ndvi, long_term_avg, smk_p, smk_sen_slope
FROM (SELECT {_S}, CAST(sum(CASE WHEN is_complete THEN 1 ELSE 0 END) AS INT) AS n_complete_years FROM a3 GROUP BY ALL)
LEFT JOIN mk_label USING ({_S}) LEFT JOIN (SELECT * EXCLUDE (n_complete_years) FROM ranges) USING ({_S}) LEFT JOIN smk USING ({_S})""",
    "class_cells": """SELECT r.row_idx, c.col_idx, land_cover FROM (SELECT CAST(range AS INT) AS row_idx FROM range(8)) r
CROSS JOIN (SELECT CAST(range AS INT) AS col_idx FROM range(8)) c JOIN classes ON (row_idx * 8 + col_idx) % 7 = class_no""",
    "a7": f"""SELECT {_S}, year, month, land_cover, avg(value) AS mean_ndvi, CAST(count(value) AS INT) AS n_valid_px FROM (
SELECT DISTINCT {_S}, year, month, land_cover FROM cells CROSS JOIN classes)
LEFT JOIN (SELECT {_S}, year, month, land_cover, value FROM cells JOIN class_cells USING (row_idx, col_idx))
USING ({_S}, year, month, land_cover) GROUP BY ALL""",
    "a8": f"""SELECT {_S}, land_cover, month, m AS lc_mean, m - 1.96 * (sd / sqrt(n)) AS lc_lower_ci, m + 1.96 * (sd / sqrt(n)) AS lc_upper_ci,
m AS hist_mean, sd AS hist_sd, CAST(n AS INT) AS n_years FROM (
SELECT {_S}, land_cover, month, avg(y) AS m, stddev_samp(y) AS sd, count(y) AS n FROM (
SELECT {_S}, land_cover, month, year, avg(mean_ndvi) AS y FROM a7 GROUP BY ALL) GROUP BY ALL)""",
    "a9": f"""SELECT aoi, resolution, year, month, burned_km2, m AS ba_mean,
CASE WHEN m - 1.96 * (sd / sqrt(n)) < 0 THEN 0 ELSE m - 1.96 * (sd / sqrt(n)) END AS ba_lower_ci, m + 1.96 * (sd / sqrt(n)) AS ba_upper_ci,
CAST(n AS INT) AS n_years FROM ba_months JOIN (
SELECT aoi, resolution, month, avg(burned_km2) AS m, stddev_samp(burned_km2) AS sd, count(*) AS n FROM ba_months GROUP BY ALL)
USING (aoi, resolution, month)""",
    "ba_months": f"""SELECT aoi, resolution, year, month, coalesce(sum(CASE WHEN burn_date > 0 THEN {_ROW_AREA} END), 0) AS burned_km2
FROM burns GROUP BY ALL""",
    "a10": """SELECT aoi, resolution, year, CAST(make_date(year, 1, 1) + (burn_date - 1) AS DATE) AS date, n * 0.25 AS burned_km2 FROM (
SELECT aoi, resolution, year, month, burn_date, count(*) AS n FROM burns WHERE burn_date > 0 GROUP BY ALL)""",
    "a11": f"""SELECT {_S}, year, month, land_cover, mean_ndvi - hist_mean AS anomaly_value, mean_ndvi, hist_mean
FROM a7 JOIN (SELECT {_S}, land_cover, month, hist_mean FROM a8) USING ({_S}, land_cover, month)""",
    "b1_means": f"SELECT {_S}, year, land_cover, avg(mean_ndvi) AS annual_mean FROM a7 GROUP BY ALL",
    "b1": f"""SELECT *, CASE WHEN hist_mean_all <> 0 THEN hist_sd / abs(hist_mean_all) END AS cv FROM b1_means JOIN (
SELECT {_S}, land_cover, min(annual_mean) AS hist_min, max(annual_mean) AS hist_max, avg(annual_mean) AS hist_mean_all,
stddev_samp(annual_mean) AS hist_sd FROM b1_means GROUP BY ALL) USING ({_S}, land_cover)""",
    "b2": f"""SELECT * FROM a11 SEMI JOIN (SELECT {_S}, year FROM (SELECT DISTINCT {_S}, year, month, land_cover FROM a11)
JOIN (SELECT {_S}, count(DISTINCT land_cover) AS k FROM a11 GROUP BY ALL) USING ({_S})
GROUP BY {_S}, year, k HAVING count(*) = 12 * k) USING ({_S}, year)""",
    "b3": f"""SELECT {_S}, year, land_cover, anomaly_value AS max_deficit, month AS deficit_month FROM (
SELECT *, row_number() OVER (PARTITION BY {_S}, year, land_cover ORDER BY anomaly_value, month) AS rn FROM b2
WHERE anomaly_value IS NOT NULL) WHERE rn = 1""",
    "near_months": f"""SELECT {_S}, year, land_cover, month AS near_month FROM b2 JOIN a8 USING ({_S}, land_cover, month)
WHERE abs(b2.mean_ndvi - b2.hist_mean) <= a8.hist_sd""",
    "recovered": f"""SELECT {_S}, year, land_cover, max_deficit, deficit_month,
CAST(min(CASE WHEN near_month > deficit_month THEN near_month - deficit_month END) AS INT) AS recovery_months
FROM b3 LEFT JOIN near_months USING ({_S}, year, land_cover) GROUP BY {_S}, year, land_cover, max_deficit, deficit_month""",
    "b7": f"""SELECT {_S}, year AS anomaly_year, land_cover, max_deficit, deficit_month, recovery_months, resilience_score,
CAST(rank() OVER (PARTITION BY {_S}, year ORDER BY resilience_score) AS INT) AS resilience_rank,
CASE WHEN max_deficit < -0.15 THEN 'Severe' WHEN max_deficit < -0.10 THEN 'Moderate' WHEN max_deficit < -0.05 THEN 'Mild'
ELSE 'Minimal' END AS severity FROM (
SELECT *, abs(max_deficit) * coalesce(recovery_months, 2 * max(recovery_months) OVER (PARTITION BY {_S}, year), 12) AS resilience_score
FROM recovered)""",
    "profiles": _values([(_KEYS.index(p[0]), *p) for p in dims.PHENOLOGY_PROFILES], _PROFILE),
    "profiled": f"""SELECT a7.*, p.* EXCLUDE (profile_order, profile_key, land_cover) FROM a7 JOIN profiles p
ON starts_with(a7.aoi, p.profile_key) AND a7.land_cover = p.land_cover
WHERE p.profile_order = (SELECT min(q.profile_order) FROM profiles q WHERE starts_with(a7.aoi, q.profile_key))""",
    "pheno_usual": f"SELECT {_S}, land_cover, month AS peak_month, avg(mean_ndvi) AS usual FROM profiled GROUP BY ALL",
    "pheno_base": f"""SELECT {_S}, year, land_cover, max(CASE WHEN month = baseline_month THEN mean_ndvi END) AS base,
max(green_up_threshold) AS thr, max(conf_lo_min) AS lo_min, max(peak_delta) AS delta,
min(CASE WHEN month BETWEEN sen_lo AND sen_hi AND mean_ndvi < sen_threshold THEN month END) AS senescence_month
FROM profiled GROUP BY ALL""",
    "pheno_peak": f"""SELECT {_S}, year, land_cover, month AS peak_month, mean_ndvi AS peak_ndvi FROM (
SELECT *, row_number() OVER (PARTITION BY {_S}, year, land_cover ORDER BY mean_ndvi DESC, month) AS rn FROM profiled
WHERE month BETWEEN peak_lo AND peak_hi AND mean_ndvi IS NOT NULL) WHERE rn = 1""",
    "pheno_green": f"""SELECT {_S}, year, land_cover, max(mean_ndvi) AS top,
min(CASE WHEN mean_ndvi > base + thr THEN month END) AS crossed, arg_min(month, (-mean_ndvi, month)) AS top_month
FROM profiled JOIN pheno_base USING ({_S}, year, land_cover)
WHERE month BETWEEN green_up_lo AND green_up_hi AND mean_ndvi IS NOT NULL GROUP BY ALL""",
    "b11": f"""SELECT *, CAST((senescence_month + 12 - green_up_month) % 12 AS INT) AS season_length FROM (
SELECT {_S}, year, land_cover,
CAST(CASE WHEN top - base >= lo_min THEN coalesce(crossed, top_month) END AS INT) AS green_up_month,
CASE WHEN top - base >= lo_min THEN CASE WHEN top - base > 2 * thr THEN 'High' WHEN top - base > thr THEN 'Medium' ELSE 'Low' END
ELSE 'Not detected' END AS green_up_conf, CAST(peak_month AS INT) AS peak_month, peak_ndvi,
CASE WHEN peak_ndvi - usual > delta THEN 'High' WHEN peak_ndvi - usual < -delta THEN 'Low' ELSE 'Medium' END AS peak_conf,
CAST(senescence_month AS INT) AS senescence_month
FROM pheno_base LEFT JOIN pheno_green USING ({_S}, year, land_cover) LEFT JOIN pheno_peak USING ({_S}, year, land_cover)
LEFT JOIN pheno_usual USING ({_S}, land_cover, peak_month))""",
    "b12": f"""SELECT {_S}, row_idx, col_idx, year, avg(value) AS annual_mean FROM cells
SEMI JOIN (SELECT {_S}, year FROM a3 WHERE is_complete) USING ({_S}, year) GROUP BY ALL""",
    "b13_pairs": f"""SELECT x.aoi, x.sensor, x.resolution, x.year AS year_a, y.year AS year_b, y.annual_mean - x.annual_mean AS d,
{_ROW_AREA.replace('row_idx', 'x.row_idx')} AS area FROM b12 x JOIN b12 y ON x.aoi = y.aoi AND x.sensor = y.sensor AND x.resolution = y.resolution
AND x.row_idx = y.row_idx AND x.col_idx = y.col_idx AND x.year <> y.year""",
    "b13": f"""SELECT c.aoi, c.sensor, c.resolution, c.year_a, c.year_b, coalesce(gain_km2, 0) AS gain_km2,
coalesce(loss_km2, 0) AS loss_km2, coalesce(total_km2, 0) AS total_km2 FROM (
SELECT a.aoi, a.sensor, a.resolution, a.year AS year_a, b.year AS year_b FROM complete_years a JOIN complete_years b
ON a.aoi = b.aoi AND a.sensor = b.sensor AND a.resolution = b.resolution AND a.year <> b.year) c
LEFT JOIN (SELECT {_S}, year_a, year_b, sum(CASE WHEN d > 0 THEN area ELSE 0 END) AS gain_km2,
sum(CASE WHEN d < 0 THEN area ELSE 0 END) AS loss_km2, sum(area) AS total_km2 FROM b13_pairs WHERE d IS NOT NULL GROUP BY ALL) s
ON c.aoi = s.aoi AND c.sensor = s.sensor AND c.resolution = s.resolution AND c.year_a = s.year_a AND c.year_b = s.year_b""",
    "b14": _burn_counts("burns"),
    "strip_counts": _burn_counts("strip_burns"),
    "b15": _frp("b14"),
    "strip_frp": _frp("strip_counts"),
    "requests": """SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN 'sentinel2' WHEN 1 THEN 'modis' WHEN 2 THEN 'burned_area' ELSE 'other' END AS sensor,
CASE o_custkey % 5 WHEN 0 THEN '250' WHEN 1 THEN '0' ELSE 'auto' END AS resolution,
CASE WHEN o_custkey % 7 <> 0 THEN strftime(o_orderdate, '%Y-%m') END AS "start",
strftime(CAST(o_orderdate AS DATE) + to_months(CAST(o_custkey % 120 AS INT)), '%Y-%m') AS "end" FROM orders""",
    "run_log": """SELECT CASE WHEN o_custkey % 11 <> 0 THEN o_orderdate END AS run_timestamp, o_orderstatus = 'F' AS pass_a_ran,
CAST(o_custkey % 3 AS INT) AS new_months_fetched, o_orderstatus = 'F' AND starts_with(o_orderpriority, '1') AS pass_b_ran,
CAST(year(o_orderdate) - 2 AS INT) AS new_year_detected,
CASE WHEN o_orderstatus = 'F' THEN 'success' ELSE 'error' END AS status, CASE WHEN o_orderstatus <> 'F' THEN 'fetch failed' END AS error_message FROM orders""",
    "months": """SELECT aoi, sensor, resolution, year, month FROM a1 UNION ALL
SELECT aoi, 'burned_area' AS sensor, resolution, year, month FROM ba_months""",
    "prior_years": f"""SELECT {_S}, year, month, mean_ndvi, min(mean_ndvi) OVER w AS lower, max(mean_ndvi) OVER w AS upper,
avg(mean_ndvi) OVER w AS climatology, mean_ndvi - avg(mean_ndvi) OVER w AS anomaly FROM a1
WINDOW w AS (PARTITION BY {_S}, month ORDER BY year ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)""",
    "rank_sums": """SELECT m, v, count(*) / pow(2, m) AS pr FROM (
SELECT m.range AS m, mask.range AS mask, sum(CASE WHEN (mask.range >> (i.range - 1)) & 1 = 1 THEN i.range ELSE 0 END) AS v
FROM range(1, 13) m JOIN range(4096) mask ON mask.range < pow(2, m.range) CROSS JOIN range(1, 13) i GROUP BY m.range, mask.range)
GROUP BY m, v""",
    "rank_tails": """SELECT m, v, sum(pr) OVER (PARTITION BY m ORDER BY v) AS low, sum(pr) OVER (PARTITION BY m ORDER BY v DESC) AS high FROM rank_sums""",
    "wilcoxon": f"""SELECT {_S}, year, n, median_anomaly,
CASE WHEN tie = 0 AND k = n THEN least(2 * least(low, high), 1) ELSE {_pvalue('z')} END AS wilcox_p FROM (
SELECT {_S}, year, n, median_anomaly, k, tie, v, (v - e - sign(v - e) * 0.5) / sqrt(nullif(q - tie, 0)) AS z FROM (
SELECT {_S}, year, count(*) AS n, median(anomaly) AS median_anomaly FROM prior_years WHERE anomaly IS NOT NULL GROUP BY ALL HAVING count(*) >= 3)
LEFT JOIN (SELECT {_S}, year, sum(CASE WHEN anomaly > 0 THEN r ELSE 0 END) AS v, count(*) AS k, count(*) * (count(*) + 1) / 4 AS e,
count(*) * (count(*) + 1) * (2 * count(*) + 1) / 24 AS q, sum((t * t - 1) / 48) AS tie FROM (
SELECT *, rank() OVER (PARTITION BY {_S}, year ORDER BY abs(anomaly)) + (t - 1) / 2 AS r FROM (
SELECT *, count(*) OVER (PARTITION BY {_S}, year, abs(anomaly)) AS t FROM prior_years WHERE anomaly <> 0)) GROUP BY {_S}, year)
USING ({_S}, year)) x LEFT JOIN rank_tails t ON t.m = x.k AND t.v = x.v""",
    "norm_delta": f"""SELECT {_S}, year, month, row_idx, col_idx, (value - train) / nullif(value + train, 0) AS delta_ndvi FROM (
SELECT *, avg(value) OVER (PARTITION BY {_S}, row_idx, col_idx, month ORDER BY year ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS train
FROM cells) WHERE train IS NOT NULL AND value IS NOT NULL""",
    "polygon_edges": _values([
        (layer, polygon, *a, *b) for (layer, polygon), rings in dims.POLYGONS.items() for ring in rings for a, b in zip(ring, ring[1:])
    ], "layer, polygon_id, lon1, lat1, lon2, lat2"),
    "grid_cells": """SELECT CAST(r.range AS INT) AS row_idx, CAST(c.range AS INT) AS col_idx, 26.0::DOUBLE + (c.range + 0.5::DOUBLE) * 0.005::DOUBLE AS x,
-14.0::DOUBLE + (r.range + 0.5::DOUBLE) * (-0.005::DOUBLE) AS y FROM range(8) r CROSS JOIN range(8) c""",
    "inside": """SELECT DISTINCT layer, row_idx, col_idx FROM (
SELECT layer, polygon_id, row_idx, col_idx FROM grid_cells CROSS JOIN polygon_edges
WHERE (lat1 <= y) <> (lat2 <= y) AND x < lon1 + (y - lat1) / (lat2 - lat1) * (lon2 - lon1)
GROUP BY ALL HAVING count(*) % 2 = 1)""",
    # Liang-Barsky clipping of every edge against every cell.
    "touched": """SELECT DISTINCT layer, row_idx, col_idx FROM (SELECT layer, row_idx, col_idx, lon1, lat1,
nullif(lon2 - lon1, 0) AS dx, nullif(lat2 - lat1, 0) AS dy, x - 0.0025 AS x0, x + 0.0025 AS x1, y - 0.0025 AS y0, y + 0.0025 AS y1
FROM grid_cells CROSS JOIN polygon_edges)
WHERE greatest(0, least((x0 - lon1) / dx, (x1 - lon1) / dx), least((y0 - lat1) / dy, (y1 - lat1) / dy))
   <= least(1, greatest((x0 - lon1) / dx, (x1 - lon1) / dx), greatest((y0 - lat1) / dy, (y1 - lat1) / dy))
UNION SELECT layer, row_idx, col_idx FROM inside""",
    "strip_new": """SELECT aoi, resolution, row_idx, col_idx, burn_date, first_day, last_day, burn_qa FROM (
SELECT *, row_number() OVER (PARTITION BY aoi, row_idx, col_idx ORDER BY burn_date DESC, first_day DESC, last_day DESC, burn_qa DESC) AS rn
FROM strip_burns) WHERE rn = 1""",
    "strip_old": "SELECT aoi, row_idx, col_idx, max(burn_date) AS old_date FROM strip_burns WHERE burn_qa & 4 = 4 GROUP BY ALL",
    "strip_pairs": """SELECT aoi, row_idx, col_idx, burn_date AS doy_new, coalesce(old_date, 0) AS doy_old, burn_qa, first_day, last_day,
CASE WHEN burn_date > 0 AND old_date > 0 THEN 'overlap' WHEN burn_date > 0 THEN 'only_new' WHEN old_date > 0 THEN 'only_old' END AS member
FROM strip_new LEFT JOIN strip_old USING (aoi, row_idx, col_idx)""",
    "row_extents": """SELECT aoi, row_idx AS polygon_id, 26.0 + min(col_idx) * 0.0005::DOUBLE AS x0, 26.0 + (max(col_idx) + 1) * 0.0005::DOUBLE AS x1,
-14.0 + row_idx * (-0.0005::DOUBLE) AS y0, -14.0 + (row_idx + 1) * (-0.0005::DOUBLE) AS y1 FROM strip_new WHERE burn_date > 0 GROUP BY aoi, row_idx""",
    "row_vertices": " UNION ALL ".join(
        f"SELECT aoi, polygon_id, {i} AS seq, {x} AS lon, {y} AS lat FROM row_extents"
        for i, (x, y) in enumerate((("x0", "y0"), ("x1", "y0"), ("x1", "y1"), ("x0", "y1"), ("x0", "y0")))
    ),
    "frp_src": "SELECT aoi, row_idx, col_idx, frp_years AS value FROM strip_frp WHERE frp_years IS NOT NULL",
    "frp_reach": _reach("frp_src", "aoi", "frp_reach"),
    "frp_comp": _comp("frp_reach", "aoi"),
    "frp_years_of": "SELECT aoi, CAST(count(DISTINCT year) AS INT) AS n_years FROM strip_burns GROUP BY ALL",
    "frp_patches": f"""SELECT aoi, component_id, frp_years, n_cells, n_rings, area_km2, n_years,
CAST(round(n_years / frp_years) AS INT) AS burn_count FROM (
SELECT aoi, component_id, value AS frp_years, count(*) AS n_cells, sum({STRIP_ROW_AREA}) AS area_km2 FROM frp_comp GROUP BY ALL)
JOIN ({rings_sql('frp_comp', 'aoi')}) USING (aoi, component_id) JOIN frp_years_of USING (aoi)""",
    "mark_src": "SELECT aoi, row_idx, col_idx, 1.0::DOUBLE AS value FROM strip_new WHERE burn_date > 0",
    "mark4_reach": _reach("mark_src", "aoi", "mark4_reach"),
    "mark4": _comp("mark4_reach", "aoi"),
    "mark8_reach": _reach("mark_src", "aoi", "mark8_reach", True),
    "mark8": _comp("mark8_reach", "aoi"),
    "sizes4": """SELECT aoi, component_id, count(*) AS size, count(*) FILTER (member = 'overlap') AS n_old
FROM mark4 JOIN strip_pairs USING (aoi, row_idx, col_idx) GROUP BY ALL""",
    "sizes8": """SELECT aoi, component_id, count(*) AS size, count(*) FILTER (member = 'overlap') AS n_old
FROM mark8 JOIN strip_pairs USING (aoi, row_idx, col_idx) GROUP BY ALL""",
    "month_src": "SELECT aoi, year, month, row_idx, col_idx, burn_date AS value FROM burns WHERE burn_date > 0",
    "month_reach": _reach("month_src", "aoi, year, month", "month_reach"),
    "month_comp": _comp("month_reach", "aoi, year, month"),
    "cover_src": """SELECT DISTINCT aoi, row_idx, col_idx, CAST((row_idx // 4 + col_idx // 4) % 7 AS DOUBLE) AS value FROM strip_burns""",
    "cover_reach": _reach("cover_src", "aoi", "cover_reach"),
    "cover_comp": _comp("cover_reach", "aoi"),
    "distances": """SELECT n.aoi, n.row_idx, n.col_idx, n.member,
min(sqrt((n.row_idx - o.row_idx) * (n.row_idx - o.row_idx) + (n.col_idx - o.col_idx) * (n.col_idx - o.col_idx))) AS distance
FROM strip_pairs n JOIN strip_pairs o ON n.aoi = o.aoi WHERE n.doy_new > 0 AND o.doy_old > 0 GROUP BY ALL""",
    "burn_pairs": """SELECT aoi, resolution, year, month, row_idx, col_idx, n.burn_date AS doy_new, o.burn_date AS doy_old,
CASE WHEN n.burn_date > 0 AND o.burn_date > 0 THEN 'overlap' WHEN n.burn_date > 0 THEN 'only_new' WHEN o.burn_date > 0 THEN 'only_old' END AS member
FROM burns n JOIN old_burns o USING (aoi, resolution, year, month, row_idx, col_idx)""",
    "burn_any": "SELECT aoi, year, month, row_idx, col_idx, max(burn_date) AS any_date FROM obs GROUP BY ALL",
    "burn_sources": """SELECT aoi, year, month, row_idx, col_idx, doy_new AS first_date, doy_old AS last_date, any_date
FROM burn_pairs JOIN burn_any USING (aoi, year, month, row_idx, col_idx)""",
    "burn_long": """SELECT aoi, 'first' AS source, year, month, row_idx, col_idx, first_date AS doy FROM burn_sources WHERE first_date > 0
UNION ALL SELECT aoi, 'last' AS source, year, month, row_idx, col_idx, last_date FROM burn_sources WHERE last_date > 0
UNION ALL SELECT aoi, 'any' AS source, year, month, row_idx, col_idx, any_date FROM burn_sources WHERE any_date > 0""",
    "match_pairs": """SELECT aoi, source_a, source_b, n_a, n_b, coalesce(n_overlap, 0) AS n_overlap, mad_days,
n_a - coalesce(n_overlap, 0) AS n_only_a, n_b - coalesce(n_overlap, 0) AS n_only_b,
100.0::DOUBLE * coalesce(n_overlap, 0) / n_a AS pct_a_captured, 100.0::DOUBLE * coalesce(n_overlap, 0) / n_b AS pct_b_captured,
coalesce(n_overlap, 0) / (n_a + n_b - coalesce(n_overlap, 0)) AS jaccard FROM (
SELECT aoi, source AS source_a, count(*) AS n_a FROM burn_long GROUP BY ALL) JOIN (SELECT aoi, source AS source_b, count(*) AS n_b FROM burn_long GROUP BY ALL) USING (aoi)
LEFT JOIN (SELECT a.aoi, a.source AS source_a, b.source AS source_b, count(*) AS n_overlap, avg(abs(a.doy - b.doy)) AS mad_days
FROM burn_long a JOIN burn_long b ON a.aoi = b.aoi AND a.year = b.year AND a.month = b.month AND a.row_idx = b.row_idx AND a.col_idx = b.col_idx GROUP BY ALL)
USING (aoi, source_a, source_b) WHERE (source_a = 'first' AND source_b <> 'first') OR (source_a = 'last' AND source_b = 'any')""",
    "cell_pairs": f"""SELECT {_CM}, n.value AS a, o.value AS b, abs(n.value - o.value) AS d FROM cells n FULL JOIN old_cells o USING ({_CM})""",
    "v1": f"""SELECT {_S}, year, month, count(a) AS n_valid_new, avg(a) AS mean_new, stddev_pop(a) AS std_new, min(a) AS min_new, max(a) AS max_new,
count(b) AS n_valid_old, avg(b) AS mean_old, stddev_pop(b) AS std_old, min(b) AS min_old, max(b) AS max_old, count(d) AS n_overlapping,
CASE WHEN count(d) >= 10 THEN corr(a, b) END AS correlation, CASE WHEN count(d) >= 10 THEN avg(d) END AS mean_abs_diff,
CASE WHEN count(d) >= 10 THEN 100.0::DOUBLE * count(*) FILTER (d > 0.05) / count(d) END AS pct_diff_gt_005,
CASE WHEN count(d) >= 10 THEN 100.0::DOUBLE * count(*) FILTER (d > 0.10) / count(d) END AS pct_diff_gt_010,
CASE WHEN count(d) >= 10 THEN median(d) END AS median_abs_diff FROM cell_pairs GROUP BY ALL""",
    "ratios": """SELECT *, n_new / nullif(n_old, 0) AS ratio FROM (
SELECT aoi, year, count(*) FILTER (doy_new > 0) AS n_new, count(*) FILTER (doy_old > 0) AS n_old FROM burn_pairs GROUP BY ALL)""",
    "tiles": """SELECT aoi, sensor, resolution, year, month, count(value) AS n_valid, min(value) AS lowest, max(value) AS highest,
max(row_idx) + 1 AS n_rows, max(col_idx) + 1 AS n_cols FROM cells GROUP BY ALL""",
    "old_monthly": "SELECT aoi, sensor, resolution, year, month, avg(value) AS mean_ndvi, CAST(count(value) AS INT) AS n_valid_px FROM old_cells GROUP BY ALL",
    "month_ends": """SELECT aoi, sensor, resolution, year, month FROM (SELECT aoi, sensor, resolution, CAST(year(m) AS INT) AS year, CAST(month(m) AS INT) AS month
FROM (SELECT aoi, sensor, resolution, unnest(generate_series(make_date(min(year), 1, 1)::TIMESTAMP, make_date(max(year), 12, 1)::TIMESTAMP, INTERVAL 1 MONTH)) AS m
FROM a1 GROUP BY aoi, sensor, resolution))""",
    "latest": """SELECT aoi, sensor, resolution, CAST((n - 1) // 12 AS INT) AS year, CAST(n - ((n - 1) // 12) * 12 AS INT) AS month FROM (
SELECT aoi, sensor, resolution, max(year * 12 + month) AS n FROM months GROUP BY ALL)""",
    "metric_rows": " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, '{m}' AS metric, count(*) AS n_rows, count({m}) AS n_values, CAST(min({m}) AS DOUBLE) AS lowest, CAST(max({m}) AS DOUBLE) AS highest, "
        f"{lo} AS low, {hi} AS high FROM {src}"
        for t, src, ms in (("ndvi_monthly", "a1", ["mean_ndvi", "n_valid_px"]), ("ndvi_monthly_by_class", "a7", ["mean_ndvi", "n_valid_px"]),
                           ("ba_monthly", "a9", ["burned_km2"]), ("ba_daily", "a10", ["burned_km2"]),
                           ("ndvi_anomaly_monthly", "a11", ["mean_ndvi", "anomaly_value"]))
        for m in ms
        for lo, hi in [["NULL" if b is None else repr(b) for b in fixed.VALUE_RANGES[m]]]
    ),
    "snap": """SELECT 'ndvi_monthly' AS table_name, row_key, unnest(['mean_ndvi', 'n_valid_px']) AS metric, unnest([mean_ndvi, CAST(n_valid_px AS DOUBLE)]) AS value FROM (
SELECT concat_ws('|', aoi, sensor, resolution, year, month) AS row_key, mean_ndvi, n_valid_px FROM old_monthly
ORDER BY md5(concat_ws('|', '42', aoi, sensor, resolution, year, month)), row_key LIMIT 5)""",
    "backfill_log": """SELECT aoi, sensor, resolution, year, month, CASE WHEN (year * 12 + month) % 5 <> 0 THEN 'success' ELSE 'error' END AS status FROM a1""",
}

_NAMES = re.compile(r"\b[a-z][a-z0-9_]*\b")


def sql(select: str, doubles: str = "", **local: str) -> str:
    """Full statement for `select` (a CTE name or a SELECT) with `doubles` rounded to six decimals."""
    source = select if not select.lstrip().upper().startswith("SELECT") else f"({select})"
    replaced = ", ".join(f"floor({c} * 1e6 + 0.5) / 1e6 AS {c}" for c in doubles.split())
    final = f"SELECT * {f'REPLACE ({replaced}) ' if replaced else ''}FROM {source}"
    everything = {**CTE, **local}
    order: list[str] = []

    def visit(name: str, trail: tuple[str, ...] = ()) -> None:
        if name in order or name in trail:
            return
        for other in _NAMES.findall(everything[name]):
            if other in everything and other != name:
                visit(other, (*trail, name))
        order.append(name)

    for name in _NAMES.findall(final):
        if name in everything:
            visit(name)
    head = ",\n".join(f"{n} AS {'' if n.endswith('_reach') else 'MATERIALIZED '}({everything[n]})" for n in order)
    return f"WITH RECURSIVE {head}\n{final}" if head else final
