"""Hand-made fixtures for the semantics that are easy to get wrong."""

import datetime
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from veldcube.operators import annual, documented, monthly, trend, views
from veldcube.sources import dims

SER = ("AFRICA", "s2", 500)
SERIES = "aoi string, sensor string, resolution int"


def series(spark, rows, columns):
    return spark.createDataFrame([(*SER, *r) for r in rows], f"{SERIES}, {columns}")


def test_month_without_valid_cell_keeps_its_row(spark):
    cells = series(spark, [(2000, 1, 0, 0, None), (2000, 1, 0, 1, None), (2000, 2, 0, 0, 0.4)], "year int, month int, row_idx int, col_idx int, value double")
    got = {r.month: (r.mean_ndvi, r.n_valid_px) for r in monthly.ndvi_monthly(cells).collect()}
    assert got == {1: (None, 0), 2: (0.4, 1)}


def test_counts_differ_between_annual_and_baseline(spark):
    m = series(spark, [(2000, k, None if k == 5 else 0.1 * k, 1) for k in range(1, 13)], "year int, month int, mean_ndvi double, n_valid_px int")
    year = monthly.ndvi_annual(m).first()
    assert year.n_months == 12 and year.is_complete
    band = {r.month: r for r in monthly.ndvi_monthly_baselines(m).collect()}
    assert band[5].n_years == 0 and band[4].n_years == 1 and band[4].hist_std is None


def brute_mk(x):
    n = len(x)
    s = sum(np.sign(x[j] - x[i]) for i in range(n) for j in range(i + 1, n))
    ties = [x.count(v) for v in set(x)]
    var = (n * (n - 1) * (2 * n + 5) - sum(t * (t - 1) * (2 * t + 5) for t in ties)) / 18
    z = 0 if s == 0 else (s - np.sign(s)) / math.sqrt(var)
    slope = np.median([(x[j] - x[i]) / (j - i) for i in range(n) for j in range(i + 1, n)])
    return s, var, math.erfc(abs(z) / math.sqrt(2)), slope


@pytest.mark.parametrize("x", [[0.1, 0.2, 0.2, 0.5, 0.4, 0.6], [0.5, 0.4, 0.3, 0.2, 0.1], [0.3] * 4 + [0.2], [0.1, 0.3, 0.2, 0.5, 0.4, 0.45, 0.45]])
def test_mann_kendall(spark, x):
    df = series(spark, [(2000 + 2 * i, v) for i, v in enumerate(x)], "year int, mean_ndvi double")
    r = trend.mann_kendall(df, ["aoi", "sensor", "resolution"], "year", "mean_ndvi").first()
    s, var, p, slope = brute_mk(x)
    assert (r.mk_s, r.mk_var) == (s, pytest.approx(var))
    assert r.mk_p == pytest.approx(p, rel=1e-6) and r.sen_slope == pytest.approx(slope)


def test_constant_series_does_not_divide_by_zero(spark):
    df = series(spark, [(2000 + i, 0.3) for i in range(6)], "year int, mean_ndvi double")
    r = trend.mann_kendall(df, ["aoi", "sensor", "resolution"], "year", "mean_ndvi").first()
    assert (r.mk_s, r.mk_var, r.sen_slope) == (0.0, 0.0, 0.0) and r.mk_p == pytest.approx(1.0, abs=1e-6)


@pytest.mark.parametrize("years,direction", [(4, "insufficient_data"), (5, "decreasing")])
def test_trend_needs_five_complete_years(spark, years, direction):
    m = series(spark, [(2000 + y, k, 0.8 - 0.1 * y, 9) for y in range(years) for k in range(1, 13)], "year int, month int, mean_ndvi double, n_valid_px int")
    r = trend.ndvi_trend_stats(m, monthly.ndvi_annual(m)).first()
    assert r.trend_direction == direction
    assert (r.q1_ndvi is None) == (years == 4) and (r.mk_p is None) == (years == 4)
    if years == 5:
        assert r.q1_ndvi == pytest.approx(np.percentile([0.8, 0.7, 0.6, 0.5, 0.4], 25)) and r.smk_p is not None


@pytest.mark.parametrize("n,some", [(59, 0), (60, 1)])
def test_seasonal_needs_sixty_points_and_gaps_shift_seasons(spark, n, some):
    # The NULL month is dropped, so every later value moves one season back.
    values = [math.sin(i / 12 * 2 * math.pi) + 0.01 * i for i in range(n + 1)]
    rows = [(2000 + i // 12, i % 12 + 1, None if i == 7 else v) for i, v in enumerate(values)]
    got = trend.seasonal_mann_kendall(series(spark, rows, "year int, month int, mean_ndvi double")).collect()
    assert len(got) == some
    if some:
        kept = [v for i, v in enumerate(values) if i != 7]
        parts = [brute_mk(kept[k::12]) for k in range(12)]
        assert got[0].smk_s == sum(p[0] for p in parts)
        assert got[0].smk_var == pytest.approx(sum(p[1] for p in parts))
        slopes = [(x[j] - x[i]) / (j - i) for x in (kept[k::12] for k in range(12)) for i in range(len(x)) for j in range(i + 1, len(x))]
        assert got[0].smk_sen_slope == pytest.approx(np.median(slopes))


def test_class_without_valid_cell_still_has_a_row(spark):
    cells = series(spark, [(2000, 1, 0, 0, 0.4), (2000, 1, 0, 1, 0.6)], "year int, month int, row_idx int, col_idx int, value double")
    cover = spark.createDataFrame([(0, 0, "Crops"), (0, 1, "Crops"), (0, 1, "Trees")], "row_idx int, col_idx int, land_cover string")
    classes = spark.createDataFrame([("AFRICA", c) for c in ("Crops", "Trees", "Water")], "aoi string, land_cover string")
    got = {r.land_cover: (r.mean_ndvi, r.n_valid_px) for r in monthly.ndvi_monthly_by_class(cells, cover, classes).collect()}
    assert got == {"Crops": (0.5, 2), "Trees": (0.6, 1), "Water": (None, 0)}


def test_burned_area_band_is_cut_at_zero_but_not_for_one_year(spark):
    burns = spark.createDataFrame(
        [("AFRICA", "ba", 500, y, 8, 0, c, d) for y, c, d in ((2000, 0, 220), (2001, 0, 0), (2002, 0, 0))]
        + [("AFRICA", "ba", 500, 2000, 9, 0, 0, 250)], f"{SERIES}, year int, month int, row_idx int, col_idx int, burn_date int")
    got = {(r.year, r.month): r for r in monthly.ba_monthly(burns, dims.grid_dim(spark, dims.BLOCK_GRID)).collect()}
    assert got[(2000, 8)].ba_lower_ci == 0.0 and got[(2001, 8)].burned_km2 == 0.0
    assert got[(2000, 9)].ba_lower_ci is None and got[(2000, 9)].ba_upper_ci is None and got[(2000, 9)].n_years == 1


def test_daily_dates_and_roll_over(spark):
    burns = spark.createDataFrame(
        [("AFRICA", 500, 2000, 12, 366), ("AFRICA", 500, 2001, 12, 366), ("AFRICA", 500, 2001, 11, 366), ("AFRICA", 500, 2001, 1, 1), ("AFRICA", 500, 2001, 1, -1)],
        "aoi string, resolution int, year int, month int, burn_date int")
    got = sorted((r.year, r.date, r.burned_km2) for r in monthly.ba_daily(burns).collect())
    # Two source months with the same day stay apart.
    assert got == [(2000, datetime.date(2000, 12, 31), 0.25), (2001, datetime.date(2001, 1, 1), 0.25),
                   (2001, datetime.date(2002, 1, 1), 0.25), (2001, datetime.date(2002, 1, 1), 0.25)]


def anomaly_frame(spark, years):
    """One class; anomalies by month, with mean = anomaly and hist_mean = 0."""
    rows = [(y, m, "Crops", v, v, 0.0) for y, vs in years.items() for m, v in enumerate(vs, start=1)]
    a = series(spark, rows, "year int, month int, land_cover string, anomaly_value double, mean_ndvi double, hist_mean double")
    b = series(spark, [("Crops", m, 0.05) for m in range(1, 13)], "land_cover string, month int, hist_sd double")
    return a, b


def test_resilience_ties_recovery_and_penalty(spark):
    flat = [0.1] * 12
    tie = flat[:]; tie[2] = tie[6] = -0.2; tie[4] = 0.01      # equal minima: the earlier month counts
    none = flat[:]; none[10] = -0.12                            # December is too far off: never recovers
    december = flat[:]; december[9] = -0.3; december[11] = 0.05  # recovers in December, exactly on the limit
    short = flat[:11]                                            # eleven months: not a complete year
    a, b = anomaly_frame(spark, {2000: tie, 2001: none, 2002: december, 2003: short})
    got = {r.anomaly_year: r for r in annual.anomaly_resilience(a, b).collect()}
    assert set(got) == {2000, 2001, 2002}
    assert (got[2000].deficit_month, got[2000].recovery_months, got[2000].severity) == (3, 2, "Severe")
    assert got[2001].recovery_months is None and got[2001].resilience_score == pytest.approx(0.12 * 12)
    assert (got[2002].recovery_months, got[2002].severity) == (2, "Severe")


def test_unrecovered_class_pays_twice_the_longest_recovery(spark):
    rows = []
    for m in range(1, 13):
        rows.append((2000, m, "Crops", -0.2 if m == 2 else (0.0 if m == 6 else 0.1), -0.2 if m == 2 else (0.0 if m == 6 else 0.1), 0.0))
        v = -0.11 if m == 12 else 0.2
        rows.append((2000, m, "Trees", v, v, 0.0))
    a = series(spark, rows, "year int, month int, land_cover string, anomaly_value double, mean_ndvi double, hist_mean double")
    b = series(spark, [(c, m, 0.05) for c in ("Crops", "Trees") for m in range(1, 13)], "land_cover string, month int, hist_sd double")
    got = {r.land_cover: r for r in annual.anomaly_resilience(a, b).collect()}
    assert got["Crops"].recovery_months == 4 and got["Crops"].resilience_score == pytest.approx(0.8)
    assert got["Trees"].resilience_score == pytest.approx(0.11 * 8)
    assert (got["Crops"].resilience_rank, got["Trees"].resilience_rank) == (1, 2)


def test_null_anomaly_rows_count_for_completeness(spark):
    values = [0.1] * 12
    values[3] = None
    a, b = anomaly_frame(spark, {2000: values})
    assert annual.anomaly_resilience(a, b).count() == 1
    a, b = anomaly_frame(spark, {2000: [None] * 12})
    assert annual.anomaly_resilience(a, b).count() == 0


def phenology(spark, by_month, lc="Crops"):
    rows = [(2000, m, lc, v, 3) for m, v in by_month.items()]
    df = series(spark, rows, "year int, month int, land_cover string, mean_ndvi double, n_valid_px int")
    return annual.ndvi_phenology(df, dims.phenology_profiles(spark)).first()


def test_phenology_boundaries(spark):
    base = {m: 0.4 for m in range(1, 13)}
    # The rise equals the lowest rise that counts: detected, Low, month of the highest value.
    r = phenology(spark, {**base, 10: 0.25, 11: 0.27, 12: 0.28, 5: 0.29})
    assert (r.green_up_month, r.green_up_conf) == (12, "Low")
    assert r.senescence_month == 5 and r.season_length == 5
    # Crossing wins over the highest month; more than twice the threshold is High.
    r = phenology(spark, {**base, 10: 0.2, 11: 0.35, 12: 0.5})
    assert (r.green_up_month, r.green_up_conf, r.senescence_month, r.season_length) == (11, "High", None, None)
    # Equal peaks: the earlier month. No baseline: not detected.
    r = phenology(spark, {**base, 1: 0.6, 2: 0.7, 3: 0.7, 10: None})
    assert (r.peak_month, r.peak_conf, r.green_up_month, r.green_up_conf) == (2, "Medium", None, "Not detected")
    r = phenology(spark, {m: 0.4 for m in range(5, 13)})
    assert (r.peak_month, r.peak_ndvi, r.peak_conf) == (None, None, "Medium")


def test_first_matching_profile_prefix_wins(spark):
    df = spark.createDataFrame([("ASIA", "Crops"), ("AMERICA", "Crops"), ("EUROPE", "Crops"), ("ASIA", "Trees")], "aoi string, land_cover string")
    got = {(r.aoi, r.land_cover): r.profile_key for r in annual.with_profile(df, dims.phenology_profiles(spark)).collect()}
    assert got == {("ASIA", "Crops"): "AS", ("AMERICA", "Crops"): "A"}


def test_delta_is_antisymmetric_and_skips_one_sided_cells(spark):
    means = series(spark, [(0, 0, 2000, 0.1), (0, 0, 2001, 0.3), (0, 1, 2000, 0.5), (0, 1, 2001, 0.2), (0, 2, 2000, 0.4), (0, 2, 2001, None), (0, 3, 2002, 0.4)],
                   "row_idx int, col_idx int, year int, annual_mean double")
    years = series(spark, [(y, 0.1, 12, True) for y in (2000, 2001, 2002)], "year int, mean_ndvi double, n_months int, is_complete boolean")
    got = {(r.year_a, r.year_b): r for r in annual.ndvi_annual_delta(means, years, dims.grid_dim(spark, dims.BLOCK_GRID)).collect()}
    assert len(got) == 6
    a, b = got[(2000, 2001)], got[(2001, 2000)]
    assert a.gain_km2 == b.loss_km2 and a.loss_km2 == b.gain_km2 and a.total_km2 == b.total_km2
    assert a.total_km2 == pytest.approx(2 * a.gain_km2)
    assert got[(2000, 2002)].total_km2 == 0.0


def test_fire_return_rounds_half_to_even(spark):
    df = spark.createDataFrame([(4, 9), (2, 0), (8, 13)], "burn_count int, n_years int").withColumn("n_years", F.greatest("n_years", F.lit(1)))
    got = [r.frp_years for r in annual.fire_return_period(df).collect()]
    assert got == [2.2, 0.5, 1.6]
    none = spark.createDataFrame([(0, 5)], "burn_count int, n_years int")
    assert annual.fire_return_period(none).first().frp_years is None


def test_status_above_and_below_need_an_independent_band(spark):
    m = series(spark, [(2000, 1, 0.9, 5), (2000, 2, 0.1, 5), (2000, 3, 0.5, 5), (2000, 4, None, 0), (2000, 5, 0.5, 5)], "year int, month int, mean_ndvi double, n_valid_px int")
    b = series(spark, [(k, 0.4, 0.6, 0.5, 0.05) for k in range(1, 5)], "month int, ts_lower double, ts_upper double, climatology double, hist_std double")
    t = series(spark, [("no_trend", None, 0.01)], "trend_direction string, mk_p double, sen_slope double")
    got = {r.month: r for r in views.timeseries_enriched(views.timeseries_table(m, b), t).collect()}
    assert {k: r.status for k, r in got.items()} == {1: "above", 2: "below", 3: "normal", 4: "unknown", 5: "unknown"}
    assert got[1].trend_significant is False


def test_weighted_median_and_shares(spark):
    df = spark.createDataFrame([("A", 1.0, 2.0), ("A", 5.0, 1.0), ("A", 20.0, 3.0), ("A", None, 9.0)], "aoi string, frp_years double, area double")
    r = views.frp_area_summary(df).first()
    assert r.median_frp_years == 5.0 and r.mean_frp_years == pytest.approx((2 + 5 + 60) / 6)
    assert r.pct_lt_3 + r.pct_lt_7 + r.pct_lt_15 + r.pct_rest == pytest.approx(100)


def test_signed_rank_tails_are_the_known_ones():
    tails = documented.signed_rank_tails()
    assert tails[5][0] == 1 / 32 and tails[5][-1] == 1.0
    assert tails[12][13] == pytest.approx(0.0212, abs=5e-5)


def test_resolution_choice(spark):
    rows = [("sentinel2", "auto", None, None, 100), ("modis", "auto", "2000-01", "2005-01", 250), ("modis", "auto", "2000-01", "2005-02", 1000),
            ("modis", "AUTO", None, "2005-02", 1000), ("modis", "500", None, None, 500), ("burned_area", "0", None, None, 500),
            ("modis", "junk", None, None, 1000), ("other", "auto", None, None, 1000), ("other", "junk", None, None, 0)]
    df = spark.createDataFrame([r[:4] for r in rows], "sensor string, resolution string, start string, end string")
    assert [r.resolved for r in views.resolve_resolution(df).collect()] == [r[4] for r in rows]
