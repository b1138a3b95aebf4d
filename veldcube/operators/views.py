"""Query operators: what a reader of the product tables asks for."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from veldcube.functions import fixed
from veldcube.functions.columns import cell_area_nominal, month_number
from veldcube.functions.session import cut_lineage
from veldcube.operators.monthly import SERIES

MONTH = [*SERIES, "year", "month"]


def _ym(text: str) -> int:
    return int(text[:4]) * 12 + int(text[5:7])


def ym_filter(df: DataFrame, start: str | None = None, end: str | None = None) -> DataFrame:
    """Rows of the inclusive YYYY-MM range; an absent bound is open."""
    n = month_number(F.col("year"), F.col("month"))
    if start:
        df = df.where(n >= _ym(start))
    if end:
        df = df.where(n <= _ym(end))
    return df


def ym_label(year: Column, month: Column) -> Column:
    return F.format_string("%04d-%02d", year, month)


def resolve_resolution(requests: DataFrame) -> DataFrame:
    """Adds `resolved` to (sensor, resolution text, start, end); 'auto', 0 or a non-number means choose."""
    asked = F.col("resolution").try_cast("int")
    auto_word = F.lower("resolution") == "auto"
    auto = auto_word | (F.coalesce(asked, F.lit(0)) == 0)

    def decimal_year(c: str) -> Column:
        return F.substring(c, 1, 4).cast("int") + F.substring(c, 6, 2).cast("int") / F.lit(12.0)

    span = decimal_year("end") - decimal_year("start")
    chosen = (
        F.when(F.col("sensor") == "sentinel2", 100)
        .when(F.col("sensor") == "burned_area", 500)
        .when(F.col("sensor") == "modis", F.when(span.isNull() | (span > 5), 1000).otherwise(250))
        .otherwise(F.when(auto_word, 1000).otherwise(0))
    )
    return requests.withColumn("resolved", F.when(auto, chosen).otherwise(asked))


def timeseries_table(monthly: DataFrame, baselines: DataFrame, start: str | None = None, end: str | None = None) -> DataFrame:
    band = baselines.select(*SERIES, "month", "ts_lower", "ts_upper", "climatology", "hist_std")
    return ym_filter(monthly, start, end).join(band, [*SERIES, "month"], "left").select(
        *MONTH, "mean_ndvi", "n_valid_px", "ts_lower", "ts_upper", "climatology", "hist_std"
    )


def timeseries_enriched(table: DataFrame, trend: DataFrame) -> DataFrame:
    mean, lo, hi = F.col("mean_ndvi"), F.col("ts_lower"), F.col("ts_upper")
    status = (
        F.when(mean.isNull() | lo.isNull() | hi.isNull(), "unknown")
        .when(mean > hi, "above").when(mean < lo, "below").otherwise("normal")
    )
    t = trend.select(
        *SERIES, "trend_direction",
        F.coalesce(F.col("mk_p") < fixed.SIGNIFICANCE, F.lit(False)).alias("trend_significant"),
        F.col("sen_slope").alias("sen_slope_per_year"),
    )
    return table.join(t, SERIES, "left").select(
        *MONTH, "mean_ndvi", (mean - F.col("climatology")).alias("vs_climatology"), status.alias("status"),
        "trend_direction", "trend_significant", "sen_slope_per_year",
    )


def by_landcover(by_class: DataFrame, annual_by_class: DataFrame, year: int | None = None) -> DataFrame:
    history = annual_by_class.select(*SERIES, "year", "land_cover", "annual_mean", "hist_min", "hist_max", "hist_mean_all", "cv")
    rows = by_class if year is None else by_class.where(F.col("year") == year)
    return rows.join(history, [*SERIES, "year", "land_cover"], "left")


def anomaly_view(anomaly: DataFrame, year: int | None = None) -> DataFrame:
    """Months flagged deficit or surplus; a missing anomaly counts as surplus."""
    rows = anomaly if year is None else anomaly.where(F.col("year") == year)
    return rows.withColumn("status", F.when(F.col("anomaly_value") < 0, "deficit").otherwise("surplus"))


def resilience_view(resilience: DataFrame, year: int | None = None) -> DataFrame:
    rows = resilience if year is None else resilience.where(F.col("anomaly_year") == year)
    return rows.orderBy(*SERIES, "anomaly_year", "resilience_rank", "land_cover")


def phenology_view(phenology: DataFrame, land_cover: str) -> DataFrame:
    return phenology.where(F.col("land_cover") == land_cover).orderBy(*SERIES, "year")


def annual_grid(cells: DataFrame, year: int | None = None) -> DataFrame:
    """Mean per cell and year, with the number of months the year has files for."""
    rows = cells if year is None else cells.where(F.col("year") == year)
    months = rows.groupBy(*SERIES, "year").agg(F.count_distinct("month").cast("int").alias("months_available"))
    means = rows.groupBy(*SERIES, "year", "row_idx", "col_idx").agg(F.avg("value").alias("value"))
    return means.join(months, [*SERIES, "year"])


def monthly_grid(cells: DataFrame, year: int, month: int) -> DataFrame:
    return cells.where((F.col("year") == year) & (F.col("month") == month))


def monthly_anomaly_grid(cells: DataFrame, year: int | None = None, month: int | None = None) -> DataFrame:
    """Cell value less the mean of the same calendar month in all strictly earlier years.

    A month without any earlier year gives no rows. The window holds one row per year of a cell.
    """
    rows = cells if month is None else cells.where(F.col("month") == month)
    earlier = Window.partitionBy(*SERIES, "row_idx", "col_idx", "month").orderBy("year").rowsBetween(Window.unboundedPreceding, -1)
    deltas = rows.withColumn("delta", F.col("value") - F.avg("value").over(earlier))
    files = rows.select(*MONTH).distinct()
    w = Window.partitionBy(*SERIES, "month").orderBy("year").rowsBetween(Window.unboundedPreceding, -1)
    meta = files.select(
        *MONTH, F.count("year").over(w).cast("int").alias("n_baseline_years"),
        F.min("year").over(w).alias("baseline_start"), F.max("year").over(w).alias("baseline_end"),
        F.array_join(F.collect_list(F.col("year").cast("string")).over(w), ",").alias("baseline_years"),
    ).where("n_baseline_years > 0")
    if year is not None:
        deltas, meta = deltas.where(F.col("year") == year), meta.where(F.col("year") == year)
    return deltas.drop("value").join(meta, MONTH)


def compact_grid(cells: DataFrame, grid: DataFrame, value: str = "value") -> DataFrame:
    """One record per month and grid row, rows without a cell included: its latitude, the longitudes of the
    columns, the values by column (4 decimals, NULL where missing) and the row's valid count. A record
    holds one grid row, so a large area never has to fit one task."""
    key = [*MONTH, "row_idx"]
    # Stored, since its months make the spine that it is joined to.
    seen = cut_lineage(cells.groupBy(*key).agg(
        F.map_from_entries(F.collect_list(F.struct("col_idx", F.bround(value, 4)))).alias("m"),
        F.count(value).cast("int").alias("n_valid"),
    ))
    months = seen.select(*MONTH).distinct()
    spine = months.join(grid, ["aoi", "resolution"]).withColumn("row_idx", F.explode(F.sequence(F.lit(0), F.col("n_rows") - 1)))
    placed = spine.join(seen, key, "left").withColumn("m", F.coalesce("m", F.expr("map_from_arrays(array(), array())").cast("map<int,double>")))
    return placed.select(
        *key, F.bround(F.col("north") + (F.col("row_idx") + 0.5) * F.col("dy"), 6).alias("lat"),
        F.expr("transform(sequence(0, n_cols - 1), j -> try_element_at(m, j))").alias("values"),
        F.expr("transform(sequence(0, n_cols - 1), j -> bround(west + (j + 0.5D) * dx, 6))").alias("lons"),
        F.coalesce("n_valid", F.lit(0)).alias("n_pixels"),
    )


def ba_summary(ba: DataFrame, start: str | None = None, end: str | None = None) -> DataFrame:
    """Monthly burned area against its baseline; without an upper bound a month is normal."""
    return ym_filter(ba, start, end).withColumn("vs_baseline", F.col("burned_km2") - F.col("ba_mean")).withColumn(
        "status", F.when(F.col("burned_km2") > F.col("ba_upper_ci"), "above_normal").otherwise("normal")
    )


def ba_daily_view(daily: DataFrame, year: int) -> DataFrame:
    return daily.where(F.col("year") == year).orderBy("aoi", "date")


def ba_monthly_grid(burns: DataFrame) -> DataFrame:
    """Burn date per cell with the burned cells and nominal km2 of its month."""
    totals = burns.groupBy(*MONTH).agg(F.sum(F.when(F.col("burn_date") > 0, 1).otherwise(0)).alias("burned_pixels"))
    totals = totals.withColumn("burned_km2", F.col("burned_pixels") * cell_area_nominal(F.col("resolution")))
    return burns.select(*MONTH, "row_idx", "col_idx", "burn_date").join(totals, MONTH)


def ba_annual_grid(burns: DataFrame) -> DataFrame:
    """Months burned per cell and year; NULL where the cell was never valid."""
    burned = F.when(F.col("burn_date") > 0, 1).when(F.col("burn_date").isNotNull(), 0)
    return burns.groupBy(*SERIES, "year", "row_idx", "col_idx").agg(F.sum(burned).cast("int").alias("burn_count"))


def ba_annual_totals(burns: DataFrame) -> DataFrame:
    months = burns.groupBy(*SERIES, "year").agg(F.count_distinct("month").cast("int").alias("months_available"))
    n = F.col("burn_count")
    totals = ba_annual_grid(burns).groupBy(*SERIES, "year").agg(
        F.sum((n > 0).cast("int")).alias("burned_pixels"), F.sum((n > 1).cast("int")).alias("multi_burn_pixels")
    )
    return totals.join(months, [*SERIES, "year"]).withColumn(
        "total_burned_km2", F.col("burned_pixels") * cell_area_nominal(F.col("resolution"))
    )


def ba_year_range(ba: DataFrame) -> DataFrame:
    return ba.groupBy("aoi").agg(F.min("year").alias("year_start"), F.max("year").alias("year_end")).withColumn(
        "n_years", F.col("year_end") - F.col("year_start") + 1
    )


def frp_patches_view(patches: DataFrame, years: DataFrame) -> DataFrame:
    """Patches with the year range of the burned-area record (last year less first year plus one)."""
    return patches.drop("n_years").join(years, "aoi")


def landcover_area(features: DataFrame, study_area: DataFrame) -> DataFrame:
    """Hectares of each land-cover feature and its share of the study area (aoi, aoi_km2)."""
    share = F.col("area_km2") / F.nullif(F.col("aoi_km2"), F.lit(0.0)) * 100
    return features.join(study_area, "aoi").select(
        "aoi", "component_id", "land_cover", (F.col("area_km2") * 100).alias("area_ha"), share.alias("pct_of_study_area")
    )


def frp_feature_summary(patches: DataFrame) -> DataFrame:
    """Count, extremes and unweighted mean of the fire return period over patches."""
    return patches.groupBy("aoi").agg(
        F.count(F.lit(1)).alias("n_features"),
        F.max("n_years").alias("n_years_in_dataset"),
        F.min("frp_years").alias("frp_years_min"),
        F.max("frp_years").alias("frp_years_max"),
        F.avg("frp_years").alias("frp_years_mean"),
    )


def frp_area_summary(areas: DataFrame) -> DataFrame:
    """Area-weighted mean and median of (aoi, frp_years, area) and the area share of each band.

    Areas are summed per distinct return period first (at most one per possible burn count), so the
    running total runs over a handful of rows.
    """
    by_value = areas.where("frp_years IS NOT NULL").groupBy("aoi", "frp_years").agg(F.sum("area").alias("area"))
    upto = Window.partitionBy("aoi").orderBy("frp_years")
    whole = Window.partitionBy("aoi")
    marked = by_value.withColumn("upto", F.sum("area").over(upto)).withColumn("total", F.sum("area").over(whole))
    frp, area = F.col("frp_years"), F.col("area")
    lows = [None, *[limit for _, limit in fixed.FRP_BUCKETS]]
    bands = []
    for (name, high), low in zip(fixed.FRP_BUCKETS, lows):
        inside = frp < high if low is None else (frp >= low) & (frp < high)
        bands.append((F.lit(100.0) * F.sum(F.when(inside, area).otherwise(0.0)) / F.first("total")).alias(f"pct_{name}"))
    bands.append((F.lit(100.0) * F.sum(F.when(frp >= lows[-1], area).otherwise(0.0)) / F.first("total")).alias("pct_rest"))
    return marked.groupBy("aoi").agg(
        (F.sum(frp * area) / F.first("total")).alias("mean_frp_years"),
        F.min(F.when(F.col("upto") >= F.col("total") / 2, frp)).alias("median_frp_years"),
        *bands,
    )


def spatial_change(cells: DataFrame, year_a: int, year_b: int, month: int | None = None) -> DataFrame:
    """Change between two years per area, from grid values at four decimals, with a dead band of 0.02.

    Both years come from one pass: a cell's two values meet in one aggregate, not in a join.
    """
    rows = cells.where(F.col("year").isin(year_a, year_b))
    if month is not None:
        rows = rows.where(F.col("month") == month)
    def mean_of(year: int) -> Column:
        return F.bround(F.avg(F.when(F.col("year") == year, F.col("value"))), 4)

    both = rows.groupBy(*SERIES, "row_idx", "col_idx").agg(mean_of(year_a).alias("a"), mean_of(year_b).alias("b"))
    d = F.col("d")
    n = F.count(F.lit(1))
    gain, loss = F.sum((d > fixed.SPATIAL_CHANGE).cast("int")), F.sum((d < -fixed.SPATIAL_CHANGE).cast("int"))
    px = cell_area_nominal(F.col("resolution"))
    stats = both.where("a IS NOT NULL AND b IS NOT NULL").withColumn("d", F.col("b") - F.col("a")).groupBy(*SERIES).agg(
        gain.alias("gain"), loss.alias("loss"), n.alias("n"),
        F.avg("d").alias("mean_ndvi_change"), F.max("d").alias("max_gain"), F.min("d").alias("max_loss"),
    )
    return stats.select(
        *SERIES, (F.col("gain") * px).alias("gain_km2"), (F.col("loss") * px).alias("loss_km2"),
        (F.col("n") * px).alias("total_area_km2"), (F.lit(100.0) * F.col("gain") / F.col("n")).alias("pct_gaining"),
        (F.lit(100.0) * F.col("loss") / F.col("n")).alias("pct_losing"), "mean_ndvi_change", "max_gain", "max_loss",
    )


def available_sensors(months: DataFrame) -> DataFrame:
    """First and last month of each sensor over all areas, from its first resolution."""
    first = months.groupBy("sensor").agg(F.min("resolution").alias("resolution"))
    n = month_number(F.col("year"), F.col("month"))
    ends = months.join(first, ["sensor", "resolution"]).groupBy("sensor").agg(
        F.min_by(ym_label(F.col("year"), F.col("month")), n).alias("start"),
        F.max_by(ym_label(F.col("year"), F.col("month")), n).alias("end"),
    )
    return ends


def available_classes(by_class: DataFrame) -> DataFrame:
    return by_class.groupBy("aoi").agg(F.array_join(F.array_sort(F.collect_set("land_cover")), ",").alias("classes"))


def data_through(months: DataFrame, priority: list[tuple[str, int]]) -> DataFrame:
    """Latest month per area of the first source in `priority` that has any."""
    order = F.lit(None).cast("int")
    for i, (sensor, resolution) in reversed(list(enumerate(priority))):
        order = F.when((F.col("sensor") == sensor) & (F.col("resolution") == resolution), i).otherwise(order)
    n = month_number(F.col("year"), F.col("month"))
    ranked = months.withColumn("source", order).where("source IS NOT NULL")
    best = ranked.groupBy("aoi").agg(F.min(F.struct("source", (-n).alias("n"))).alias("b"))
    last = -F.col("b.n")
    year = F.floor((last - 1) / 12).cast("int")
    return best.select("aoi", ym_label(year, (last - year * 12).cast("int")).alias("data_through"))


def rank_years(ba: DataFrame, month: int | None = None, descending: bool = True) -> DataFrame:
    """Years of each area by total burned area; one row per year."""
    rows = ba if month is None else ba.where(F.col("month") == month)
    totals = rows.groupBy("aoi", "year").agg(F.sum("burned_km2").alias("total_km2"))
    order = F.desc("total_km2") if descending else F.asc("total_km2")
    return totals.withColumn("year_rank", F.row_number().over(Window.partitionBy("aoi").orderBy(order, "year")))


def top_years(ba: DataFrame, k: int, month: int | None = None) -> DataFrame:
    return rank_years(ba, month).where(F.col("year_rank") <= k)


def last_run(log: DataFrame) -> DataFrame:
    """Latest non-empty run timestamp of the append-only log."""
    return log.where("run_timestamp IS NOT NULL").agg(F.max("run_timestamp").alias("last_run"))
