"""Monthly tables reduced from cells. All series are keyed by (aoi, sensor, resolution)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veldcube.functions import fixed
from veldcube.functions.columns import cell_area_nominal, row_area

SERIES = ["aoi", "sensor", "resolution"]


def ndvi_monthly(cells: DataFrame) -> DataFrame:
    """Mean and number of valid cells; a month with no valid cell keeps its row (NULL, 0)."""
    return cells.groupBy(*SERIES, "year", "month").agg(
        F.avg("value").alias("mean_ndvi"), F.count("value").cast("int").alias("n_valid_px")
    )


def ndvi_monthly_baselines(monthly: DataFrame) -> DataFrame:
    return monthly.groupBy(*SERIES, "month").agg(
        F.min("mean_ndvi").alias("ts_lower"),
        F.max("mean_ndvi").alias("ts_upper"),
        F.avg("mean_ndvi").alias("climatology"),
        F.stddev_samp("mean_ndvi").alias("hist_std"),
        F.count("mean_ndvi").cast("int").alias("n_years"),
    )


def ndvi_annual(monthly: DataFrame) -> DataFrame:
    """n_months counts rows, also those whose mean is NULL."""
    return monthly.groupBy(*SERIES, "year").agg(
        F.avg("mean_ndvi").alias("mean_ndvi"), F.count(F.lit(1)).cast("int").alias("n_months")
    ).withColumn("is_complete", F.col("n_months") == fixed.MONTHS_PER_YEAR)


def ndvi_monthly_by_class(cells: DataFrame, class_cells: DataFrame, classes: DataFrame,
                          on: list[str] | None = None) -> DataFrame:
    """ndvi_monthly per land-cover class. A cell may feed several classes; every class of the area
    has a row in every month, with (NULL, 0) where no cell was valid.

    `class_cells` maps cells to classes (columns `on` + land_cover), `classes` lists (aoi, land_cover).
    """
    on = on or ["row_idx", "col_idx"]
    # Cells of no class stay in, so that a month with only such cells is not lost.
    means = cells.join(class_cells, on, "left").groupBy(*SERIES, "year", "month", "land_cover").agg(
        F.avg("value").alias("mean"), F.count("value").cast("int").alias("n")
    )
    # One entry per class and month: the spine needs no second pass over the cells.
    entry = F.when(F.col("land_cover").isNotNull(), F.struct("land_cover", F.struct("mean", "n").alias("v")))
    months = means.groupBy(*SERIES, "year", "month").agg(F.map_from_entries(F.collect_list(entry)).alias("by_class"))
    found = F.try_element_at("by_class", F.col("land_cover"))
    return months.join(classes, "aoi").select(
        *SERIES, "year", "month", "land_cover", found["mean"].alias("mean_ndvi"),
        F.coalesce(found["n"], F.lit(0)).alias("n_valid_px"),
    )


def _half_width(sd: Column, n: Column) -> Column:
    """1.96 standard errors; sd is NULL for a single value, so the interval is too."""
    return F.lit(fixed.Z_95) * (sd / F.sqrt(n))


def class_baselines(by_class: DataFrame) -> DataFrame:
    key = [*SERIES, "land_cover", "month"]
    yearly = by_class.groupBy(*key, "year").agg(F.avg("mean_ndvi").alias("yr_mean"))
    stats = yearly.groupBy(*key).agg(
        F.avg("yr_mean").alias("hist_mean"),
        F.stddev_samp("yr_mean").alias("hist_sd"),
        F.count("yr_mean").cast("int").alias("n_years"),
    )
    half = _half_width(F.col("hist_sd"), F.col("n_years"))
    return stats.select(
        *key,
        F.col("hist_mean").alias("lc_mean"),
        (F.col("hist_mean") - half).alias("lc_lower_ci"),
        (F.col("hist_mean") + half).alias("lc_upper_ci"),
        "hist_mean", "hist_sd", "n_years",
    )


def ndvi_anomaly_monthly(by_class: DataFrame, baselines: DataFrame) -> DataFrame:
    key = [*SERIES, "land_cover", "month"]
    return by_class.join(baselines.select(*key, "hist_mean"), key).select(
        *SERIES, "year", "month", "land_cover",
        (F.col("mean_ndvi") - F.col("hist_mean")).alias("anomaly_value"), "mean_ndvi", "hist_mean",
    )


def ba_monthly(burns: DataFrame, grid: DataFrame) -> DataFrame:
    """Burned km2 per month with ellipsoidal cell areas, and the band of its calendar month."""
    area = row_area(F.col("row_idx"), F.col("north"), F.col("dx"), F.col("dy"))
    placed = burns.join(grid.select("aoi", "resolution", "north", "dx", "dy"), ["aoi", "resolution"])
    months = placed.groupBy("aoi", "resolution", "year", "month").agg(
        F.coalesce(F.sum(F.when(F.col("burn_date") > 0, area)), F.lit(0.0)).alias("burned_km2")
    )
    return ba_bands(months)


def ba_bands(months: DataFrame) -> DataFrame:
    """Months (aoi, resolution, year, month, burned_km2) with the band of their calendar month.

    The lower bound is cut at zero but stays NULL for a single year.
    """
    key = ["aoi", "resolution", "month"]
    stats = months.groupBy(*key).agg(
        F.avg("burned_km2").alias("ba_mean"),
        F.stddev_samp("burned_km2").alias("sd"),
        F.count("burned_km2").cast("int").alias("n_years"),
    )
    half = _half_width(F.col("sd"), F.col("n_years"))
    low = F.col("ba_mean") - half
    band = stats.select(
        *key, "ba_mean", F.when(low < 0, F.lit(0.0)).otherwise(low).alias("ba_lower_ci"),
        (F.col("ba_mean") + half).alias("ba_upper_ci"), "n_years",
    )
    return months.join(band, key).select(
        "aoi", "resolution", "year", "month", "burned_km2", "ba_mean", "ba_lower_ci", "ba_upper_ci", "n_years"
    )


def ba_daily(burns: DataFrame) -> DataFrame:
    """Nominal burned area per burn date and source month; day 366 of a short year rolls over."""
    counts = burns.where("burn_date > 0").groupBy("aoi", "resolution", "year", "month", "burn_date").agg(
        F.count(F.lit(1)).alias("n")
    )
    first = F.make_date("year", F.lit(1), F.lit(1))
    return counts.select(
        "aoi", "resolution", "year", F.date_add(first, F.col("burn_date") - 1).alias("date"),
        (F.col("n") * cell_area_nominal(F.col("resolution"))).alias("burned_km2"),
    )
