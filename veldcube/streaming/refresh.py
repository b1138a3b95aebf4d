"""Incremental refresh: cells of new or replaced months arrive as files, only what they touch is recomputed."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veldcube.functions.session import broadcast_if_small, cut_lineage
from veldcube.operators import annual as annual_ops
from veldcube.operators import incremental, monthly, quality, trend
from veldcube.sources import products
from veldcube.streaming import state

CELLS = "row_idx int, col_idx int, value double, aoi string, sensor string, resolution int, year int, month int"
BURNS = "row_idx int, col_idx int, burn_date int, aoi string, sensor string, resolution int, year int, month int"
SERIES_KEY = "aoi string, sensor string, resolution int"
MONTHLY = f"year int, month int, mean_ndvi double, n_valid_px int, {SERIES_KEY}"
BY_CLASS = f"year int, month int, land_cover string, mean_ndvi double, n_valid_px int, {SERIES_KEY}"
CLASS_BASELINES = (
    "land_cover string, month int, lc_mean double, lc_lower_ci double, lc_upper_ci double, hist_mean double, hist_sd double, "
    f"n_years int, {SERIES_KEY}"
)
ANOMALY = f"year int, month int, land_cover string, anomaly_value double, mean_ndvi double, hist_mean double, {SERIES_KEY}"
RESILIENCE = (
    "anomaly_year int, land_cover string, max_deficit double, deficit_month int, recovery_months int, resilience_score double, "
    f"resilience_rank int, severity string, {SERIES_KEY}"
)
PHENOLOGY = (
    "year int, land_cover string, green_up_month int, green_up_conf string, peak_month int, peak_ndvi double, peak_conf string, "
    f"senescence_month int, season_length int, {SERIES_KEY}"
)
DELTA = f"year_a int, year_b int, gain_km2 double, loss_km2 double, total_km2 double, {SERIES_KEY}"
BA_MONTH = f"year int, month int, burned_km2 double, {SERIES_KEY}"
BA_MONTHLY = (
    "year int, month int, burned_km2 double, ba_mean double, ba_lower_ci double, ba_upper_ci double, n_years int, "
    "aoi string, resolution int"
)
FRP = "row_idx int, col_idx int, burn_count int, n_years int, frp_years double, aoi string, resolution int"
STATS = (
    "year int, month int, n_valid long, lowest double, highest double, n_rows int, n_cols int, n_total int, "
    "aoi string, sensor string, resolution int"
)
MONTH = [*monthly.SERIES, "year", "month"]
CELL_MONTH = [*MONTH, "row_idx", "col_idx"]


@dataclass
class Layers:
    """What the by-class products need: class of each cell (row_idx, col_idx, land_cover, perhaps aoi), classes of
    each area (aoi, land_cover) and the phenology profiles."""

    class_cells: DataFrame
    classes: DataFrame
    profiles: DataFrame


@dataclass
class Load:
    """A load of cells after its checks: months that it touches, whole; what the load changes in them; tile statistics."""

    months: DataFrame
    kept: DataFrame
    changes: DataFrame
    stats: DataFrame

    def series(self) -> DataFrame:
        return self.months.select(*monthly.SERIES).distinct()

    def years(self, table: state.Table, spark: SparkSession, root: str) -> DataFrame:
        """The years of a state table that the load touches."""
        return table.scan(spark, root).join(broadcast_if_small(self.months.select(*state.YEAR).distinct()), state.YEAR, "left_semi")


def of_series(spark: SparkSession, root: str, table: str, schema: str, series: DataFrame) -> DataFrame:
    """The partitions of a stored table that belong to `series`."""
    return products.scan_product(spark, root, table, schema).join(broadcast_if_small(series), monthly.SERIES, "left_semi")


def checked_load(spark: SparkSession, root: str, table: str, schema: str, value: str, batch: DataFrame, grid: DataFrame, burned: bool = False) -> Load:
    """Merge a batch with the stored months that it touches and leave out tiles that fail their checks.

    A month may arrive in parts: cells that the batch has replace the stored ones, all others stay. Of a
    cell that a batch has twice the later file counts. Tiles are checked as they would be stored, against the
    stored tiles of their series.
    """
    arrived = F.struct("arrived", value) if "arrived" in batch.columns else F.struct(value)
    fresh = cut_lineage(batch.groupBy(*CELL_MONTH).agg(F.max_by(F.struct(value), arrived).alias("v")).select("row_idx", "col_idx", f"v.{value}", *MONTH))
    months = cut_lineage(fresh.select(*MONTH).distinct())
    stored = products.scan_product(spark, root, table, schema).join(broadcast_if_small(months), MONTH, "left_semi")
    merged = cut_lineage(fresh.unionByName(stored.join(fresh, CELL_MONTH, "left_anti")))
    replaced = stored.join(fresh, CELL_MONTH, "left_semi")
    peers = products.scan_product(spark, root, "tile_stats", STATS).join(months.select(*monthly.SERIES).distinct(), monthly.SERIES, "left_semi")
    peers = peers.join(months, MONTH, "left_anti")
    stats = cut_lineage(quality.tile_stats(merged, grid, value, burned).select(*peers.columns))
    # Cut, since the tables that it reads are about to be written.
    good = cut_lineage(quality.passed_tiles(quality.check_tiles(stats.unionByName(peers), burned)).join(months, MONTH, "left_semi"))
    changes = cut_lineage(state.signed(fresh, replaced).join(good, MONTH, "left_semi"))
    # Statistics lie in a file a year: those of its other months go along.
    years = good.select(*state.YEAR).distinct()
    kept = cut_lineage(stats.join(good, MONTH, "left_semi").unionByName(peers.join(years, state.YEAR, "left_semi")))
    return Load(good, merged.join(good, MONTH, "left_semi"), changes, kept)


def store_load(load: Load, root: str, table: str, updates: list[tuple[state.Table, DataFrame]]) -> None:
    """State first, in the order given, then the cells: a load that stops in between can be run again."""
    for target, rows in updates:
        target.write(rows, root)
    products.write_product(load.kept, root, table, ["year", "month"])
    products.write_product(load.stats, root, "tile_stats", ["year"])
    # What has changed since the annual products were made.
    load.series().write.mode("append").parquet(f"{root}/annual_pending")


def refresh_monthly(spark: SparkSession, root: str, batch: DataFrame, grid: DataFrame, layers: Layers | None = None, load_id: str = "") -> None:
    """Take in vegetation cells and bring the monthly products of the months and series they touch up to date."""
    load = checked_load(spark, root, "cell_month", CELLS, "value", batch, grid)
    if load.months.isEmpty():
        return
    updates = state.vegetation_updates(spark, root, load.changes, layers.class_cells if layers else None, load_id)
    store_load(load, root, "cell_month", updates)
    products.write_product(state.month_means(load.years(state.MONTH_SUM, spark, root)), root, "ndvi_monthly", ["year"])
    series = cut_lineage(load.series())
    refresh_series(spark, root, series)
    if layers:
        products.write_product(state.class_months(load.years(state.CLASS_MONTH, spark, root), layers.classes), root, "ndvi_monthly_by_class", ["year"])
        by_class = of_series(spark, root, "ndvi_monthly_by_class", BY_CLASS, series)
        baselines = cut_lineage(monthly.class_baselines(by_class))
        products.write_product(baselines, root, "ndvi_monthly_baselines_by_class")
        products.write_product(monthly.ndvi_anomaly_monthly(by_class, baselines), root, "ndvi_anomaly_monthly")


def refresh_series(spark: SparkSession, root: str, series: DataFrame) -> None:
    """What reads whole monthly series, a few hundred rows each: baselines and trends."""
    table = of_series(spark, root, "ndvi_monthly", MONTHLY, series)
    products.write_product(monthly.ndvi_monthly_baselines(table), root, "ndvi_monthly_baselines")
    products.write_product(trend.ndvi_trend_stats(table, monthly.ndvi_annual(table)), root, "ndvi_trend_stats")


def pending_series(spark: SparkSession, root: str) -> DataFrame:
    """Series that changed since the last annual run."""
    return cut_lineage(products.scan_product(spark, root, "annual_pending", SERIES_KEY).distinct())


def refresh_annual(spark: SparkSession, root: str, grid: DataFrame, layers: Layers | None = None) -> None:
    """The annual products of every series that changed since the last annual run, over all its years: a new
    year moves the usual values of the others. They read state and monthly products, no cells."""
    series = pending_series(spark, root)
    table = of_series(spark, root, "ndvi_monthly", MONTHLY, series)
    years = cut_lineage(monthly.ndvi_annual(table))
    products.write_product(years, root, "ndvi_annual")
    cells = state.CELL_YEAR.scan(spark, root).join(broadcast_if_small(series), monthly.SERIES, "left_semi")
    means = state.cell_year_means(cells, years)
    products.write_product(annual_ops.ndvi_annual_delta(means, years, grid), root, "ndvi_annual_delta")
    if layers:
        by_class = cut_lineage(of_series(spark, root, "ndvi_monthly_by_class", BY_CLASS, series))
        baselines = of_series(spark, root, "ndvi_monthly_baselines_by_class", CLASS_BASELINES, series)
        anomaly = of_series(spark, root, "ndvi_anomaly_monthly", ANOMALY, series)
        products.write_product(annual_ops.ndvi_annual_by_class(by_class), root, "ndvi_annual_by_class")
        products.write_product(annual_ops.anomaly_resilience(anomaly, baselines), root, "ndvi_anomaly_resilience")
        products.write_product(annual_ops.ndvi_phenology(by_class, layers.profiles), root, "ndvi_phenology")
    clear_pending(spark, root)


def clear_pending(spark: SparkSession, root: str) -> None:
    spark.createDataFrame([], SERIES_KEY).write.mode("overwrite").parquet(f"{root}/annual_pending")


def refresh_burned(spark: SparkSession, root: str, batch: DataFrame, grid: DataFrame, load_id: str = "") -> None:
    """Take in burn dates and bring the monthly burned areas of what they touch up to date."""
    load = checked_load(spark, root, "burn_month", BURNS, "burn_date", batch, grid, burned=True)
    if load.months.isEmpty():
        return
    store_load(load, root, "burn_month", state.burn_updates(spark, root, load.changes, load_id))
    products.write_product(state.burned_months(load.years(state.BURN_ROW, spark, root), grid), root, "ba_month", ["year"])
    months = of_series(spark, root, "ba_month", BA_MONTH, cut_lineage(load.series()))
    products.write_product(monthly.ba_bands(months), root, "ba_monthly")


def refresh_return_periods(spark: SparkSession, root: str) -> None:
    """Fire return periods of the areas that changed since the last annual run, from the years burned by cell."""
    series = pending_series(spark, root)
    cells = state.BURN_CELL.scan(spark, root).join(broadcast_if_small(series), monthly.SERIES, "left_semi")
    counts = state.burn_counts(cells, of_series(spark, root, "ba_month", BA_MONTH, series)).drop("sensor")
    products.write_product(annual_ops.fire_return_period(counts), root, "fire_return_period")
    clear_pending(spark, root)


def ba_daily(spark: SparkSession, root: str) -> DataFrame:
    """Burned km2 by day, straight from the counts by day that the refresh keeps."""
    return state.burned_days(state.BURN_DAY.scan(spark, root)).select("aoi", "resolution", "year", "date", "burned_km2")


def run_stream(spark: SparkSession, inbox: str, root: str, checkpoint: str, schema: str, table: str, table_schema: str,
               take_in: Callable[[DataFrame, str], None], annual: Callable[[], None], last_annual_year: int, force_annual: bool) -> int | None:
    """Process the files that arrived since the last run, then the annual products if a year completed.

    `table` is the monthly product that tells which months there are. Every run adds a row to the run log.
    Returns the newly completed year, if any.
    """
    before = products.scan_product(spark, root, table, table_schema).count()
    arrived = F.struct("_metadata.file_modification_time", "_metadata.file_path").alias("arrived")
    stream = spark.readStream.schema(schema).parquet(inbox).select("*", arrived)
    query = (
        stream.writeStream.foreachBatch(lambda batch, number: take_in(batch, f"{checkpoint}:{number}"))
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    months = products.scan_product(spark, root, table, table_schema)
    combos = months.select(*monthly.SERIES).distinct()
    newest = incremental.complete_years(months, combos).agg(F.max("year").alias("year")).first()
    year = newest.year if newest is not None and newest.year is not None and newest.year > last_annual_year else None
    if year is not None or force_annual:
        annual()
    added = months.count() - before
    log = spark.range(1).select(
        F.current_timestamp().cast("timestamp_ntz").alias("run_timestamp"), F.lit(added).cast("int").alias("new_months_fetched"),
        F.lit(added > 0).alias("pass_a_ran"), F.lit(year is not None or force_annual).alias("pass_b_ran"), F.lit(year).cast("int").alias("new_year_detected"),
        F.lit(False).alias("deploy_ran"), F.lit("success").alias("status"), F.lit(None).cast("string").alias("error_message"),
    )
    products.append_run_log(log, f"{root}/run_log")
    return year


def run_refresh(spark: SparkSession, inbox: str, root: str, checkpoint: str, grid: DataFrame, last_annual_year: int = 0,
                layers: Layers | None = None, force_annual: bool = False) -> int | None:
    """The vegetation products; those by class too where `layers` are given. Vegetation and burned area have a root of their own."""
    return run_stream(
        spark, inbox, root, checkpoint, CELLS, "ndvi_monthly", MONTHLY,
        lambda batch, load_id: refresh_monthly(spark, root, batch, grid, layers, load_id),
        lambda: refresh_annual(spark, root, grid, layers), last_annual_year, force_annual)


def run_burned_refresh(spark: SparkSession, inbox: str, root: str, checkpoint: str, grid: DataFrame, last_annual_year: int = 0,
                       force_annual: bool = False) -> int | None:
    """The burned-area products, and the fire return periods if a year completed."""
    return run_stream(
        spark, inbox, root, checkpoint, BURNS, "ba_month", BA_MONTH,
        lambda batch, load_id: refresh_burned(spark, root, batch, grid, load_id),
        lambda: refresh_return_periods(spark, root), last_annual_year, force_annual)
