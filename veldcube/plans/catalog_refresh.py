"""Products kept by the incremental refresh, after loads that deliver months in parts and again."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veldcube.plans.catalog_sources import MONTH, SY, shared_folder
from veldcube.plans.registry import query
from veldcube.sources import dims, products
from veldcube.streaming import refresh


def vegetation_root(c, layers: bool = True) -> str:
    """Cells arrive in two loads: the second one replaces a year of the first that came with other values,
    completes months of which only some columns had come, and adds the later years."""
    folder = shared_folder(c, "inbox")
    inbox, root, marks = f"{folder}/in", f"{folder}/out", f"{folder}/marks"
    with_layers = refresh.Layers(dims.land_cover_cells(c.spark), dims.aoi_classes(c.spark), dims.phenology_profiles(c.spark)) if layers else None
    late = F.col("year") >= 1998
    other = F.when(late & (F.col("col_idx") > 2), F.lit(None)).when(late, F.col("value") / 2).otherwise(F.col("value"))
    half = (F.col("year") == 1997) & (F.col("month") > 6) & (F.col("row_idx") % 2 == 1)
    cells = c.stored_cells
    cells.withColumn("value", other).where((F.col("year") < 1999) & ~half).write.mode("append").parquet(inbox)
    done = refresh.run_refresh(c.spark, inbox, root, marks, c.grid, 0, with_layers)
    cells.where(late | half).write.mode("append").parquet(inbox)
    refresh.run_refresh(c.spark, inbox, root, marks, c.grid, 0 if done is None else done - 1, with_layers)
    return root


def burned_root(c) -> str:
    """Burn dates in two loads: a year of the first one had burned elsewhere."""
    folder = shared_folder(c, "inbox")
    inbox, root, marks = f"{folder}/in", f"{folder}/out", f"{folder}/marks"
    burns = c.stored_burns.select("row_idx", "col_idx", "burn_date", *MONTH)
    late = F.col("year") >= 1998
    elsewhere = F.when(late, F.when(F.col("burn_date") > 0, 0).otherwise(F.col("month"))).otherwise(F.col("burn_date"))
    burns.withColumn("burn_date", elsewhere.cast("int")).where("year < 1999").write.mode("append").parquet(inbox)
    done = refresh.run_burned_refresh(c.spark, inbox, root, marks, c.grid)
    burns.where(late).write.mode("append").parquet(inbox)
    refresh.run_burned_refresh(c.spark, inbox, root, marks, c.grid, 0 if done is None else done - 1)
    return root


def stored(c, root: str, table: str, schema: str) -> DataFrame:
    return products.scan_product(c.spark, root, table, schema)


@query("i7_refresh", f"SELECT {SY}, mean_ndvi, n_valid_px FROM a1", "mean_ndvi")
def _(c):
    return stored(c, vegetation_root(c, layers=False), "ndvi_monthly", refresh.MONTHLY).select(*MONTH, "mean_ndvi", "n_valid_px")


@query("i7_by_class", f"SELECT {SY}, land_cover, mean_ndvi, n_valid_px FROM a7", "mean_ndvi")
def _(c):
    return stored(c, vegetation_root(c), "ndvi_monthly_by_class", refresh.BY_CLASS)


@query("i7_resilience", "b7", "max_deficit resilience_score")
def _(c):
    return stored(c, vegetation_root(c), "ndvi_anomaly_resilience", refresh.RESILIENCE)


@query("i7_annual_delta", "b13", "gain_km2 loss_km2 total_km2")
def _(c):
    return stored(c, vegetation_root(c, layers=False), "ndvi_annual_delta", refresh.DELTA)


@query("i7_ba_monthly", "a9", "burned_km2 ba_mean ba_lower_ci ba_upper_ci")
def _(c):
    return stored(c, burned_root(c), "ba_monthly", refresh.BA_MONTHLY)


@query("i7_frp", "b15", "frp_years")
def _(c):
    return stored(c, burned_root(c), "fire_return_period", refresh.FRP)
