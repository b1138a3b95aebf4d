"""Scene masks and monthly composites: one row per cell and month."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veldcube.functions import fixed
from veldcube.functions.columns import normalized_difference, scale_ndvi, scl_visible

CELL = ["aoi", "sensor", "resolution", "row_idx", "col_idx"]
CELL_MONTH = ["aoi", "sensor", "resolution", "year", "month", "row_idx", "col_idx"]
# Scenes may repeat; this order makes "first" and "latest" the same on every run.
SCENE_ORDER = ["acq_ts", "b8", "b4", "scl", "burn_date", "burn_qa"]


def scan_scenes(obs: DataFrame, start: str, end: str, max_cloud: float = fixed.MAX_CLOUD_PCT,
                rows: tuple[int, int] | None = None, cols: tuple[int, int] | None = None) -> DataFrame:
    """Scenes with start <= date < end (ISO dates), cloud below the limit, cells inside the box."""
    ts = F.col("acq_ts")
    kept = obs.where((ts >= F.lit(start).cast("timestamp_ntz")) & (ts < F.lit(end).cast("timestamp_ntz")))
    kept = kept.where(F.col("cloud_pct") < max_cloud)
    if rows:
        kept = kept.where(F.col("row_idx").between(*rows))
    if cols:
        kept = kept.where(F.col("col_idx").between(*cols))
    return kept


def mask_scl(obs: DataFrame, legacy: bool = False) -> DataFrame:
    return obs.where(scl_visible(F.col("scl"), fixed.LEGACY_MASKED_SCL if legacy else None))


def mask_summary_qa(obs: DataFrame) -> DataFrame:
    return obs.where(F.col("summary_qa") <= fixed.MAX_SUMMARY_QA)


def with_ndvi(obs: DataFrame) -> DataFrame:
    return obs.withColumn("ndvi", normalized_difference(F.col("b8"), F.col("b4")))


def with_scaled_ndvi(obs: DataFrame) -> DataFrame:
    return obs.withColumn("ndvi", scale_ndvi(F.col("ndvi_raw")))


def visible_ndvi(obs: DataFrame, legacy: bool = False) -> DataFrame:
    """Masked observations keep their row with a NULL value: a month whose cells are all hidden
    must still appear downstream."""
    seen = obs.where(F.col("cloud_pct") < fixed.MAX_CLOUD_PCT)
    visible = scl_visible(F.col("scl"), fixed.LEGACY_MASKED_SCL if legacy else None)
    return with_ndvi(seen).withColumn("value", F.when(visible, F.col("ndvi")))


def scene_median(seen: DataFrame) -> DataFrame:
    """Median of a cell's scenes of a month. The calendar bounds how many there are, so one combinable aggregate
    does; medians of areas or of all cells, which nothing bounds, are those of `order_stats`."""
    return seen.groupBy(*CELL_MONTH).agg(F.median("value").alias("value"))


def monthly_median_composite(obs: DataFrame, legacy_mask: bool = False) -> DataFrame:
    return scene_median(visible_ndvi(obs, legacy_mask))


def modis_median_composite(obs: DataFrame) -> DataFrame:
    scaled = with_scaled_ndvi(obs)
    good = F.col("summary_qa") <= fixed.MAX_SUMMARY_QA
    return scene_median(scaled.withColumn("value", F.when(good, F.col("ndvi"))))


def monthly_mosaic_composite(obs: DataFrame, legacy_mask: bool = True) -> DataFrame:
    """Latest visible value on top; keeps no state beyond one value per cell and month."""
    seen = visible_ndvi(obs, legacy_mask)
    order = F.when(F.col("value").isNotNull(), F.struct(*SCENE_ORDER))
    return seen.groupBy(*CELL_MONTH).agg(F.max_by("value", order).alias("value"))


def paired_composites(obs: DataFrame) -> DataFrame:
    """The median composite and, as `old_value`, the legacy mosaic, in one pass over the scenes."""
    seen = visible_ndvi(obs).withColumn("old", F.when(scl_visible(F.col("scl"), fixed.LEGACY_MASKED_SCL), F.col("ndvi")))
    order = F.when(F.col("old").isNotNull(), F.struct(*SCENE_ORDER))
    return seen.groupBy(*CELL_MONTH).agg(F.median("value").alias("value"), F.max_by("old", order).alias("old_value"))


BURN_BANDS = ["burn_date", "first_day", "last_day", "burn_qa"]


def _burn_composite(obs: DataFrame, pick) -> DataFrame:
    keys = [k for k in CELL_MONTH if k != "sensor"]
    best = obs.groupBy(*keys).agg(pick(F.struct(*BURN_BANDS), F.struct(*SCENE_ORDER)).alias("b"))
    return best.select(
        "aoi", F.lit("burned_area").alias("sensor"), *keys[1:], *[F.col(f"b.{c}").alias(c) for c in BURN_BANDS]
    )


def first_image_composite(obs: DataFrame) -> DataFrame:
    """Burn date of the first image of the month; a month without images gives no row."""
    return _burn_composite(obs, F.min_by)


def cells_and_burns(obs: DataFrame) -> DataFrame:
    """The median composite (`value`, of `n_seen` scenes) and the bands of the first image (`b`) in one pass over the
    scenes of one sensor."""
    visible = (F.col("cloud_pct") < fixed.MAX_CLOUD_PCT) & scl_visible(F.col("scl"))
    return with_ndvi(obs).groupBy(*CELL_MONTH).agg(
        F.count_if(F.col("cloud_pct") < fixed.MAX_CLOUD_PCT).alias("n_seen"), F.median(F.when(visible, F.col("ndvi"))).alias("value"),
        F.min_by(F.struct(*BURN_BANDS), F.struct(*SCENE_ORDER)).alias("b"),
    )


def last_image_composite(obs: DataFrame) -> DataFrame:
    """The latest image instead: the second source that comparisons are run against."""
    return _burn_composite(obs, F.max_by)


def latest_available_month(obs: DataFrame) -> DataFrame:
    return obs.groupBy("aoi").agg(F.max("acq_ts").alias("ts")).select(
        "aoi", F.year("ts").alias("year"), F.month("ts").alias("month")
    )
