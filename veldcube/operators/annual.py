"""Annual analytics: class statistics, resilience, phenology, year-to-year change, fire return."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from veldcube.functions import fixed
from veldcube.functions.columns import row_area
from veldcube.operators.monthly import SERIES

CLASS = [*SERIES, "land_cover"]
CLASS_YEAR = [*SERIES, "year", "land_cover"]
CELL = [*SERIES, "row_idx", "col_idx"]


def ndvi_annual_by_class(by_class: DataFrame) -> DataFrame:
    annual = by_class.groupBy(*CLASS_YEAR).agg(F.avg("mean_ndvi").alias("annual_mean"))
    years = Window.partitionBy(*CLASS)
    mean, sd = F.col("hist_mean_all"), F.col("hist_sd")
    return (
        annual.withColumn("hist_min", F.min("annual_mean").over(years))
        .withColumn("hist_max", F.max("annual_mean").over(years))
        .withColumn("hist_mean_all", F.avg("annual_mean").over(years))
        .withColumn("hist_sd", F.stddev_samp("annual_mean").over(years))
        .withColumn("cv", F.when(mean != 0, sd / F.abs(mean)))
    )


def complete_class_years(anomaly: DataFrame) -> DataFrame:
    """Rows of years that have every month of every class that the series ever has."""
    classes = anomaly.groupBy(*SERIES).agg(F.count_distinct("land_cover").alias("n_classes"))
    years = anomaly.groupBy(*SERIES, "year").agg(F.count_distinct("month", "land_cover").alias("n_pairs"))
    full = years.join(classes, SERIES).where(F.col("n_pairs") == fixed.MONTHS_PER_YEAR * F.col("n_classes"))
    return anomaly.join(full.select(*SERIES, "year"), [*SERIES, "year"], "left_semi")


def max_deficit(anomaly: DataFrame) -> DataFrame:
    """Lowest anomaly and the earliest month that has it; classes with no value are skipped."""
    worst = anomaly.where("anomaly_value IS NOT NULL").groupBy(*CLASS_YEAR).agg(
        F.min(F.struct("anomaly_value", "month")).alias("w")
    )
    return worst.select(*CLASS_YEAR, F.col("w.anomaly_value").alias("max_deficit"), F.col("w.month").alias("deficit_month"))


def recovery_months(anomaly: DataFrame, deficits: DataFrame, baselines: DataFrame) -> DataFrame:
    """Months from the deficit to the first later month of the year within one standard deviation."""
    sd = baselines.select(*CLASS, "month", "hist_sd")
    near = F.abs(F.col("mean_ndvi") - F.col("hist_mean")) <= F.col("hist_sd")
    later = near & (F.col("month") > F.col("deficit_month"))
    months = anomaly.join(sd, [*CLASS, "month"], "left").join(deficits, CLASS_YEAR)
    return months.groupBy(*CLASS_YEAR, "max_deficit", "deficit_month").agg(
        (F.min(F.when(later, F.col("month"))) - F.col("deficit_month")).cast("int").alias("recovery_months")
    )


def severity_label(deficit):
    label = F.lit("Minimal")
    for name, limit in reversed(fixed.SEVERITY):
        label = F.when(deficit < limit, name).otherwise(label)
    return label


def resilience_scores(recovered: DataFrame) -> DataFrame:
    """Deficit times recovery; an unrecovered class counts twice the year's longest recovery."""
    year = Window.partitionBy(*SERIES, "year")
    longest = F.max("recovery_months").over(year)
    months = F.coalesce(F.col("recovery_months"), longest * 2, F.lit(fixed.NO_RECOVERY_PENALTY))
    scored = recovered.withColumn("resilience_score", F.abs("max_deficit") * months)
    return scored.withColumn("resilience_rank", F.rank().over(year.orderBy("resilience_score")).cast("int"))


def anomaly_resilience(anomaly: DataFrame, baselines: DataFrame) -> DataFrame:
    complete = complete_class_years(anomaly)
    recovered = recovery_months(complete, max_deficit(complete), baselines)
    return resilience_scores(recovered).select(
        *SERIES, F.col("year").alias("anomaly_year"), "land_cover", "max_deficit", "deficit_month",
        "recovery_months", "resilience_score", "resilience_rank",
        severity_label(F.col("max_deficit")).alias("severity"),
    )


def with_profile(by_class: DataFrame, profiles: DataFrame) -> DataFrame:
    """Attach the phenology profile whose key is a prefix of the area name; the first key wins.

    The areas are few: the prefix join runs on their distinct names, not on the rows.
    """
    areas = by_class.select("aoi").distinct()
    first = (
        areas.join(profiles, F.col("aoi").startswith(F.col("profile_key")))
        .groupBy("aoi").agg(F.min("profile_order").alias("profile_order"))
    )
    chosen = first.join(profiles.where(F.col("land_cover").isin(fixed.PHENOLOGY_CLASSES)), "profile_order")
    return by_class.join(chosen, ["aoi", "land_cover"])


def ndvi_phenology(by_class: DataFrame, profiles: DataFrame) -> DataFrame:
    rows = with_profile(by_class, profiles)
    usual = Window.partitionBy(*CLASS, "month")
    rows = rows.withColumn("usual", F.avg("mean_ndvi").over(usual))
    month, value = F.col("month"), F.col("mean_ndvi")
    have = value.isNotNull()
    # Highest value first, earliest month among equals: order by (value, -month).
    in_green = have & month.between(F.col("green_up_lo"), F.col("green_up_hi"))
    in_peak = have & month.between(F.col("peak_lo"), F.col("peak_hi"))
    in_sen = have & month.between(F.col("sen_lo"), F.col("sen_hi")) & (value < F.col("sen_threshold"))
    rank = F.struct(value.alias("v"), (-month).alias("m"), F.col("usual").alias("u"))
    profile = ["green_up_threshold", "conf_lo_min", "peak_delta"]
    base = F.max(F.when(month == F.col("baseline_month"), value)).over(Window.partitionBy(*CLASS_YEAR))
    rows = rows.withColumn("base", base)
    crossed = in_green & (value > F.col("base") + F.col("green_up_threshold"))
    agg = rows.groupBy(*CLASS_YEAR, *profile, "base").agg(
        F.max(F.when(in_green, rank)).alias("g"),
        F.min(F.when(crossed, month)).alias("crossed"),
        F.max(F.when(in_peak, rank)).alias("p"),
        F.min(F.when(in_sen, month)).alias("senescence_month"),
    )
    rise = F.col("g.v") - F.col("base")
    found = rise >= F.col("conf_lo_min")
    thr = F.col("green_up_threshold")
    dev = F.col("p.v") - F.col("p.u")
    delta = F.col("peak_delta")
    out = agg.select(
        *CLASS_YEAR,
        F.when(found, F.coalesce(F.col("crossed"), -F.col("g.m"))).cast("int").alias("green_up_month"),
        F.when(found, F.when(rise > thr * 2, "High").when(rise > thr, "Medium").otherwise("Low"))
        .otherwise("Not detected").alias("green_up_conf"),
        (-F.col("p.m")).cast("int").alias("peak_month"),
        F.col("p.v").alias("peak_ndvi"),
        F.when(dev > delta, "High").when(dev < -delta, "Low").otherwise("Medium").alias("peak_conf"),
        F.col("senescence_month").cast("int").alias("senescence_month"),
    )
    return out.withColumn(
        "season_length", F.pmod(F.col("senescence_month") + 12 - F.col("green_up_month"), F.lit(12)).cast("int")
    )


def annual_cell_mean(cells: DataFrame, annual: DataFrame) -> DataFrame:
    """Mean of the available months of each cell in complete years."""
    complete = annual.where("is_complete").select(*SERIES, "year")
    return cells.join(complete, [*SERIES, "year"], "left_semi").groupBy(*CELL, "year").agg(
        F.avg("value").alias("annual_mean")
    )


def ndvi_annual_delta(cell_means: DataFrame, annual: DataFrame, grid: DataFrame) -> DataFrame:
    """Gain, loss and compared km2 for every ordered pair of complete years.

    One shuffle groups a cell's years (at most one entry per calendar year); its year pairs a < b are
    formed in the row and summed before the next shuffle, which carries one row per (series, pair).
    The reverse pair swaps gain and loss.
    """
    pair_expr = (
        "flatten(transform(y, (a, i) -> transform(slice(y, i + 2, size(y)), "
        "b -> struct(a.year AS year_a, b.year AS year_b, b.annual_mean - a.annual_mean AS d))))"
    )
    area = row_area(F.col("row_idx"), F.col("north"), F.col("dx"), F.col("dy"))
    stacked = (
        cell_means.where("annual_mean IS NOT NULL")
        .groupBy(*CELL).agg(F.array_sort(F.collect_list(F.struct("year", "annual_mean"))).alias("y"))
        .join(grid.select("aoi", "resolution", "north", "dx", "dy"), ["aoi", "resolution"])
        .withColumn("area", area)
    )
    area, d = F.col("area"), F.col("p.d")
    key = [*SERIES, F.col("p.year_a").alias("year_a"), F.col("p.year_b").alias("year_b")]
    forward = stacked.select(*SERIES, "area", F.explode(F.expr(pair_expr)).alias("p")).groupBy(*key).agg(
        F.sum(F.when(d > 0, area).otherwise(0.0)).alias("gain"),
        F.sum(F.when(d < 0, area).otherwise(0.0)).alias("loss"),
        F.sum(area).alias("total"),
    )
    # Two complete years without a common valid cell still give a row of zeros.
    years = annual.where("is_complete").groupBy(*SERIES).agg(
        F.array_sort(F.collect_list(F.struct("year", F.lit(0.0).alias("annual_mean")))).alias("y")
    )
    spine = years.select(*SERIES, F.explode(F.expr(pair_expr)).alias("p")).select(*key)
    both = spine.join(forward, [*SERIES, "year_a", "year_b"], "left").fillna(0.0, ["gain", "loss", "total"])
    return both.select(
        *SERIES,
        F.explode(F.array(
            F.struct("year_a", "year_b", F.col("gain").alias("gain_km2"), F.col("loss").alias("loss_km2")),
            F.struct(F.col("year_b").alias("year_a"), F.col("year_a").alias("year_b"),
                     F.col("loss").alias("gain_km2"), F.col("gain").alias("loss_km2")),
        )).alias("r"),
        F.col("total").alias("total_km2"),
    ).select(*SERIES, "r.year_a", "r.year_b", "r.gain_km2", "r.loss_km2", "total_km2")


def burn_count(burns: DataFrame) -> DataFrame:
    """Years with any burn per cell, and the number of years the area has images for."""
    key = ["aoi", "resolution", "row_idx", "col_idx"]
    per_year = burns.groupBy(*key, "year").agg(F.max(F.when(F.col("burn_date") > 0, 1).otherwise(0)).alias("burned"))
    years = per_year.groupBy("aoi", "resolution").agg(F.count_distinct("year").cast("int").alias("n_years"))
    return per_year.groupBy(*key).agg(F.sum("burned").cast("int").alias("burn_count")).join(years, ["aoi", "resolution"])


def fire_return_period(counts: DataFrame) -> DataFrame:
    """Years per burn, to one decimal (half to even); NULL where nothing burned."""
    frp = F.col("n_years") / F.nullif(F.col("burn_count"), F.lit(0))
    return counts.withColumn("frp_years", F.bround(frp, 1))
