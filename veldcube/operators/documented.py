"""Readings of the product tables that the companion dashboard describes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from veldcube.functions import fixed
from veldcube.functions.columns import normal_cdf_complement_two_sided
from veldcube.operators.monthly import SERIES
from veldcube.operators.order_stats import exact_percentiles

# Largest cv that counts as stable, per class, and its wording.
CV_LABELS = [
    ("Trees", 0.05, "Stable & highly productive"),
    ("Rangeland", 0.05, "Stable & productive"),
    ("Crops", 0.08, "Consistent productivity"),
]


def prior_years_baseline(monthly: DataFrame) -> DataFrame:
    """Each month against the same calendar month of strictly earlier years (a window of years)."""
    earlier = Window.partitionBy(*SERIES, "month").orderBy("year").rowsBetween(Window.unboundedPreceding, -1)
    v = F.col("mean_ndvi")
    return monthly.select(
        *SERIES, "year", "month", "mean_ndvi", F.min(v).over(earlier).alias("lower"), F.max(v).over(earlier).alias("upper"),
        F.avg(v).over(earlier).alias("climatology"), (v - F.avg(v).over(earlier)).alias("anomaly"),
    )


def signed_rank_tails(largest: int = 12) -> list[list[float]]:
    """Lower-tail probabilities P(V <= v) of the signed-rank statistic for 0..largest values.

    The number of rank subsets with each sum grows by one rank at a time.
    """
    counts, tails = [1], [[1.0]]
    for rank in range(1, largest + 1):
        counts = [
            (counts[v] if v < len(counts) else 0) + (counts[v - rank] if v >= rank else 0)
            for v in range(len(counts) + rank)
        ]
        total, running = 2**rank, 0
        tail = []
        for c in counts:
            running += c
            tail.append(running / total)
        tails.append(tail)
    return tails


def wilcoxon_signed_rank(anomalies: DataFrame) -> DataFrame:
    """Signed-rank test of a year's monthly anomalies against zero, for three or more non-NULL values.

    Exact without ties and zeros; otherwise zeros are left out and the normal approximation with
    continuity and tie correction applies. A group has at most twelve values.
    """
    key = [*SERIES, "year"]
    rows = anomalies.where("anomaly IS NOT NULL")
    groups = rows.groupBy(*key).agg(F.count(F.lit(1)).alias("n"), F.percentile("anomaly", F.lit(0.5)).alias("median_anomaly"))
    size = F.abs("anomaly")
    by_size = Window.partitionBy(*key).orderBy(size)
    ties = Window.partitionBy(*key, size)
    ranked = rows.where("anomaly <> 0").withColumn("t", F.count(F.lit(1)).over(ties)).withColumn(
        "rank", F.rank().over(by_size) + (F.col("t") - 1) / 2.0
    )
    sums = ranked.groupBy(*key).agg(
        F.sum(F.when(F.col("anomaly") > 0, F.col("rank")).otherwise(0.0)).alias("v"), F.count(F.lit(1)).alias("m"),
        F.sum((F.col("t") * F.col("t") - 1) / 48.0).alias("tie"),
    )
    m = F.col("m")
    mean = m * (m + 1) / 4.0
    var = m * (m + 1) * (2 * m + 1) / 24.0 - F.col("tie")
    centred = F.col("v") - mean
    z = (centred - F.signum(centred) * 0.5) / F.sqrt(F.nullif(var, F.lit(0.0)))
    tails = F.array(*[F.array(*[F.lit(p) for p in tail]) for tail in signed_rank_tails()])
    own = F.element_at(tails, (m + 1).cast("int"))
    low = F.element_at(own, (F.col("v") + 1).cast("int"))
    high = F.when(F.col("v") > 0, 1 - F.element_at(own, F.greatest(F.col("v"), F.lit(1.0)).cast("int"))).otherwise(1.0)
    exact = F.least(2 * F.least(low, high), F.lit(1.0))
    plain = (F.col("tie") == 0) & (m == F.col("n"))
    return groups.where("n >= 3").join(sums, key, "left").select(
        *key, "n", "median_anomaly", F.when(plain, exact).otherwise(normal_cdf_complement_two_sided(z)).alias("wilcox_p")
    )


def status_badge(smk: DataFrame, wilcoxon: DataFrame) -> DataFrame:
    degrading = (F.col("smk_p") < fixed.SIGNIFICANCE) & (F.col("smk_sen_slope") < 0)
    stressed = (F.col("wilcox_p") < fixed.SIGNIFICANCE) & (F.col("median_anomaly") < 0)
    label = F.when(degrading, "Degrading").when(stressed, "Mild stress").otherwise("Stable")
    return wilcoxon.join(smk.select(*SERIES, "smk_p", "smk_sen_slope"), SERIES, "left").select(
        *SERIES, "year", label.alias("status_badge")
    )


def normalised_delta(cells: DataFrame) -> DataFrame:
    """(test - train) / (test + train) per cell and month; train is the mean of strictly earlier years."""
    earlier = Window.partitionBy(*SERIES, "row_idx", "col_idx", "month").orderBy("year").rowsBetween(Window.unboundedPreceding, -1)
    train = F.avg("value").over(earlier)
    total = F.nullif(F.col("value") + F.col("train"), F.lit(0.0))
    return cells.withColumn("train", train).where("train IS NOT NULL AND value IS NOT NULL").select(
        *SERIES, "year", "month", "row_idx", "col_idx", ((F.col("value") - F.col("train")) / total).alias("delta_ndvi")
    )


def symmetric_delta_range(deltas: DataFrame, group: list[str], value: str) -> DataFrame:
    """Largest magnitude of the 2nd and 98th percentile of the deltas."""
    tails = exact_percentiles(deltas, group, value, {"p02": 0.02, "p98": 0.98}, None)
    return tails.select(*group, F.greatest(F.abs("p02"), F.abs("p98")).alias("max_abs"))


def burned_percentage(ba: DataFrame, areas: DataFrame) -> DataFrame:
    """Burned share of the area; at most 1 km2 counts as none."""
    share = F.col("burned_km2") / F.col("area_km2") * 100
    return ba.join(areas, "aoi").select("aoi", "year", "month", F.when(F.col("burned_km2") <= 1, 0.0).otherwise(share).alias("pct_burned"))


def cv_label() -> Column:
    label = F.lit("")
    for name, limit, text in CV_LABELS:
        label = F.when((F.col("land_cover") == name) & (F.col("cv") < limit), text).otherwise(label)
    return label


def productivity_change(annual_by_class: DataFrame) -> DataFrame:
    """Change of the annual mean from the year before, and what the cv says about the class."""
    before = annual_by_class.select(
        *SERIES, "land_cover", (F.col("year") + 1).alias("year"), F.col("annual_mean").alias("before")
    )
    return annual_by_class.join(before, [*SERIES, "land_cover", "year"]).select(
        *SERIES, "land_cover", "year", (F.col("annual_mean") - F.col("before")).alias("change"), cv_label().alias("interpretation")
    )


def linear_trend(monthly: DataFrame) -> DataFrame:
    """Least-squares slope of annual means over years with six or more months."""
    years = monthly.groupBy(*SERIES, "year").agg(F.avg("mean_ndvi").alias("y"), F.count("mean_ndvi").alias("n")).where("n >= 6")
    return years.groupBy(*SERIES).agg(
        F.regr_slope("y", F.col("year").cast("double")).alias("slope_per_year"), F.count(F.lit(1)).alias("n_years")
    )


def last_years(table: DataFrame, n: int = 4) -> DataFrame:
    """The last n years available for each calendar month."""
    years = table.select(*SERIES, "year", "month").distinct()
    order = Window.partitionBy(*SERIES, "month").orderBy(F.desc("year"))
    return years.withColumn("rn", F.row_number().over(order)).where(F.col("rn") <= n).drop("rn")


def fire_season(daily: DataFrame, months: list[int]) -> DataFrame:
    return daily.where(F.month("date").isin(months))

