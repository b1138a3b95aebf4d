"""Trend statistics of annual and monthly series.

A series has one value per year (or month), so its length is bounded by the calendar, not by the
number of cells. Each series becomes one sorted array and the tests are array expressions in the
row: no pairs are shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from veldcube.functions import fixed
from veldcube.functions.columns import normal_cdf_complement_two_sided
from veldcube.operators.monthly import SERIES

_PAIR_SUM = """
aggregate(slice(sequence(1, size(x) + 1), 1, size(x)), 0D, (s, i) ->
  s + aggregate(slice(x, i + 1, size(x)), 0D, (t, v) -> t + signum(v - x[i - 1])))
"""
_SLOPES = """
flatten(transform(x, (a, i) -> transform(slice(x, i + 2, size(x)), (b, k) -> (b - a) / (k + 1))))
"""
_VARIANCE = """
(size(x) * (size(x) - 1D) * (2D * size(x) + 5D)
 - aggregate(transform(array_distinct(x), v -> size(filter(x, y -> y = v))), 0D,
             (s, t) -> s + t * (t - 1D) * (2D * t + 5D))) / 18D
"""
_MEDIAN = """
CASE WHEN size(p) = 0 THEN CAST(NULL AS DOUBLE)
     WHEN size(p) % 2 = 1 THEN p[CAST(floor(size(p) / 2) AS INT)]
     ELSE (p[CAST(size(p) / 2 AS INT) - 1] + p[CAST(size(p) / 2 AS INT)]) / 2D END
"""


def _with_test(df: DataFrame, s: str, var: str, p: str) -> DataFrame:
    z = (
        F.when(F.col(s) > 0, (F.col(s) - 1) / F.sqrt(F.nullif(F.col(var), F.lit(0.0))))
        .when(F.col(s) < 0, (F.col(s) + 1) / F.sqrt(F.nullif(F.col(var), F.lit(0.0))))
        .otherwise(F.lit(0.0))
    )
    return df.withColumn(p, normal_cdf_complement_two_sided(z))


def _mk_columns(df: DataFrame, keep: list[str]) -> DataFrame:
    """Statistics of the array column x: n, mk_s, mk_var, sen_slope, mk_p."""
    stats = df.select(
        *keep,
        F.size("x").alias("n"),
        F.expr(_PAIR_SUM).alias("mk_s"),
        F.expr(_VARIANCE).alias("mk_var"),
        F.array_sort(F.expr(_SLOPES)).alias("p"),
    ).withColumn("sen_slope", F.expr(_MEDIAN)).drop("p")
    return _with_test(stats, "mk_s", "mk_var", "mk_p")


def mann_kendall(series: DataFrame, keys: list[str], order: str, value: str) -> DataFrame:
    """S, tie-corrected variance, two-sided p and Sen slope per index step of each ordered series."""
    ordered = F.array_sort(F.collect_list(F.struct(order, value)))
    arrays = series.groupBy(*keys).agg(F.transform(ordered, lambda e: e[value]).alias("x"))
    return _mk_columns(arrays, keys)


def seasonal_mann_kendall(monthly: DataFrame) -> DataFrame:
    """Twelve seasons by position in the series without its NULL months, so a gap shifts them."""
    placed = monthly.where("mean_ndvi IS NOT NULL").withColumn(
        "pos", F.row_number().over(Window.partitionBy(*SERIES).orderBy("year", "month")) - 1
    )
    seasons = (
        placed.groupBy(*SERIES, (F.col("pos") % 12).alias("season"))
        .agg(F.array_sort(F.collect_list(F.struct("pos", "mean_ndvi"))).alias("o"))
        .select(*SERIES, F.transform("o", lambda e: e["mean_ndvi"]).alias("x"))
        .select(
            *SERIES, F.size("x").alias("n"), F.expr(_PAIR_SUM).alias("s"), F.expr(_VARIANCE).alias("v"),
            F.expr(_SLOPES).alias("slopes"),
        )
    )
    whole = seasons.groupBy(*SERIES).agg(
        F.sum("n").cast("int").alias("n_points"),
        F.sum("s").alias("smk_s"),
        F.sum("v").alias("smk_var"),
        F.array_sort(F.flatten(F.collect_list("slopes"))).alias("p"),
    ).where(F.col("n_points") >= fixed.MIN_SEASONAL_MONTHS)
    return _with_test(whole.withColumn("smk_sen_slope", F.expr(_MEDIAN)).drop("p"), "smk_s", "smk_var", "smk_p")


RANGES = ["q1_ndvi", "q3_ndvi", "min_ndvi", "max_ndvi", "long_term_avg"]


def _range_aggregates(value: Column) -> list[Column]:
    """NULL below five values."""
    aggs = [
        F.percentile(value, F.lit(0.25)), F.percentile(value, F.lit(0.75)), F.min(value), F.max(value), F.avg(value),
    ]
    enough = F.sum(F.col("is_complete").cast("int")) >= fixed.MIN_TREND_YEARS
    return [F.when(enough, a).alias(n) for n, a in zip(RANGES, aggs)]


def annual_range_stats(annual: DataFrame) -> DataFrame:
    """Quartiles, extremes and mean of complete years; NULL below five of them."""
    return annual.where("is_complete").groupBy(*SERIES).agg(
        F.count(F.lit(1)).cast("int").alias("n_complete_years"), *_range_aggregates(F.col("mean_ndvi"))
    )


def annual_trend(annual: DataFrame) -> DataFrame:
    mk = mann_kendall(annual.where("is_complete"), SERIES, "year", "mean_ndvi")
    return mk.where(F.col("n") >= fixed.MIN_TREND_YEARS).withColumn("trend_direction", direction_label())


def direction_label():
    """A slope of exactly zero counts as increasing when the test is significant."""
    return F.when(
        F.col("mk_p") < fixed.SIGNIFICANCE, F.when(F.col("sen_slope") < 0, "decreasing").otherwise("increasing")
    ).otherwise("no_trend")


def ndvi_trend_stats(monthly: DataFrame, annual: DataFrame) -> DataFrame:
    """Everything annual comes from one pass over the years of a series, the seasonal test from its months."""
    value = F.when(F.col("is_complete"), F.col("mean_ndvi"))
    ordered = F.array_sort(F.collect_list(F.when(F.col("is_complete"), F.struct("year", "mean_ndvi"))))
    per_series = annual.groupBy(*SERIES).agg(
        F.sum(F.col("is_complete").cast("int")).cast("int").alias("n_complete_years"),
        F.transform(ordered, lambda e: e["mean_ndvi"]).alias("x"), *_range_aggregates(value),
    )
    tested = _mk_columns(per_series, [*SERIES, "n_complete_years", *RANGES])
    enough = F.col("n_complete_years") >= fixed.MIN_TREND_YEARS
    smk = seasonal_mann_kendall(monthly).select(*SERIES, "smk_p", "smk_sen_slope")
    return tested.join(smk, SERIES, "left").select(
        *SERIES, "n_complete_years", F.when(enough, F.col("mk_p")).alias("mk_p"), F.when(enough, F.col("sen_slope")).alias("sen_slope"),
        F.when(enough, direction_label()).otherwise("insufficient_data").alias("trend_direction"),
        *RANGES, "smk_p", "smk_sen_slope",
    )
