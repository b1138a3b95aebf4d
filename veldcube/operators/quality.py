"""Data-quality checks. Each returns rows (table_name, check, severity, ...) and none when all is well,
or one row per checked item with its verdict."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veldcube.functions import fixed
from veldcube.functions.columns import month_number
from veldcube.operators.annual import severity_label
from veldcube.operators.monthly import SERIES

MONTH = [*SERIES, "year", "month"]


def check_schema(spark: SparkSession, tables: dict[str, DataFrame]) -> DataFrame:
    """Missing required columns fail; a metric that is not floating point is a warning."""
    issues = []
    for name, df in tables.items():
        types = {f.name: f.dataType for f in df.schema.fields}
        issues += [(name, "schema_columns", "fail", c) for c in fixed.PRODUCT_COLUMNS[name] if c not in types]
        issues += [
            (name, "schema_dtype", "warn", f"{c}: {types[c].simpleString()}")
            for c in fixed.FLOAT_COLUMNS[name] if c in types and not isinstance(types[c], (T.FloatType, T.DoubleType))
        ]
    return spark.createDataFrame(issues, "table_name string, check string, severity string, detail string")


def check_new_months(expected: DataFrame, table: DataFrame, severity: str = "fail") -> DataFrame:
    """Expected (aoi, sensor, resolution, year, month) without any row in the table."""
    return expected.join(table.select(*MONTH).distinct(), MONTH, "left_anti").select(
        *MONTH, F.lit("new_month_present").alias("check"), F.lit(severity).alias("severity")
    )


def _metric_summary(df: DataFrame, name: str) -> DataFrame:
    """Per metric column of the table: rows, values, lowest and highest; one pass."""
    metrics = [c for c in fixed.VALUE_RANGES if c in df.columns]
    aggs = [F.count(F.lit(1)).alias("n_rows")]
    for c in metrics:
        v = F.col(c).cast("double")
        aggs += [F.count(c).alias(f"n_{c}"), F.min(v).alias(f"lo_{c}"), F.max(v).alias(f"hi_{c}")]
    return df.agg(*aggs).select(
        F.lit(name).alias("table_name"),
        F.explode(F.array(*[
            F.struct(
                F.lit(c).alias("metric"), F.col("n_rows"), F.col(f"n_{c}").alias("n_values"), F.col(f"lo_{c}").alias("lowest"),
                F.col(f"hi_{c}").alias("highest"), F.lit(fixed.VALUE_RANGES[c][0]).cast("double").alias("low"),
                F.lit(fixed.VALUE_RANGES[c][1]).cast("double").alias("high"),
            ) for c in metrics
        ])).alias("m"),
    ).select("table_name", "m.*")


def metric_summaries(tables: dict[str, DataFrame]) -> DataFrame:
    parts = [_metric_summary(df, name) for name, df in tables.items()]
    whole = parts[0]
    for p in parts[1:]:
        whole = whole.unionByName(p)
    return whole


def check_ranges(summary: DataFrame) -> DataFrame:
    """Every metric with its verdict against its range; an open bound or an empty column passes."""
    below = F.coalesce(F.col("lowest") < F.col("low"), F.lit(False))
    above = F.coalesce(F.col("highest") > F.col("high"), F.lit(False))
    return summary.select(
        "table_name", "metric", "lowest", "highest", below.alias("below"), above.alias("above"),
        F.when(below | above, "fail").otherwise("ok").alias("severity"),
    )


def check_all_null(summary: DataFrame) -> DataFrame:
    empty = (F.col("n_values") == 0) & F.col("metric").isin("mean_ndvi", "burned_km2", "anomaly_value")
    return summary.select("table_name", "metric", "n_rows", "n_values", F.when(empty, "warn").otherwise("ok").alias("severity"))


def snapshot(df: DataFrame, name: str, key: list[str], metrics: list[str], n: int = 5, seed: int = 42) -> DataFrame:
    """n rows of a table in seeded hash order, one line per metric. A top-n: no row moves that is not among the n of its task."""
    ident = F.concat_ws("|", *[F.col(c).cast("string") for c in key])
    picked = df.select(ident.alias("row_key"), *metrics).orderBy(F.md5(F.concat_ws("|", F.lit(str(seed)), "row_key")), "row_key").limit(n)
    lines = F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value")) for m in metrics])
    return picked.select(F.lit(name).alias("table_name"), "row_key", F.explode(lines).alias("m")).select("table_name", "row_key", "m.*")


def check_regression(snap: DataFrame, df: DataFrame, key: list[str], metrics: list[str]) -> DataFrame:
    """Snapshot values against the current table, floating-point columns only. Rows that are gone and NULL
    values are not compared."""
    floats = {n for n, t in df.dtypes if t in ("double", "float")}
    metrics = [m for m in metrics if m in floats]
    ident = F.concat_ws("|", *[F.col(c).cast("string") for c in key])
    now = df.select(ident.alias("row_key"), *metrics)
    lines = F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("current")) for m in metrics])
    rows = snap.join(now, "row_key").select("table_name", "row_key", "metric", "value", F.explode(lines).alias("m")).where(
        F.col("metric") == F.col("m.metric")
    )
    diff = F.abs(F.col("m.current") - F.col("value"))
    return rows.where("value IS NOT NULL AND m.current IS NOT NULL").select(
        "table_name", "row_key", "metric", F.col("value").alias("expected"), F.col("m.current").alias("actual"),
        F.when(diff > fixed.SNAPSHOT_TOLERANCE, "fail").otherwise("ok").alias("severity"),
    )


def tile_stats(cells: DataFrame, grid: DataFrame, value: str, burned: bool = False) -> DataFrame:
    """Valid share, extremes and dimensions of each monthly tile. A cell without a row is nodata."""
    v = F.col(value)
    shape = grid.select("aoi", "resolution", (F.col("n_rows") * F.col("n_cols")).alias("n_total"))
    stats = cells.groupBy(*MONTH).agg(
        F.count(value).alias("n_valid"), F.min(v).cast("double").alias("lowest"),
        F.max(F.when(v > 0, v) if burned else v).cast("double").alias("highest"),
        (F.max("row_idx") + 1).alias("n_rows"), (F.max("col_idx") + 1).alias("n_cols"),
    )
    return stats.join(shape, ["aoi", "resolution"])


def check_tiles(stats: DataFrame, burned: bool = False) -> DataFrame:
    """One row per tile. The dimensions of an area's first month are what its other months must be
    within one cell of."""
    first = stats.groupBy(*SERIES).agg(F.min(F.struct(month_number(F.col("year"), F.col("month")).alias("n"), "n_rows", "n_cols")).alias("f"))
    joined = stats.join(first, SERIES)
    share = F.lit(100.0) * F.col("n_valid") / F.col("n_total")
    size_off = (F.abs(F.col("n_rows") - F.col("f.n_rows")) > 1) | (F.abs(F.col("n_cols") - F.col("f.n_cols")) > 1)
    if burned:
        coverage = F.lit("ok")
        off = F.coalesce(F.col("highest") > 366, F.lit(False))
    else:
        coverage = F.when(F.col("n_valid") == 0, "fail").when(share < 10, "warn").otherwise("ok")
        off = F.coalesce((F.col("lowest") < -1) | (F.col("highest") > 1), F.lit(False))
    return joined.select(
        *MONTH, share.alias("pct_valid"), coverage.alias("valid_pixels"),
        F.when(off, "fail").otherwise("ok").alias("value_range"), F.when(size_off, "fail").otherwise("ok").alias("dimensions"),
    )


def passed_tiles(checked: DataFrame) -> DataFrame:
    ok = (F.col("valid_pixels") != "fail") & (F.col("value_range") != "fail") & (F.col("dimensions") != "fail")
    return checked.where(ok).select(*MONTH)


def check_frp(features: DataFrame) -> DataFrame:
    """Enough features, and period and count within [1, n_years]."""
    def within(c: str) -> Column:
        return F.min((F.col(c) >= 1) & (F.col(c) <= F.col("n_years")))

    return features.groupBy("aoi").agg(
        F.count(F.lit(1)).alias("n_features"), (F.count(F.lit(1)) >= 100).alias("enough_features"),
        within("frp_years").alias("frp_in_range"), within("burn_count").alias("burn_count_in_range"),
    )


def check_stage_means(means: DataFrame, legacy: DataFrame, spine: DataFrame, low: float, high: float) -> DataFrame:
    """Per expected month: missing, no valid cell, mean out of range, or far from the legacy mean."""
    mean = F.col("mean_value")
    joined = spine.join(means.select(*MONTH, "mean_value", F.lit(True).alias("present")), MONTH, "left").join(
        legacy.select(*MONTH, F.col("mean_value").alias("legacy_mean")), MONTH, "left"
    )
    problem = (
        F.when(F.col("present").isNull(), "missing").when(mean.isNull(), "no valid cells")
        .when((mean < low) | (mean > high), "out of range")
        .when(F.abs(mean - F.col("legacy_mean")) > 0.15, "differs from legacy").otherwise("ok")
    )
    return joined.select(*MONTH, "mean_value", "legacy_mean", problem.alias("problem"))


def recompute_check(stored: DataFrame, fresh: DataFrame) -> DataFrame:
    """Stored monthly means against a fresh computation; a month without either side fails."""
    s = stored.select(*MONTH, F.col("mean_ndvi").alias("stored_mean"))
    f = fresh.select(*MONTH, F.col("mean_ndvi").alias("fresh_mean"))
    diff = F.abs(F.col("stored_mean") - F.col("fresh_mean"))
    return s.join(f, MONTH, "full").select(
        *MONTH, "stored_mean", "fresh_mean", diff.alias("abs_diff"),
        F.coalesce(diff < fixed.RECOMPUTE_TOLERANCE, F.lit(False)).alias("passes"),
    )


def trend_expectation(trend: DataFrame, expected: DataFrame) -> DataFrame:
    rows = expected.join(trend.select(*SERIES, "trend_direction"), SERIES, "left")
    return rows.select(*SERIES, "expected", F.col("trend_direction").alias("actual"),
                       F.coalesce(F.col("expected") == F.col("trend_direction"), F.lit(False)).alias("passes"))


def ba_range_expectation(ba: DataFrame, low: float, high: float) -> DataFrame:
    """Burned area of each month against a plausible range."""
    return ba.select("aoi", "year", "month", "burned_km2", F.col("burned_km2").between(low, high).alias("passes"))


def delta_expectation(delta: DataFrame, expected: DataFrame, tolerance: float = 0.20) -> DataFrame:
    """Gain and loss of expected year pairs, within a relative tolerance."""
    key = [*SERIES, "year_a", "year_b"]
    rows = expected.join(delta, key, "left")
    near = lambda c: F.coalesce(F.abs(F.col(c) - F.col(f"exp_{c}")) / F.col(f"exp_{c}") <= tolerance, F.lit(False))
    return rows.select(*key, "gain_km2", "loss_km2", near("gain_km2").alias("gain_ok"), near("loss_km2").alias("loss_ok"))


def phenology_medians(phenology: DataFrame) -> DataFrame:
    """Median months (cut to whole months) and median peak over the years of a series and class."""
    cut = lambda c: F.percentile(c, F.lit(0.5)).cast("int")
    return phenology.groupBy(*SERIES, "land_cover").agg(
        cut("green_up_month").alias("median_green_up"), cut("peak_month").alias("median_peak"),
        F.percentile("peak_ndvi", F.lit(0.5)).alias("median_peak_ndvi"),
    )


def phenology_expectation(medians: DataFrame, green_up: int = 12, peak: int = 2, low: float = 0.55, high: float = 0.75) -> DataFrame:
    no = F.lit(False)
    return medians.select(
        "*", F.coalesce(F.col("median_green_up") == green_up, no).alias("green_up_ok"),
        F.coalesce(F.col("median_peak") == peak, no).alias("peak_ok"),
        F.coalesce(F.col("median_peak_ndvi").between(low, high), no).alias("peak_ndvi_ok"),
    )


def resilience_invariants(resilience: DataFrame) -> DataFrame:
    """Rank 1 has the lowest score, the last rank the highest, and every label fits its deficit."""
    wrong = F.col("severity") != severity_label(F.col("max_deficit"))
    agg = resilience.groupBy(*SERIES, "anomaly_year").agg(
        F.min("resilience_score").alias("lowest"), F.max("resilience_score").alias("highest"),
        F.min_by("resilience_score", "resilience_rank").alias("first_score"),
        F.max_by("resilience_score", "resilience_rank").alias("last_score"),
        F.min("resilience_rank").alias("first_rank"), F.sum(wrong.cast("int")).alias("wrong_labels"),
        F.count_distinct("land_cover").alias("n_classes"),
    )
    return agg.select(
        *SERIES, "anomaly_year", "n_classes", "wrong_labels",
        ((F.col("first_rank") == 1) & (F.abs(F.col("first_score") - F.col("lowest")) < 1e-6)).alias("rank1_is_lowest"),
        (F.abs(F.col("last_score") - F.col("highest")) < 1e-6).alias("last_is_highest"),
    )
