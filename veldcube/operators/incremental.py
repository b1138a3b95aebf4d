"""What is there, what is missing, and what a new month makes stale."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veldcube.functions.columns import month_number
from veldcube.operators.monthly import SERIES

MONTH = [*SERIES, "year", "month"]


def month_spine(ranges: DataFrame, start: str = "start", end: str = "end") -> DataFrame:
    """One row per month from start to end inclusive (date columns); an empty range gives none."""
    keep = [c for c in ranges.columns if c not in (start, end)]
    first, last = F.trunc(start, "month"), F.trunc(end, "month")
    months = F.explode(F.sequence("_a", "_b", F.expr("interval 1 month")))
    spread = ranges.withColumn("_a", first).withColumn("_b", last).where("_a <= _b").select(*keep, months.alias("m"))
    return spread.select(*keep, F.year("m").alias("year"), F.month("m").alias("month"))


def latest_month(table: DataFrame) -> DataFrame:
    n = F.max(month_number(F.col("year"), F.col("month")))
    year = F.floor((F.col("n") - 1) / 12).cast("int")
    return table.groupBy(*SERIES).agg(n.alias("n")).select(*SERIES, year.alias("year"), (F.col("n") - year * 12).cast("int").alias("month"))


def missing_months(latest: DataFrame, sensor_end: DataFrame) -> DataFrame:
    """Months after the latest one up to the sensor's end; a series without data is not listed.

    `sensor_end` has (sensor, end_year, end_month).
    """
    after = F.add_months(F.make_date("year", "month", F.lit(1)), 1)
    until = F.make_date("end_year", "end_month", F.lit(1))
    ranges = latest.join(sensor_end, "sensor").select(*SERIES, after.alias("start"), until.alias("end"))
    return month_spine(ranges)


def pending_from_log(spine: DataFrame, log: DataFrame) -> DataFrame:
    return spine.join(log.where("status = 'success'").select(*MONTH).distinct(), MONTH, "left_anti")


def complete_years(table: DataFrame, combos: DataFrame) -> DataFrame:
    """Years whose December exists for every (aoi, sensor, resolution) of `combos`."""
    december = table.where("month = 12").select(*SERIES, "year").distinct().join(combos, SERIES, "left_semi")
    needed = combos.select(*SERIES).distinct().agg(F.count(F.lit(1)).alias("needed"))
    have = december.groupBy("year").agg(F.count(F.lit(1)).alias("have"))
    return have.join(needed, F.col("have") == F.col("needed")).select("year")


def new_complete_year(complete: DataFrame, log: DataFrame) -> DataFrame:
    """The newest complete year if no annual run has covered it yet; otherwise no row."""
    years = complete.select("year", F.lit(0).alias("covered")).unionByName(
        log.where("pass_b_ran").select(F.lit(None).cast("int").alias("year"), F.col("new_year_detected").alias("covered"))
    )
    return years.agg(F.max("year").alias("year"), F.max("covered").alias("covered")).where("year > covered").select("year")
