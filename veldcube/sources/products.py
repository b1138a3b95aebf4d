"""Product tables on disk: Parquet partitioned by series, written idempotently."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

PARTITIONS = ["aoi", "sensor", "resolution"]


def write_product(df: DataFrame, root: str, table: str, extra: list[str] | None = None) -> bool:
    """Replace the partitions present in `df`; others stay. An empty result writes nothing.

    The rebalance hint keeps files few per partition and lets adaptive execution split a large one.
    """
    if df.isEmpty():
        return False
    parts = [c for c in [*PARTITIONS, *(extra or [])] if c in df.columns]
    df.hint("rebalance", *parts).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*parts).parquet(f"{root}/{table}")
    return True


def scan_product(
    spark: SparkSession, root: str, table: str, schema: str, aoi: str | None = None, sensor: str | None = None,
    resolution: int | None = None, columns: list[str] | None = None,
) -> DataFrame:
    """Partition-pruned read; a table that was never written is an empty frame of `schema`."""
    try:
        df = spark.read.schema(schema).parquet(f"{root}/{table}")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        df = spark.createDataFrame([], schema)
    for name, value in (("aoi", aoi), ("sensor", sensor), ("resolution", resolution)):
        if value is not None and name in df.columns:
            df = df.where(F.col(name) == value)
    return df.select(*columns) if columns else df


RUN_LOG = (
    "run_timestamp timestamp_ntz, new_months_fetched int, pass_a_ran boolean, pass_b_ran boolean, "
    "new_year_detected int, deploy_ran boolean, status string, error_message string"
)


def append_run_log(rows: DataFrame, path: str) -> None:
    """Add rows to a log folder: every append is a new CSV file with a header."""
    rows.write.mode("append").option("header", "true").csv(path)


def scan_run_log(spark: SparkSession, path: str, schema: str = RUN_LOG) -> DataFrame:
    return spark.read.option("header", "true").schema(schema).csv(path)
