"""Scene observations derived from the order tables (one row per scene and cell)."""

from __future__ import annotations

from functools import lru_cache, reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# Rows of the strip grid before it continues in further columns; keeps latitudes on the globe.
STRIP_ROWS = 20_000
# Columns of a strip, and those it takes with the empty one that keeps it apart from the next strip.
STRIP_COLS, STRIP_STEP = 8, 9
# Key and area name of this many rows are some tens of megabytes.
LOOKUP_ROWS = 1_000_000


@lru_cache(maxsize=None)
def _schema(spark: SparkSession, path: str) -> StructType:
    return spark.read.parquet(path).schema


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the folder; its schema is inferred once per session, its files are listed every time."""
    path = f"{sf_dir}/{name}.parquet"
    return spark.read.schema(_schema(spark, path)).parquet(path)


def row_counts(spark: SparkSession, sf_dir: str, *names: str) -> dict[str, int]:
    """Rows of several tables in one job. No column is read: the counts are in the Parquet footers."""
    tagged = [read_table(spark, sf_dir, n).select(F.lit(n).alias("name")) for n in names]
    counts = reduce(DataFrame.unionAll, tagged).groupBy("name").count()
    return dict.fromkeys(names, 0) | {r["name"]: r["count"] for r in counts.collect()}


def order_aois(spark: SparkSession, sf_dir: str, rows: dict[str, int]) -> DataFrame:
    """Order key to study area, at most one row per order.

    Sides with few rows are broadcast, judged by `rows`. Without that check the planner takes a
    derived side for huge (join size estimates multiply) and broadcasts the observations instead.
    """
    def small(df: DataFrame, source: str) -> DataFrame:
        return F.broadcast(df) if rows[source] <= LOOKUP_ROWS else df

    nation = read_table(spark, sf_dir, "nation")
    region = read_table(spark, sf_dir, "region")
    areas = nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        "n_nationkey", F.col("r_name").alias("aoi")
    )
    customer = read_table(spark, sf_dir, "customer")
    customers = customer.join(small(areas, "nation"), customer.c_nationkey == areas.n_nationkey).select("c_custkey", "aoi")
    orders = read_table(spark, sf_dir, "orders")
    placed = orders.join(small(customers, "customer"), orders.o_custkey == customers.c_custkey).select("o_orderkey", "aoi")
    return small(placed, "orders")


def strip_cell(key: Column, part: Column, step: int = STRIP_STEP) -> tuple[Column, Column]:
    """Row and column of an order line on the strip grid."""
    strip = F.floor(key / 64)
    return strip % STRIP_ROWS, part % STRIP_COLS + F.lit(step) * F.floor(strip / STRIP_ROWS)


def strip_grid(grid: DataFrame, keys: DataFrame, key: str, step: int = STRIP_STEP) -> DataFrame:
    """The strip grid with as many columns as the largest `key` needs; they get narrower rather than
    leave the six degrees of a zone."""
    last = keys.agg(F.coalesce(F.max(key), F.lit(0)).alias("last"))
    wide = F.floor(F.floor(F.col("last") / 64) / STRIP_ROWS).cast("int") * step + STRIP_COLS
    return grid.crossJoin(F.broadcast(last)).withColumn("n_cols", wide).withColumn(
        "dx", F.least(F.col("dx"), F.lit(6.0) / F.col("n_cols"))
    ).drop("last")


def scene_obs(
    spark: SparkSession,
    sf_dir: str,
    rows: dict[str, int],
    grid: str = "block",
    sensor: str = "sentinel2",
    resolution: int = 500,
) -> DataFrame:
    """The adapter view. `block` is an 8 x 8 grid per area; `strip` has rows that grow with the data, its strips side by side
    without an empty column, as in the SQL."""
    line = read_table(spark, sf_dir, "lineitem")
    key, part = F.col("l_orderkey"), F.col("l_partkey")
    if grid == "block":
        row, col = key % 8, part % 8
    else:
        row, col = strip_cell(key, part, STRIP_COLS)
    day = F.dayofyear("l_shipdate")
    supp, number = F.col("l_suppkey"), F.col("l_linenumber")
    burned = (F.col("l_returnflag") == "R") & (F.col("l_discount") >= 0.08)
    aois = order_aois(spark, sf_dir, rows)
    return line.join(aois, line.l_orderkey == aois.o_orderkey).select(
        (key * 10 + number).alias("obs_id"),
        "aoi",
        F.lit(sensor).alias("sensor"),
        F.lit(resolution).alias("resolution"),
        F.col("l_shipdate").alias("acq_ts"),
        F.year("l_shipdate").alias("year"),
        F.month("l_shipdate").alias("month"),
        row.cast("int").alias("row_idx"),
        col.cast("int").alias("col_idx"),
        (F.col("l_extendedprice") / 1000).alias("b8"),
        F.col("l_quantity").alias("b4"),
        ((supp * 3 + number) % 12).cast("int").alias("scl"),
        ((supp + number * 3) % 4).cast("int").alias("summary_qa"),
        ((supp * 97 + number * 1009) % 10001).cast("int").alias("ndvi_raw"),
        (F.col("l_discount") * 1000).alias("cloud_pct"),
        F.when(burned, day).otherwise(0).cast("int").alias("burn_date"),
        (day - number % 5 + 1).cast("int").alias("first_day"),
        (day + 5).cast("int").alias("last_day"),
        (supp % 64).cast("int").alias("burn_qa"),
    )


def run_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run-log rows derived from orders: one run per order."""
    o = read_table(spark, sf_dir, "orders")
    ok = F.col("o_orderstatus") == "F"
    return o.select(
        F.when(F.col("o_custkey") % 11 != 0, F.col("o_orderdate")).alias("run_timestamp"),
        (F.col("o_custkey") % 3).cast("int").alias("new_months_fetched"),
        ok.alias("pass_a_ran"),
        (ok & F.col("o_orderpriority").startswith("1")).alias("pass_b_ran"),
        (F.year("o_orderdate") - 2).cast("int").alias("new_year_detected"),
        F.lit(False).alias("deploy_ran"),
        F.when(ok, "success").otherwise("error").alias("status"),
        F.when(~ok, "fetch failed").alias("error_message"),
    )


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Resolution requests derived from orders: sensor, resolution text, start and end month."""
    o = read_table(spark, sf_dir, "orders")
    kind = F.col("o_orderkey") % 4
    begin = F.col("o_orderdate").cast("date")
    return o.select(
        "o_orderkey",
        F.when(kind == 0, "sentinel2").when(kind == 1, "modis").when(kind == 2, "burned_area").otherwise("other").alias("sensor"),
        F.when(F.col("o_custkey") % 5 == 0, "250").when(F.col("o_custkey") % 5 == 1, "0").otherwise("auto").alias("resolution"),
        F.when(F.col("o_custkey") % 7 != 0, F.date_format(begin, "yyyy-MM")).alias("start"),
        F.date_format(F.add_months(begin, (F.col("o_custkey") % 120).cast("int")), "yyyy-MM").alias("end"),
    )
