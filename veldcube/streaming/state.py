"""Mergeable state behind the stored products.

A state table holds sums per key. Cells that arrive are added to it and the cells that they replace
are subtracted, so a product follows a new month without another look at the cells of other months. Sums
are decimals and counts are integers: what was added comes off again exactly, however often a month is
delivered. Minima and maxima are taken where few rows are left, over the months of a series.

A load is applied to a partition once: each partition names the last load that it has (`applied`), and the
cells themselves are written last. A load that is run again after a failure finds the cells as they
were, leaves alone the partitions that have it already, and brings the others up to date.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from veldcube.functions.columns import cell_area_nominal, row_area
from veldcube.functions.session import broadcast_if_small, cut_lineage
from veldcube.operators.monthly import SERIES
from veldcube.sources import products

YEAR = [*SERIES, "year"]
MONTH = [*SERIES, "year", "month"]
CELL = [*SERIES, "row_idx", "col_idx"]
EXACT = "decimal(38,18)"
SUMS = {"rows": "long", "n": "long", "total": EXACT}


class Table:
    """A state table: its key columns, the sums that it holds and the partitions that are replaced whole."""

    def __init__(self, name: str, keys: dict[str, str], sums: list[str], parts: list[str]):
        self.name, self.parts, self.sums = name, parts, sums
        kinds = {"aoi": "string", "sensor": "string", "resolution": "int", "year": "int", "month": "int"} | keys
        self.keys = list(dict.fromkeys([*parts, *keys]))
        inner = [c for c in self.keys if c not in parts]
        self.schema = ", ".join(f"{c} {t}" for c, t in [*((k, kinds[k]) for k in inner), *((s, SUMS[s]) for s in sums), ("applied", "string"), *((p, kinds[p]) for p in parts)])

    def scan(self, spark: SparkSession, root: str) -> DataFrame:
        return products.scan_product(spark, root, self.name, self.schema)

    def updated(self, spark: SparkSession, root: str, change: DataFrame, load: str) -> tuple[DataFrame, DataFrame]:
        """The partitions that `change` (key columns and sums) touches, before and after it."""
        change = cut_lineage(change.groupBy(*self.keys).agg(*[F.sum(s).cast(SUMS[s]).alias(s) for s in self.sums]))
        parts = change.select(*self.parts).distinct()
        before = cut_lineage(self.scan(spark, root).join(broadcast_if_small(parts), self.parts, "left_semi"))
        have = before.where(F.col("applied") == load).select(*self.parts).distinct()
        columns = [*self.keys, *self.sums]
        after = before.select(*columns).unionByName(change.join(broadcast_if_small(have), self.parts, "left_anti").select(*columns))
        after = after.groupBy(*self.keys).agg(*[F.sum(s).cast(SUMS[s]).alias(s) for s in self.sums]).where("rows > 0")
        return before, cut_lineage(after.withColumn("applied", F.lit(load)))

    def write(self, rows: DataFrame, root: str) -> None:
        products.write_product(rows, root, self.name, [p for p in self.parts if p not in SERIES])


MONTH_SUM = Table("state_month", {"month": "int"}, ["rows", "n", "total"], YEAR)
CLASS_MONTH = Table("state_class_month", {"month": "int", "land_cover": "string"}, ["rows", "n", "total"], YEAR)
CELL_YEAR = Table("state_cell_year", {"row_idx": "int", "col_idx": "int"}, ["rows", "n", "total"], YEAR)
BURN_ROW = Table("state_burn_row", {"month": "int", "row_idx": "int"}, ["rows", "n"], YEAR)
BURN_DAY = Table("state_burn_day", {"month": "int", "burn_date": "int"}, ["rows"], YEAR)
BURN_YEAR = Table("state_burn_year", {"row_idx": "int", "col_idx": "int"}, ["rows", "n"], YEAR)
BURN_CELL = Table("state_burn_cell", {"row_idx": "int", "col_idx": "int"}, ["rows", "n"], SERIES)


def signed(fresh: DataFrame, replaced: DataFrame) -> DataFrame:
    """Cells that come with 1 in `rows`, the stored ones that they replace with -1."""
    return fresh.withColumn("rows", F.lit(1)).unionByName(replaced.withColumn("rows", F.lit(-1)))


def counted(changes: DataFrame, value: Column) -> DataFrame:
    """`changes` with n and total: the value's part of a count and of a sum, none where it is NULL or NaN."""
    exact = F.when(~F.isnan(value), value).cast(EXACT)
    n = F.when(exact.isNull(), 0).otherwise(F.col("rows"))
    return changes.withColumn("n", n).withColumn("total", F.coalesce(F.when(F.col("rows") > 0, exact).otherwise(-exact), F.lit(0).cast(EXACT)))


def mean() -> Column:
    return F.when(F.col("n") > 0, F.col("total").cast("double") / F.col("n"))


# --- vegetation ----------------------------------------------------------------------------------


def vegetation_updates(spark: SparkSession, root: str, changes: DataFrame, class_cells: DataFrame | None, load: str) -> list[tuple[Table, DataFrame]]:
    """Sums by month, by cell and year, and by class and month where cells have classes, after the signed
    cells `changes`. Cells of no class count under a NULL class, so that a month with only such cells is not lost."""
    rows = counted(changes, F.col("value"))
    made = [(MONTH_SUM, rows.select(*MONTH, "rows", "n", "total")), (CELL_YEAR, rows.select(*YEAR, "row_idx", "col_idx", "rows", "n", "total"))]
    if class_cells is not None:
        on = [c for c in ("aoi", "row_idx", "col_idx") if c in class_cells.columns]
        made.append((CLASS_MONTH, rows.join(class_cells, on, "left").select(*MONTH, "land_cover", "rows", "n", "total")))
    return [(table, table.updated(spark, root, change, load)[1]) for table, change in made]


def month_means(state: DataFrame) -> DataFrame:
    """Mean and number of valid cells; a month with no valid cell keeps its row (NULL, 0)."""
    return state.select("year", "month", mean().alias("mean_ndvi"), F.col("n").cast("int").alias("n_valid_px"), *SERIES)


def class_months(state: DataFrame, classes: DataFrame) -> DataFrame:
    """The by-class product of the months in `state`: every class of the area in every month."""
    entry = F.when(F.col("land_cover").isNotNull(), F.struct("land_cover", F.struct(mean().alias("mean"), "n").alias("v")))
    months = state.groupBy(*MONTH).agg(F.map_from_entries(F.collect_list(entry)).alias("by_class"))
    found = F.try_element_at("by_class", F.col("land_cover"))
    return months.join(classes, "aoi").select(
        "year", "month", "land_cover", found["mean"].alias("mean_ndvi"), F.coalesce(found["n"], F.lit(0)).cast("int").alias("n_valid_px"), *SERIES)


def cell_year_means(state: DataFrame, annual: DataFrame) -> DataFrame:
    """Mean of the available months of each cell in complete years."""
    complete = annual.where("is_complete").select(*YEAR)
    return state.join(complete, YEAR, "left_semi").select(*CELL, "year", mean().alias("annual_mean"))


# --- burned area ---------------------------------------------------------------------------------


def burn_updates(spark: SparkSession, root: str, changes: DataFrame, load: str) -> list[tuple[Table, DataFrame]]:
    """Burned cells by grid row and month, by day, by cell and year, and years burned by cell.

    What a cell's years burned change by is told from its years before and after, so that table comes first:
    once the years are written the difference is gone.
    """
    hot = F.coalesce(F.col("burn_date") > 0, F.lit(False))
    rows = changes.withColumn("n", F.when(hot, F.col("rows")).otherwise(0))
    row = BURN_ROW.updated(spark, root, rows.select(*MONTH, "row_idx", "rows", "n"), load)[1]
    # Cells that did not burn keep a NULL day, so that a month whose last burn is taken back is written too.
    day = BURN_DAY.updated(spark, root, rows.select(*MONTH, F.when(hot, F.col("burn_date")).alias("burn_date"), "rows"), load)[1]
    before, after = BURN_YEAR.updated(spark, root, rows.select(*YEAR, "row_idx", "col_idx", "rows", "n"), load)
    years = lambda df, sign: df.select(*CELL, F.lit(sign).alias("rows"), F.when(F.col("n") > 0, sign).otherwise(0).alias("n"))
    shift = years(after, 1).unionByName(years(before, -1))
    return [(BURN_CELL, BURN_CELL.updated(spark, root, shift, load)[1]), (BURN_YEAR, after), (BURN_ROW, row), (BURN_DAY, day)]


def burned_months(state: DataFrame, grid: DataFrame) -> DataFrame:
    """Burned km2 of the months in `state` (BURN_ROW); a month without burned cells has zero."""
    area = row_area(F.col("row_idx"), F.col("north"), F.col("dx"), F.col("dy"))
    placed = state.join(grid.select("aoi", "resolution", "north", "dx", "dy"), ["aoi", "resolution"])
    return placed.groupBy(*MONTH).agg(F.sum(F.col("n") * area).alias("burned_km2")).select("year", "month", "burned_km2", *SERIES)


def burned_days(state: DataFrame) -> DataFrame:
    """Nominal burned area per burn date and source month; day 366 of a short year rolls over."""
    return state.where("burn_date IS NOT NULL").select(
        "year", "month", F.date_add(F.make_date("year", F.lit(1), F.lit(1)), F.col("burn_date") - 1).alias("date"),
        (F.col("rows") * cell_area_nominal(F.col("resolution"))).alias("burned_km2"), *SERIES)


def burn_counts(cells: DataFrame, months: DataFrame) -> DataFrame:
    """Years burned of each cell (BURN_CELL) and the number of years that its area has images for."""
    years = months.groupBy(*SERIES).agg(F.count_distinct("year").cast("int").alias("n_years"))
    return cells.join(years, SERIES).select("aoi", "resolution", "row_idx", "col_idx", F.col("n").cast("int").alias("burn_count"), "n_years", "sensor")
