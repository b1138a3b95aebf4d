"""Array-valued raster tiles and their file names."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veldcube.functions.columns import null_invalid

TILE = 256


def parse_tile_name(files: DataFrame, path: str = "path") -> DataFrame:
    """Adds year, month and kind from YYYY-MM_<kind>_... names; rows with other names are dropped."""
    name = F.regexp_extract(path, r"([^/]+)$", 1)
    pattern = r"^(\d{4})-(\d{2})_([A-Za-z]*)"
    return (
        files.where(name.rlike(r"^\d{4}-\d{2}_"))
        .withColumn("year", F.regexp_extract(name, pattern, 1).cast("int"))
        .withColumn("month", F.regexp_extract(name, pattern, 2).cast("int"))
        .withColumn("kind", F.regexp_extract(name, pattern, 3))
    )


def scan_tiles(spark: SparkSession, root: str) -> DataFrame:
    """Parquet tiles below a folder with year, month and kind from each file's name."""
    tiles = spark.read.option("recursiveFileLookup", "true").parquet(root)
    return parse_tile_name(tiles.withColumn("path", F.col("_metadata.file_path"))).drop("path")


def explode_tiles(tiles: DataFrame, keys: list[str]) -> DataFrame:
    """Tile rows (keys, row0, col0, nodata, values[][]) to cells; nodata, NaN and huge values are NULL."""
    rows = tiles.select(*keys, "row0", "col0", "nodata", F.posexplode("values").alias("i", "line"))
    cells = rows.select(*keys, (F.col("row0") + F.col("i")).alias("row_idx"), "col0", "nodata", F.posexplode("line").alias("j", "v"))
    return cells.select(
        *keys, "row_idx", (F.col("col0") + F.col("j")).alias("col_idx"), null_invalid(F.col("v"), F.col("nodata")).alias("value")
    )


def implode_tiles(cells: DataFrame, keys: list[str], grid: DataFrame, nodata: float = -9999.0) -> DataFrame:
    """Cells to tiles of at most TILE x TILE; cells without a value hold nodata."""
    size = F.lit(TILE)
    lines = cells.groupBy(*keys, "row_idx", F.floor(F.col("col_idx") / size).alias("bc")).agg(
        F.map_from_entries(F.collect_list(F.struct("col_idx", F.coalesce("value", F.lit(nodata))))).alias("m")
    )
    placed = lines.join(grid.select("aoi", "resolution", "n_rows", "n_cols"), ["aoi", "resolution"])
    width = "sequence(CAST(bc AS INT) * 256, least(CAST(bc AS INT) * 256 + 255, n_cols - 1))"
    line = F.expr(f"transform({width}, j -> coalesce(try_element_at(m, j), {nodata}D))")
    tiles = placed.select(*keys, F.floor(F.col("row_idx") / size).alias("br"), "bc", "n_rows", "row_idx", line.alias("line")).groupBy(
        *keys, "br", "bc", "n_rows"
    ).agg(F.map_from_entries(F.collect_list(F.struct("row_idx", "line"))).alias("m"), F.max(F.size("line")).alias("w"))
    height = "sequence(CAST(br AS INT) * 256, least(CAST(br AS INT) * 256 + 255, n_rows - 1))"
    values = F.expr(f"transform({height}, i -> coalesce(try_element_at(m, i), array_repeat({nodata}D, w)))")
    return tiles.select(
        *keys, (F.col("br") * size).cast("int").alias("row0"), (F.col("bc") * size).cast("int").alias("col0"),
        F.lit(nodata).alias("nodata"), values.alias("values"),
    )
