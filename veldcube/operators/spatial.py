"""Polygons against grids.

A polygon layer is turned into column spans per grid row (scanline crossings), so that masking is an
equality join on the grid row with a column range, not a test of every cell against every edge.
Spans depend on the grid only and are reused by every month.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from veldcube.functions import fixed
from veldcube.functions.columns import edge_area_term
from veldcube.functions.session import broadcast_if_small, spread

#: Side in cells of the square blocks that grids are worked on in.
BLOCK = 256
SPAN = ["aoi", "resolution", "layer", "polygon_id", "row_idx"]
RING = ["aoi", "layer", "polygon_id", "ring_id"]


def cell_centres(cells: DataFrame, grid: DataFrame) -> DataFrame:
    """Centre longitude and latitude of each cell, to six decimals."""
    placed = cells.join(grid.select("aoi", "resolution", "west", "north", "dx", "dy"), ["aoi", "resolution"])
    lon = F.col("west") + (F.col("col_idx") + 0.5) * F.col("dx")
    lat = F.col("north") + (F.col("row_idx") + 0.5) * F.col("dy")
    return placed.withColumn("lon", F.bround(lon, 6)).withColumn("lat", F.bround(lat, 6)).drop("west", "north", "dx", "dy")


def ring_edges(vertices: DataFrame) -> DataFrame:
    """Consecutive vertices of closed rings. A join on the next position, so a long ring stays split."""
    here = vertices.select(*RING, "seq", F.col("lon").alias("lon1"), F.col("lat").alias("lat1"))
    there = vertices.select(*RING, (F.col("seq") - 1).alias("seq"), F.col("lon").alias("lon2"), F.col("lat").alias("lat2"))
    return here.join(there, [*RING, "seq"])


def _per_row(edges: DataFrame, grid: DataFrame, centre: bool) -> DataFrame:
    """One row per edge and grid row that its latitudes may reach."""
    placed = edges.join(grid, "aoi")
    shift = 0.5 if centre else 0.0
    top = (F.greatest("lat1", "lat2") - F.col("north")) / F.col("dy") - shift
    bottom = (F.least("lat1", "lat2") - F.col("north")) / F.col("dy") - shift
    first = F.greatest(F.floor(top), F.lit(0))
    last = F.least(F.ceil(bottom), F.col("n_rows") - 1)
    ranged = placed.withColumn("first", first.cast("int")).withColumn("last", last.cast("int"))
    return ranged.where("first <= last").withColumn("row_idx", F.explode(F.sequence("first", "last")))


def polygon_spans(edges: DataFrame, grid: DataFrame) -> DataFrame:
    """Spans of columns whose cell centre is inside, per polygon and grid row (even-odd over all rings)."""
    rows = _per_row(edges, grid, centre=True).withColumn("y", F.col("north") + (F.col("row_idx") + 0.5) * F.col("dy"))
    crossing = rows.where((F.col("lat1") <= F.col("y")) != (F.col("lat2") <= F.col("y")))
    x = F.col("lon1") + (F.col("y") - F.col("lat1")) / (F.col("lat2") - F.col("lat1")) * (F.col("lon2") - F.col("lon1"))
    column = F.ceil((x - F.col("west")) / F.col("dx") - 0.5).cast("int")
    across = Window.partitionBy(*SPAN).orderBy("x")
    pairs = (
        crossing.select(*SPAN, "n_cols", x.alias("x"), column.alias("c"))
        .withColumn("next", F.lead("c").over(across))
        .withColumn("nth", F.row_number().over(across))
        .where("nth % 2 = 1")
    )
    return pairs.select(
        *SPAN, F.greatest("c", F.lit(0)).alias("col_from"), F.least(F.col("next") - 1, F.col("n_cols") - 1).alias("col_to")
    ).where("col_from <= col_to")


def touched_spans(edges: DataFrame, grid: DataFrame) -> DataFrame:
    """Spans of columns that an edge passes through, per grid row."""
    rows = _per_row(edges, grid, centre=False)
    y_top = F.col("north") + F.col("row_idx") * F.col("dy")
    y_bottom = y_top + F.col("dy")
    low = F.greatest(F.least("lat1", "lat2"), y_bottom)
    high = F.least(F.greatest("lat1", "lat2"), y_top)
    rise = F.nullif(F.col("lat2") - F.col("lat1"), F.lit(0.0))

    def x_at(lat: Column, flat: str) -> Column:
        return F.coalesce(F.col("lon1") + (lat - F.col("lat1")) / rise * (F.col("lon2") - F.col("lon1")), F.col(flat))

    a, b = x_at(low, "lon1"), x_at(high, "lon2")
    left = F.floor((F.least(a, b) - F.col("west")) / F.col("dx")).cast("int")
    right = F.floor((F.greatest(a, b) - F.col("west")) / F.col("dx")).cast("int")
    return rows.where(low <= high).select(
        *SPAN, F.greatest(left, F.lit(0)).alias("col_from"), F.least(right, F.col("n_cols") - 1).alias("col_to")
    ).where("col_from <= col_to")


def merge_spans(spans: DataFrame) -> DataFrame:
    """Disjoint spans per layer and row: the union of overlapping polygons, one match per cell."""
    key = ["aoi", "resolution", "layer", "row_idx"]
    along = Window.partitionBy(*key).orderBy("col_from", "col_to")
    reach = F.max("col_to").over(along.rowsBetween(Window.unboundedPreceding, -1))
    starts = spans.withColumn("new", F.coalesce((F.col("col_from") > reach + 1).cast("int"), F.lit(1)))
    return starts.withColumn("island", F.sum("new").over(along)).groupBy(*key, "island").agg(
        F.min("col_from").alias("col_from"), F.max("col_to").alias("col_to")
    ).drop("island")


def _within(cells: str = "c", spans: str = "s") -> Column:
    same = reduce(lambda a, b: a & b, [F.col(f"{cells}.{k}") == F.col(f"{spans}.{k}") for k in ("aoi", "resolution", "row_idx")])
    return same & F.col(f"{cells}.col_idx").between(F.col(f"{spans}.col_from"), F.col(f"{spans}.col_to"))


def mask_polygon(cells: DataFrame, spans: DataFrame, keep_inside: bool = True) -> DataFrame:
    """Cells inside (or outside) any polygon of the spans; overlapping polygons keep a cell once."""
    how = "left_semi" if keep_inside else "left_anti"
    return cells.alias("c").join(broadcast_if_small(spans).alias("s"), _within(), how)


def mask_polygon_all_touched(cells: DataFrame, edges: DataFrame, grid: DataFrame) -> DataFrame:
    return mask_polygon(cells, polygon_spans(edges, grid).unionByName(touched_spans(edges, grid)))


def mask_two_level(cells: DataFrame, aoi_spans: DataFrame, class_spans: DataFrame) -> DataFrame:
    """Cells inside the area, once per land-cover class (layer) they are inside of."""
    inside = mask_polygon(cells, aoi_spans)
    classes = broadcast_if_small(merge_spans(class_spans))
    return inside.alias("c").join(classes.alias("s"), _within()).select(
        "c.*", F.col("s.layer").alias("land_cover")
    )


def inside_flag(cells: DataFrame, spans: DataFrame) -> DataFrame:
    """Every cell with a boolean `inside`."""
    one_layer = merge_spans(spans.withColumn("layer", F.lit("any")))
    return cells.alias("c").join(broadcast_if_small(one_layer).alias("s"), _within(), "left").select(
        "c.*", F.col("s.col_from").isNotNull().alias("inside")
    )


def outside_fill(cells: DataFrame, spans: DataFrame, value: str, integer: bool) -> DataFrame:
    """Keep every cell; outside the polygons a float becomes NULL and an integer 0."""
    flagged = inside_flag(cells, spans)
    fill = F.when(F.col("inside"), F.col(value))
    return flagged.withColumn(value, fill.otherwise(0) if integer else fill).drop("inside")


def ring_area_geodesic(vertices: DataFrame) -> DataFrame:
    """km2 per polygon: outer ring less its holes (ring 0 is the outer one)."""
    term = edge_area_term(F.col("lon1"), F.col("lat1"), F.col("lon2"), F.col("lat2"))
    rings = ring_edges(vertices).groupBy(*RING).agg(F.abs(F.sum(term)).alias("km2"))
    signed = F.when(F.col("ring_id") == 0, F.col("km2")).otherwise(-F.col("km2"))
    return rings.groupBy("aoi", "layer", "polygon_id").agg(F.abs(F.sum(signed)).alias("area_km2"))


def align_nearest(source: DataFrame, source_grid: DataFrame, target_grid: DataFrame) -> DataFrame:
    """Nearest-neighbour values of `source` on another grid; target cells off the source are NULL.

    `source` has aoi, resolution, row_idx, col_idx, value.
    """
    t = target_grid
    # Blocks of the target grid are dealt out before their cells are made, so no task makes a whole grid.
    steps = lambda n: F.explode(F.sequence(F.lit(0), F.floor((F.col(n) - 1) / BLOCK).cast("int")))
    within = lambda b, n: F.explode(F.sequence(F.col(b) * BLOCK, F.least(F.col(b) * BLOCK + (BLOCK - 1), F.col(n) - 1)))
    blocks = spread(t.withColumn("br", steps("n_rows")).withColumn("bc", steps("n_cols")), "aoi", "resolution", "br", "bc")
    target = blocks.withColumn("row_idx", within("br", "n_rows")).withColumn("col_idx", within("bc", "n_cols")).select(
        "aoi", "resolution", "row_idx", "col_idx",
        (F.col("west") + (F.col("col_idx") + 0.5) * F.col("dx")).alias("x"),
        (F.col("north") + (F.col("row_idx") + 0.5) * F.col("dy")).alias("y"),
    )
    s = source_grid.select("aoi", F.col("west").alias("w"), F.col("north").alias("n"), F.col("dx").alias("sx"), F.col("dy").alias("sy"))
    mapped = target.join(s, "aoi").select(
        "aoi", "resolution", "row_idx", "col_idx",
        F.floor((F.col("y") - F.col("n")) / F.col("sy")).cast("int").alias("src_row"),
        F.floor((F.col("x") - F.col("w")) / F.col("sx")).cast("int").alias("src_col"),
    )
    values = source.select(
        "aoi", "resolution", F.col("row_idx").alias("src_row"), F.col("col_idx").alias("src_col"), "value"
    )
    return mapped.join(values, ["aoi", "resolution", "src_row", "src_col"], "left")


def same_grid(a: DataFrame, b: DataFrame) -> Column:
    parts = [F.abs(a[k] - b[k]) <= fixed.GRID_TOLERANCE for k in ("west", "north", "dx", "dy")]
    return reduce(lambda x, y: x & y, parts) & (a["n_rows"] == b["n_rows"]) & (a["n_cols"] == b["n_cols"])


def compare_grids(a: DataFrame, b: DataFrame) -> DataFrame:
    """Which parts of two grids differ, per area: shape, transform, bounding box."""
    x, y = a.alias("a"), b.alias("b")

    def differs(*pairs: tuple[Column, Column]) -> Column:
        return reduce(lambda p, q: p | q, [F.abs(l - r) > fixed.GRID_TOLERANCE for l, r in pairs])

    def col(side: str, name: str) -> Column:
        return F.col(f"{side}.{name}")

    def edge(side: str, origin: str, step: str, count: str) -> Column:
        return col(side, origin) + col(side, step) * col(side, count)

    shape = (col("a", "n_rows") != col("b", "n_rows")) | (col("a", "n_cols") != col("b", "n_cols"))
    transform = differs(*[(col("a", k), col("b", k)) for k in ("west", "north", "dx", "dy")])
    bbox = differs(
        (col("a", "west"), col("b", "west")), (col("a", "north"), col("b", "north")),
        (edge("a", "west", "dx", "n_cols"), edge("b", "west", "dx", "n_cols")),
        (edge("a", "north", "dy", "n_rows"), edge("b", "north", "dy", "n_rows")),
    )
    labels = F.array_compact(F.array(F.when(shape, "shape"), F.when(transform, "transform"), F.when(bbox, "bbox")))
    return x.join(y, F.col("a.aoi") == F.col("b.aoi")).select(
        "a.aoi", (F.size(labels) == 0).alias("match"), F.array_join(labels, ", ").alias("differs_in")
    )


def erode(cells: DataFrame, keys: list[str], iterations: int = 2, block: int = BLOCK) -> DataFrame:
    """Flag cells that survive `iterations` erosions with four neighbours; the outside counts as absent.

    Cells meet in square blocks; those within `iterations` of a border go to the block behind it as well, which
    is about one shuffled row per cell. A block of any density is one small array. Repeated cells count once.
    """
    reach = lambda c: F.explode(F.sequence(F.floor((F.col(c) - iterations) / block), F.floor((F.col(c) + iterations) / block)))
    boxed = cells.select(*keys, "row_idx", "col_idx").withColumn("br", reach("row_idx")).withColumn("bc", reach("col_idx"))
    side = block + 2 * iterations

    def survive(rows: pa.Table) -> pa.Table:
        br, bc = rows.column("br")[0].as_py(), rows.column("bc")[0].as_py()
        r = rows.column("row_idx").to_numpy() - br * block + iterations
        c = rows.column("col_idx").to_numpy() - bc * block + iterations
        there = np.zeros((side, side), bool)
        there[r, c] = True
        left = there
        for _ in range(iterations):
            wide = np.pad(left, 1)
            left = left & wide[:-2, 1:-1] & wide[2:, 1:-1] & wide[1:-1, :-2] & wide[1:-1, 2:]
        own = slice(iterations, iterations + block)
        at = np.nonzero(there[own, own])
        same = rows.slice(0, 1).select(keys).take(pa.array(np.zeros(len(at[0]), np.int64)))
        inside = left[own, own][at]
        for name, values in (("row_idx", at[0] + br * block), ("col_idx", at[1] + bc * block)):
            same = same.append_column(name, pa.array(values, rows.schema.field(name).type))
        return same.append_column("interior", pa.array(inside))

    kinds = dict(cells.dtypes)
    schema = ", ".join([*(f"{c} {kinds[c]}" for c in (*keys, "row_idx", "col_idx")), "interior boolean"])
    return spread(boxed, *keys, "br", "bc").groupBy(*keys, "br", "bc").applyInArrow(survive, schema)
