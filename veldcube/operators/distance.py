"""Exact Euclidean distance transform, separable: along columns in Spark, along rows by lower envelopes."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from veldcube.functions.session import broadcast_if_small, cut_lineage

#: Positions (rows times columns with targets) that one task works on at a time, and rows at most.
CHUNK_POSITIONS, CHUNK_ROWS = 1 << 21, 4096
#: Further than any row of a grid.
NOWHERE = 1 << 40


def column_distances(first: int, n_rows: int, above: np.ndarray, below: np.ndarray, rows: np.ndarray, cols: np.ndarray) -> np.ndarray:
    """Distance along its column to the nearest target, for `n_rows` grid rows from `first` on and all columns.

    `above` and `below` are each column's last target row before and first one after these rows; `rows` and
    `cols` are the targets among them, `cols` as places in the columns' order.
    """
    last = np.full((n_rows, len(above)), -NOWHERE, np.int64)
    last[0] = above
    last[rows - first, cols] = rows
    last = np.maximum.accumulate(last, axis=0)
    following = np.full((n_rows, len(below)), NOWHERE, np.int64)
    following[-1] = below
    following[rows - first, cols] = rows
    following = np.minimum.accumulate(following[::-1], axis=0)[::-1]
    at = np.arange(first, first + n_rows)[:, None]
    return np.minimum(at - last, following - at)


def envelopes(columns: np.ndarray, along: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lower envelope of the parabolas (x - columns[i])^2 + along[row, i]^2, for all rows at once.

    Returns per row the parabolas on it from left to right, where each begins, and how many there are. All rows
    take up a column in the same step; those where it hides earlier parabolas drop them together.
    """
    n, width = along.shape
    height = along.astype(np.float64) ** 2 + columns.astype(np.float64) ** 2
    picked = np.zeros((n, width), np.int64)
    begins = np.full((n, width), -np.inf)
    top = np.zeros(n, np.int64)
    every = np.arange(n)
    for i in range(1, width):
        at = np.empty(n)
        left = every
        while len(left):
            under = picked[left, top[left]]
            cross = (height[left, i] - height[left, under]) / (2.0 * (columns[i] - columns[under]))
            at[left] = cross
            left = left[cross <= begins[left, top[left]]]
            top[left] -= 1
        top += 1
        picked[every, top] = i
        begins[every, top] = at
    return picked, begins, top + 1


def row_distances(columns: np.ndarray, along: np.ndarray, row: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Distance of the cells (row: place in `along`, x: column), in any order, to the nearest target."""
    picked, begins, count = envelopes(columns, along)
    order = np.lexsort((x, row))
    out = np.empty(len(x))
    starts = np.flatnonzero(np.append(True, row[order][1:] != row[order][:-1]))
    for part in np.split(order, starts[1:]):
        r = row[part[0]]
        best = picked[r, np.searchsorted(begins[r, : count[r]], x[part], side="right") - 1]
        out[part] = np.sqrt((x[part] - columns[best]).astype(np.float64) ** 2 + along[r, best].astype(np.float64) ** 2)
    return out


def distance_to_nearest(cells: DataFrame, targets: DataFrame, keys: list[str], out: str = "distance") -> DataFrame:
    """Euclidean distance in cells to the nearest target, NULL when the group has none.

    Grid rows are cut into chunks. Along columns, each column's targets inside a chunk and the nearest ones
    before and after it are found by a window over the column's chunks. Along rows, the distances of a chunk's
    columns are parabolas whose lower envelope gives every cell of a row its nearest target. The chunks have
    as many rows as the widest group leaves room for, so that a task never holds more than CHUNK_POSITIONS
    positions (or one grid row). Work follows rows with cells times columns with targets, or columns
    times rows where that is less, however the targets are spread; cells and targets move once each.

    Rows and columns are integers of any sign; repeated cells give one row.
    """
    at = [*keys, "row_idx", "col_idx"]
    cells, targets = cut_lineage(cells.select(*at).distinct()), cut_lineage(targets.select(*at).distinct())
    count = lambda df, side: df.groupBy(*keys).agg(F.count_distinct("row_idx").alias(f"{side}_rows"), F.count_distinct("col_idx").alias(f"{side}_cols"))
    shape = count(cells, "cell").join(count(targets, "target"), keys).agg(
        F.sum(F.col("cell_rows") * F.col("target_cols")).alias("by_rows"), F.sum(F.col("cell_cols") * F.col("target_rows")).alias("by_cols"),
        F.max("target_cols").alias("wide"), F.max("target_rows").alias("high")).first()
    found = targets.select(*keys).distinct()
    none = cells.join(broadcast_if_small(found), keys, "left_anti").withColumn(out, F.lit(None).cast("double"))
    if shape.wide is None:
        return none
    turned = shape.by_cols < shape.by_rows
    row, col, width = ("col_idx", "row_idx", shape.high) if turned else ("row_idx", "col_idx", shape.wide)
    n_rows = max(1, min(CHUNK_ROWS, CHUNK_POSITIONS // width))
    chunk = F.floor(F.col(row) / n_rows).alias("chunk")
    asked = cells.join(broadcast_if_small(found), keys, "left_semi").select(*keys, chunk, F.col(row).alias("r"), F.col(col).alias("c"))
    known = targets.groupBy(*keys, chunk, F.col(col).alias("c")).agg(
        F.collect_list(F.col(row)).alias("rows"), F.min(row).alias("lowest"), F.max(row).alias("highest"))
    wanted = broadcast_if_small(asked.select(*keys, "chunk").distinct())
    places = known.select(*keys, "c").distinct().join(wanted, keys).select(*keys, "chunk", "c", F.lit(True).alias("wanted"))
    column = Window.partitionBy(*keys, "c").orderBy("chunk")
    carried = known.join(places, [*keys, "chunk", "c"], "full").select(
        *keys, "chunk", "c", "rows", "wanted",
        F.last("highest", ignorenulls=True).over(column.rowsBetween(Window.unboundedPreceding, -1)).alias("above"),
        F.first("lowest", ignorenulls=True).over(column.rowsBetween(1, Window.unboundedFollowing)).alias("below"),
    ).where("wanted").drop("wanted")

    def transform(questions: pa.Table, answers: pa.Table) -> pa.Table:
        if not questions.num_rows:
            return questions.select([*keys, "r", "c"]).append_column(out, pa.array([], pa.float64()))
        answers = answers.sort_by("c")
        first = questions.column("chunk")[0].as_py() * n_rows
        columns = answers.column("c").to_numpy()
        lists = answers.column("rows").combine_chunks()
        inside = np.repeat(np.arange(len(columns)), np.diff(lists.offsets.to_numpy()) * lists.is_valid().to_numpy(zero_copy_only=False))
        carry = lambda name, far: answers.column(name).fill_null(far).to_numpy()
        along = column_distances(first, n_rows, carry("above", -NOWHERE), carry("below", NOWHERE), lists.flatten().to_numpy(), inside)
        r, x = questions.column("r").to_numpy(), questions.column("c").to_numpy()
        rows, place = np.unique(r, return_inverse=True)
        distance = row_distances(columns, along[rows - first], place, x)
        return questions.select([*keys, "r", "c"]).append_column(out, pa.array(distance))

    kinds = dict(cells.dtypes)
    carried = carried.select(*[F.col(k).alias(f"{k}_") for k in keys], F.col("chunk").alias("chunk_"), F.col("c").cast("long").alias("c"),
                             F.col("rows").cast("array<long>").alias("rows"), F.col("above").cast("long").alias("above"), F.col("below").cast("long").alias("below"))
    near = asked.withColumn("r", F.col("r").cast("long")).withColumn("c", F.col("c").cast("long")).groupBy(*keys, "chunk").cogroup(
        carried.groupBy(*[f"{k}_" for k in keys], "chunk_")
    ).applyInArrow(transform, ", ".join([*(f"{k} {kinds[k]}" for k in keys), "r long", "c long", f"{out} double"]))
    back = near.select(*keys, F.col("r").cast(kinds[row]).alias(row), F.col("c").cast(kinds[col]).alias(col), out)
    return back.select(*at, out).unionByName(none.select(*at, out))
